"""Secrets in texts: exact patterns, and a linear-chain conditional random field for what they miss.

The field tags tokens as outside (O), begin (B) or inside (I) of a secret from
their shape, their neighbours and features of the whole text, and is decoded
by Viterbi.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.sampling import bounded_sample
from tidemark.llm.spans import touching
from tidemark.llm.words import slices
from tidemark.session import scratch_path

#: The base kinds in the order of their names in results.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: What the field adds.
ADDED = "tagged"
#: Documents whose windows the field is fitted on, at most, and windows of either sort. All of them are labelled;
#: a text gives windows around so many of its secrets.
TRAINING_DOCS = 20_000
TRAINING_WINDOWS = 3_000
TEXT_SECRETS = 16
SPAN = 24
REACH = 2
O, B, I = 0, 1, 2
_TOKEN = re.compile(r"[\w+/.-]+|[^\s\w]")
_TYPES = 200_000
SIZES = (2, 4, 6, 8, 12, 16, 20, 24, 32, 64)
_HEX_LETTERS = set("abcdef")
_NEVER = -1e9


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the base patterns in order of start, then kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return in_order(found)


def in_order(found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    rank = {k: i for i, k in enumerate((*KINDS, ADDED))}
    return sorted(found, key=lambda s: (s[1], rank[s[0]], s[2]))


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def secret_parts(text: str) -> list[tuple[int, int]]:
    """What is secret in the base spans: of an assignment its value."""
    out = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [m.span() for m in ACCESS.finditer(text)] + [m.span() for m in HEX.finditer(text)]
    return sorted(set(out))


def token_features(token: str) -> list[str]:
    """Shape, length, alphabet, variety and, if short, the word itself."""
    if not token:
        return ["edge"]
    shape, before = [], ""
    for c in token:
        kind = "X" if c.isupper() else "x" if c.islower() else "9" if c.isdigit() else "w" if c.isalpha() else c
        if kind != before:
            shape.append(kind)
        before = kind
    has = {"digit": any(map(str.isdigit, token)), "alpha": any(map(str.isalpha, token))}
    if all(c in "0123456789abcdef" for c in token):
        alphabet = "hex"
    elif has["digit"] and has["alpha"]:
        alphabet = "mixed"
    else:
        alphabet = "digit" if has["digit"] else "alpha" if has["alpha"] else "sign"
    size = sum(len(token) >= n for n in SIZES)
    out = [
        "shape=" + ("".join(shape) if len(shape) <= 4 else "long"),
        f"turns={min(len(shape), 8)}",
        f"size={size}",
        f"{alphabet}={size}",
        f"variety={int(8 * len(set(token)) / len(token))}",
    ]
    if len(token) <= 12 and (alphabet in ("alpha", "sign")):
        out.append("word=" + token.lower())
    return out


def file_features(tokens: list[str]) -> np.ndarray:
    """Whether the text assigns, holds long tokens, and holds many digits."""
    digits = sum(t[:1].isdigit() for t in tokens)
    return np.array([("=" in tokens) or (":" in tokens), max(map(len, tokens), default=0) >= 20, digits * 20 > len(tokens)], float)


@dataclass
class Crf:
    """Weights: ``unary[offset, feature, label]`` for the tokens from REACH before to REACH after, ``file``, ``step``."""

    names: dict[str, int]
    unary: np.ndarray
    file: np.ndarray
    step: np.ndarray
    _types: dict[str, int] = field(default_factory=dict)
    _kinds: dict[tuple, int] = field(default_factory=dict)
    _rows: list[np.ndarray] = field(default_factory=list)
    _table: np.ndarray | None = None

    def row(self, token: str) -> np.ndarray:
        """What a token adds to the labels at each offset."""
        known = [self.names[f] for f in token_features(token) if f in self.names]
        return self.unary[:, known, :].sum(1)

    def _kind(self, token: str) -> tuple:
        """Tokens of a kind have the same features. Plain words are told by size and variety, unless known one by one."""
        body = token[1:]
        if 2 <= len(token) <= 120 and token.isalpha() and all(map(str.islower, body)) and set(token) - _HEX_LETTERS:
            size = sum(len(token) >= n for n in SIZES)
            word = "word=" + token.lower() if len(token) <= 12 and "word=" + token.lower() in self.names else ""
            if token[0].islower() or token[0].isupper():
                return token[0].islower(), size, 8 * len(set(token)) // len(token), word
        return tuple(f for f in token_features(token) if f in self.names)

    def _numbers(self, tokens: list[str]) -> np.ndarray:
        types, kinds = self._types, self._kinds
        if len(types) > _TYPES:
            types.clear()
        for t in set(tokens).difference(types):
            kind = self._kind(t)
            if kind not in kinds:
                kinds[kind] = len(self._rows)
                self._rows.append(self.row(t).ravel())
            types[t] = kinds[kind]
        if self._table is None or len(self._table) < len(self._rows):
            self._table = np.array(self._rows)
        return np.fromiter(map(types.__getitem__, tokens), "i8", len(tokens))

    def tag(self, texts: list[list[str]]) -> list[list[tuple[int, int]]]:
        """Token ranges (first, last + 1) tagged as secrets in each token list."""
        flat, starts = [""] * REACH, []
        for tokens in texts:
            starts.append(len(flat))
            flat += tokens
            flat += [""] * REACH
        number = self._numbers(flat)
        table = self._table.reshape(-1, 2 * REACH + 1, 3)
        score = np.zeros((len(flat), 3))
        for offset in range(-REACH, REACH + 1):  # the token at t + offset speaks for t
            lo, hi = max(0, -offset), len(flat) - max(0, offset)
            score[lo:hi] += table[number[lo + offset : hi + offset], offset + REACH]
        pad = np.ones(len(flat), bool)
        for start, tokens in zip(starts, texts, strict=True):
            score[start : start + len(tokens)] += file_features(tokens) @ self.file
            pad[start : start + len(tokens)] = False
        score[pad, 1:] = _NEVER
        return self._decode(score, starts, texts)

    def _decode(self, score: np.ndarray, starts: list[int], texts: list[list[str]]) -> list[list[tuple[int, int]]]:
        """Viterbi on the stretches where O is not certain.

        If O beats both other labels by more than any change of transitions can
        bring, and more than it costs to let the next token begin a secret
        instead of going on with one, every best sequence has O there.
        """
        legal = self.step[self.step > _NEVER / 2]
        bound = 2 * (legal.max() - legal.min()) + 1e-9
        go_on = np.maximum(0, np.r_[score[1:, I] - score[1:, B], 0])
        open_ = np.flatnonzero(score[:, O] - score[:, 1:].max(1) <= bound + go_on)
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not len(open_):
            return out
        for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
            labels = self.viterbi(score[run])
            begins = [i for i, y in enumerate(labels) if y == B]
            of = int(np.searchsorted(starts, run[0], "right") - 1)
            for i in begins:
                j = i + 1
                while j < len(labels) and labels[j] == I:
                    j += 1
                out[of].append((int(run[i]) - starts[of], int(run[0]) + j - starts[of]))
        return out

    def viterbi(self, score: np.ndarray) -> list[int]:
        """The best labels of a stretch between two tokens labelled O."""
        best, back = self.step[O] + score[0], []
        for row in score[1:]:
            through = best[:, None] + self.step
            back.append(through.argmax(0))
            best = through.max(0) + row
        at = int((best + self.step[:, O]).argmax())
        labels = [at]
        for b in reversed(back):
            at = int(b[at])
            labels.append(at)
        return labels[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def fit_crf(windows: list[list[str]], labels: np.ndarray, files: np.ndarray, rounds: int = 80, decay: float = 1e-3) -> Crf:
    """Maximum likelihood by Adam; gradients are expected minus observed counts from forward-backward.

    Windows are of SPAN tokens, ends padded with empty ones. Features that occur
    in fewer than three windows are left out. Without any secret the field
    tags nothing.
    """
    step = np.zeros((3, 3))
    step[O, I] = _NEVER
    if not len(windows) or not (labels == B).any():
        step[:, B] = -50
        return Crf({}, np.zeros((2 * REACH + 1, 0, 3)), np.zeros((3, 3)), step)
    tokens = sorted({t for w in windows for t in w} | {""})
    number = {t: i for i, t in enumerate(tokens)}
    ids = np.array([[number[t] for t in w] for w in windows])
    described = [token_features(t) for t in tokens]
    counts = Counter(f for w in windows for t in set(w) for f in described[number[t]])
    names = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= 3))}
    rows = np.array([i for i, fs in enumerate(described) for f in fs if f in names])
    cols = np.array([names[f] for fs in described for f in fs if f in names])
    n, length, offsets = len(windows), ids.shape[1], 2 * REACH + 1
    edge = np.full((n, REACH), number[""])
    wide = np.concatenate([edge, ids, edge], 1)
    seen = [wide[:, o : o + length] for o in range(offsets)]
    params = [np.zeros((offsets, len(names), 3)), np.zeros((3, 3)), np.zeros((3, 3))]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    onehot = np.eye(3)[labels]
    paths = np.zeros((3, 3))
    np.add.at(paths, (labels[:, :-1].ravel(), labels[:, 1:].ravel()), 1)
    for at in range(1, rounds + 1):
        unary, file, free = params
        table = np.zeros((len(tokens), offsets, 3))
        for o in range(offsets):
            np.add.at(table[:, o], rows, unary[o][cols])
        score = sum(table[seen[o], o] for o in range(offsets)) + (files @ file)[:, None, :]
        trans = free + step
        ahead = np.zeros((n, length, 3))
        ahead[:, 0] = score[:, 0] + [0, 0, _NEVER]
        for t in range(1, length):
            ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + trans, 1) + score[:, t]
        after = np.zeros((n, length, 3))
        for t in range(length - 2, -1, -1):
            after[:, t] = _log_sum(trans + (score[:, t + 1] + after[:, t + 1])[:, None, :], 2)
        total = _log_sum(ahead[:, -1], 1)
        gap = np.exp(ahead + after - total[:, None, None]) - onehot
        pairs = np.zeros((3, 3))
        for t in range(1, length):
            joint = ahead[:, t - 1, :, None] + trans + (score[:, t] + after[:, t])[:, None, :] - total[:, None, None]
            pairs += np.exp(joint).sum(0)
        grads = [np.zeros_like(p) for p in params]
        for o in range(offsets):
            per_token = np.stack([np.bincount(seen[o].ravel(), gap[:, :, y].ravel(), len(tokens)) for y in range(3)], 1)
            for y in range(3):
                grads[0][o, :, y] = np.bincount(cols, per_token[rows, y], len(names))
        grads[1] = files.T @ gap.sum(1)
        grads[2] = pairs - paths
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            g = g / n + decay * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.15 * (m / (1 - 0.9**at)) / (np.sqrt(v / (1 - 0.99**at)) + 1e-8)
    return Crf(names, params[0], params[1], params[2] + step)


def training_windows(doc: int, text: str) -> list[tuple[list[str], list[int], list[float], bool]]:
    """Windows of tokens with labels from the base spans: around each secret, each other long or telling token, and one more."""
    spans = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    tokens = [text[a:b] for a, b in spans]
    if not tokens:
        return []
    labels, starts = [O] * len(tokens), [a for a, _ in spans]
    centres = []
    for a, b in secret_parts(text):
        first, end = bisect_left(starts, a), bisect_left(starts, b)
        if first < end:
            labels[first:end] = [B] + [I] * (end - first - 1)
            centres.append((first, True))
    centres = _spread(centres, TEXT_SECRETS)
    telling = [i for i, t in enumerate(tokens) if len(t) >= 10 and any(map(str.isdigit, t)) and labels[i] == O]
    centres += [(i, False) for i in _spread(telling, 3)] + [((doc * 7919) % len(tokens), False)]
    flags, out = file_features(tokens).tolist(), []
    for centre, good in centres:
        lo = max(0, centre - SPAN // 2)
        part, marks = tokens[lo : lo + SPAN], labels[lo : lo + SPAN]
        if marks[0] == I:
            marks[0] = B
        fill = SPAN - len(part)
        window = ([t[:200] for t in part] + [""] * fill, marks + [O] * fill, flags, good)
        out += [window, *_varied(*window)] if good else [window]
    return out


def _spread(items: list, most: int) -> list:
    """At most so many of the items, from all over the list."""
    return items if len(items) <= most else [items[i * len(items) // most] for i in range(most)]


def _varied(tokens: list[str], labels: list[int], flags: list[float], good: bool) -> list[tuple]:
    """The window with its secrets in another alphabet, as it stands and with other words where it names or assigns them.

    So the field learns the look of a secret beside the words around it.
    """
    coded = [
        base64.b64encode(hashlib.sha256(t.encode()).digest()).decode().replace("=", "7")[: 14 + sum(map(ord, t)) % 27]
        if y != O and len(t) >= 8
        else t
        for t, y in zip(tokens, labels, strict=True)
    ]
    plain = [t for t, y in zip(tokens, labels, strict=True) if y == O and t.isalpha()] or ["is"]
    other = list(coded)
    for i, y in enumerate(labels):
        if y == B:
            for j in range(max(0, i - 3), i):
                if labels[j] == O:
                    other[j] = '"' if tokens[j] in "\"'" and tokens[j] else plain[(i + j) % len(plain)]
    return [(coded, labels, flags, good), (other, labels, [0.0, *flags[1:]], good)]


def fit_secrets(docs: DataFrame, bound: int = TRAINING_DOCS, windows: int = TRAINING_WINDOWS) -> Crf:
    """Fit the field on windows of at most ``bound`` documents, whose base spans are the labels.

    Of either sort of windows, with a secret and without, at most ``windows`` are drawn by their hash.
    """
    chosen = bounded_sample(docs.where("text is not null and doc_id is not null"), F.xxhash64("doc_id"), bound)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(d, *w) for d, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for w in training_windows(d, t)]
            kinds = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.bool_()]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "tokens", "labels", "files", "good"])

    rows = chosen.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, tokens array<string>, labels array<int>, files array<double>, good boolean"
    )
    path = scratch_path(docs.sparkSession, "windows")
    rows.write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    key = F.xxhash64("doc_id", "tokens")
    parts = [bounded_sample(rows.where(sort), key, windows) for sort in ("good", "not good")]
    got = [r for p in parts for r in p.collect()]
    got.sort(key=lambda r: (r["doc_id"], r["tokens"]))
    return fit_crf(
        [list(r["tokens"]) for r in got],
        np.array([r["labels"] for r in got], int).reshape(-1, SPAN),
        np.array([r["files"] for r in got], float).reshape(-1, 3),
    )


def find_in_texts(texts: list[str], crf: Crf) -> Iterator[tuple[list, list]]:
    """Base spans and all spans of each text. Tagged spans that touch a base span or are shorter than 8 add nothing."""
    for first, last in slices(texts):
        part = texts[first:last]
        tagged = crf.tag([_TOKEN.findall(t) for t in part])
        for text, ranges in zip(part, tagged, strict=True):
            base, added = base_spans(text), []
            if ranges:
                at = [m.span() for m in _TOKEN.finditer(text)]
                on_base = touching((a, b) for _, a, b in base)
                for i, j in ranges:
                    a, b = at[i][0], at[j - 1][1]
                    if b - a >= 8 and not on_base(a, b):
                        added.append((ADDED, a, b))
            yield base, in_order(base + added)


def find_secrets(docs: DataFrame, crf: Crf) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and all spans of every text of (doc_id, text).

    A null text counts as empty and has no spans; repeated rows give repeated
    rows; a null doc_id stays null; other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [[], [], []], [], []
            for base, found in find_in_texts([t or "" for t in batch.column(1).to_pylist()], crf):
                for i, kind in enumerate(KINDS):
                    counts[i].append(sum(k == kind for k, _, _ in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(found))
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact_secrets(docs: DataFrame, crf: Crf, mask: str = "[SECRET]") -> DataFrame:
    """docs with ``mask`` in place of every secret in ``text``; all other columns and rows stay as they are.

    Only texts go to Python, and only those that change come back.
    """

    @F.arrow_udf("string")
    def changed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            out: list[str | None] = []
            for text, (_, found) in zip(texts, find_in_texts(texts, crf), strict=True):
                spans = {*secret_parts(text), *((a, b) for k, a, b in found if k == ADDED)} if found else None
                out.append(masked(text, sorted(spans), mask) if spans else None)
            yield pa.array(out, pa.string())

    text = F.col("text").cast("string")
    return docs.withColumn("text", F.coalesce(changed(text), text))


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    out, at = [], 0
    for a, b in spans:
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])
