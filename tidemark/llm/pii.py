"""Personal data in texts: exact patterns, and candidates that boosted trees judge.

Generators of high recall propose spans, which may overlap; trees on format and
context score them; a calibrated threshold per kind selects what is added to
the spans of the exact patterns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.boosting import Boosted, fit_boosted
from tidemark.llm.sampling import bounded_sample
from tidemark.llm.spans import first_apart, touching
from tidemark.session import scratch_path

#: The kinds in the order of their names in results.
KINDS = ("email", "ip", "card", "phone")
#: Documents whose candidates the trees are fitted on, at most, and candidates.
TRAINING_DOCS = 20_000
TRAINING_ROWS = 60_000
_RANK = {k: i for i, k in enumerate(KINDS)}

# The base patterns. An address is found from its "@"; a number lies in an area of digits and separators, so only
# areas are searched. Neither changes what the patterns match.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
AREA = re.compile(r"[+(]?[0-9][0-9 ()./,:\[\]_+-]{6,}")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# The generators.
_AT = re.compile(r"@|[(\[]at[)\]]|\sat\s", re.IGNORECASE)
_LEFT = re.compile(r"[\w.%+-]{1,64}\s?\Z")
_RIGHT = re.compile(r"\s?[\w-]{1,63}(?:(?:\.|\s?[(\[]dot[)\]]\s?|\sdot\s)[\w-]{1,63}){0,5}", re.IGNORECASE)
_IPS = re.compile(r"(?<![0-9])[0-9]{1,4}(?:(?:\s?\.\s?|\[\.\]|, ?|-|:)[0-9]{1,4}){3}(?![0-9])")
_CARDS = re.compile(r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9]){10,19}(?![0-9])")
_PHONES = re.compile(r"(?<![0-9])(?:\+|\()?[0-9][0-9 ()./-]{5,22}[0-9](?![0-9])")
_CONTEXT = {
    "email": re.compile(r"mail|contact|write|@", re.IGNORECASE),
    "ip": re.compile(r"\bip\b|host|server|address", re.IGNORECASE),
    "card": re.compile(r"card|visa|credit|pay|account", re.IGNORECASE),
    "phone": re.compile(r"tel|phone|call|mobil|fax|cell", re.IGNORECASE),
}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d // 10 + d % 10 for d in (2 * int(c) for c in digits[-2::-2]))
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in text.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the base patterns in order of start, then kind."""
    found = [("email", a, b) for a, b in _emails(text)]
    for area in AREA.finditer(text):
        lo, hi = area.span()
        found += [("ip", *m.span()) for m in IP.finditer(text, lo, hi) if _is_ip(m.group())]
        for m in CARD.finditer(text, lo, hi):
            digits = digits_of(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        found += [("phone", *m.span()) for m in PHONE.finditer(text, lo, hi) if 9 <= len(digits_of(m.group())) <= 15]
    return in_order(found)


def in_order(found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(found, key=lambda s: (s[1], _RANK[s[0]], s[2]))


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans that may be personal data: wider formats than the base, without checks. They may overlap."""
    out = []
    for m in _AT.finditer(text):
        left, right = _LEFT.search(text, max(0, m.start() - 65), m.start()), _RIGHT.match(text, m.end())
        if left and right and (m.group() == "@" or "." in right.group() or "dot" in right.group().lower()):
            out.append(("email", left.start(), right.end()))
    for area in AREA.finditer(text):
        lo, hi = area.span()
        for kind, pattern in (("ip", _IPS), ("card", _CARDS), ("phone", _PHONES)):
            out += [(kind, *m.span()) for m in pattern.finditer(text, lo, hi)]
    return out


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3


def format_features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span and what stands around it."""
    span = text[start:end]
    digits, groups = digits_of(span), re.findall(r"[0-9]+", span)
    sizes = [len(g) for g in groups] or [0]
    around = text[max(0, start - 30) : start] + " " + text[end : end + 15]
    tail = re.findall(r"[A-Za-z]+", span)
    return [
        len(span), len(digits), len(groups), max(sizes), min(sizes), len(set(digits)),
        sum(map(str.isalpha, span)), span.count(" "), span.count("."), span.count("-"), span.count("(") + span.count("["),
        span.count("/") + span.count(",") + span.count(":") + span.count("_"),
        span.startswith("+"), span.startswith("0"), "@" in span, len(digits) > 1 and luhn(digits),
        len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups), len(groups) > 1 and len(set(sizes)) == 1,
        len(tail[-1]) if tail else 0, len(tail), _side(text[start - 1 : start]), _side(text[end : end + 1]),
        *(bool(p.search(around)) for p in _CONTEXT.values()),
    ]


def _disguised(kind: str, span: str, turn: int) -> tuple[str, str]:
    """A span in another format that is still personal data, and a like one that is not."""
    digits = digits_of(span)
    if kind == "email":
        name, _, host = span.partition("@")
        good = (f"{name} at {host}", f"{name}(at){host}", f"{name}@{host.replace('.', ' dot ')}", f"{name} [at] {host}")[turn % 4]
        return good, f"{name}@{host.split('.')[0]}"
    if kind == "ip":
        parts = span.split(".")
        good = ("[.]".join(parts), " . ".join(parts), "[.]".join(parts))[turn % 3]
        return good, ".".join([str(300 + turn % 600), *parts[1:]])
    if kind == "card":
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + turn % 9) % 10)
        return (".".join(fours), "/".join(fours), "  ".join(fours), "_".join(fours))[turn % 4], wrong
    bare, local = span.lstrip("+"), re.sub(r"\A\+[0-9]{1,3}[ .-]?", "", span)
    good = (bare, local, "00" + bare, local, re.sub(r"[ ().-]+", "/", bare))[turn % 5]
    date = f"20{digits[:2]}-0{turn % 9 + 1}-1{turn % 10} 1{turn % 10}"
    return good, (digits[:3] + " " + digits[3:7], date, date.replace("-", "/"))[turn % 3]


def training_rows(text: str) -> list[tuple[str, int, list[float]]]:
    """Candidates as (kind, label, features): those that are base spans against those that are not, and disguised ones."""
    base, out = base_spans(text), []
    known = {(k, a, b) for k, a, b in base}
    for kind, a, b in candidates(text)[:200]:
        touches = any(k == kind and s < b and a < e for k, s, e in base)
        if (kind, a, b) in known or not touches:
            out.append((kind, int((kind, a, b) in known), format_features(text, kind, a, b)))
    for turn, (kind, a, b) in enumerate(base[:50]):
        for label, other in zip((1, 0), _disguised(kind, text[a:b], turn + a), strict=True):
            near = text[max(0, a - 40) : a]
            changed = near + other + text[b : b + 40]
            for k, s, e in candidates(changed):
                if k == kind and abs(s - len(near)) <= 1 and abs(e - len(near) - len(other)) <= 1:
                    out.append((kind, label, format_features(changed, k, s, e)))
    return out


def fit_pii(docs: DataFrame, bound: int = TRAINING_DOCS) -> dict[str, Boosted]:
    """One model per kind, fitted on candidates of at most ``bound`` documents; the base patterns give the labels."""
    chosen = bounded_sample(docs.where("text is not null and doc_id is not null"), F.xxhash64("doc_id"), bound)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [r for t in batch.column(0).to_pylist() for r in training_rows(t)]
            kinds = [pa.string(), pa.int32(), pa.list_(pa.float64())]
            columns = list(zip(*out, strict=True)) if out else [[]] * 3
            arrays = [pa.array([list(map(float, v)) for v in c] if i == 2 else c, k) for i, (c, k) in enumerate(zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["kind", "label", "features"])

    found = chosen.select(F.col("text").cast("string")).mapInArrow(run, "kind string, label int, features array<double>")
    path = scratch_path(docs.sparkSession, "candidates")
    found.write.parquet(path)
    drawn = bounded_sample(docs.sparkSession.read.parquet(path), F.xxhash64("kind", "label", "features"), TRAINING_ROWS)
    got = sorted(drawn.collect(), key=lambda r: hashlib.md5(repr(r).encode()).digest())
    models = {}
    for kind in KINDS:
        rows = [r for r in got if r["kind"] == kind]
        x = np.array([r["features"] for r in rows], float).reshape(len(rows), -1)
        models[kind] = fit_boosted(x, np.array([r["label"] for r in rows], int))
    return models


def find_in_texts(texts: list[str], models: dict[str, Boosted]) -> Iterator[tuple[list, list]]:
    """Base spans and all spans of each text. Of overlapping additions the likeliest stays; none touches a base span."""
    bases = [base_spans(t) for t in texts]
    on_base = [touching((a, b) for _, a, b in base) for base in bases]
    asked = [
        (i, k, a, b)
        for i, text in enumerate(texts)
        for k, a, b in candidates(text)
        if models[k].trees and not on_base[i](a, b)
    ]
    added: list[list] = [[] for _ in texts]
    for kind in KINDS:
        mine = [c for c in asked if c[1] == kind]
        if mine:
            p = models[kind].probability(np.array([format_features(texts[i], k, a, b) for i, k, a, b in mine], float))
            for (i, k, a, b), chance in zip(mine, p.tolist(), strict=True):
                if chance >= models[kind].threshold:
                    added[i].append((-chance, a, _RANK[k], b, k))
    for base, more in zip(bases, added, strict=True):
        kept = first_apart((a, b, k) for _, a, _, b, k in sorted(more))
        yield base, in_order(base + [(k, a, b) for a, b, k in kept])


def find_pii(docs: DataFrame, models: dict[str, Boosted]) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and all spans of every text of (doc_id, text).

    A null text counts as empty and has no spans; repeated rows give repeated
    rows; a null doc_id stays null; other columns are ignored.
    """
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [[] for _ in KINDS], [], []
            for base, found in find_in_texts([t or "" for t in batch.column(1).to_pylist()], models):
                for i, kind in enumerate(KINDS):
                    counts[i].append(sum(k == kind for k, _, _ in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(found))
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = ", ".join(["doc_id long", *(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
