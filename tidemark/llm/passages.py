"""Passages that repeat across documents, found by chaining shared k-mer seeds.

Seeds are minimizers of short, middle and long runs of words: of every few
successive runs, the one with the smallest hash. They are shuffled once, packed
by range of hashes; each occurrence of a seed meets the seed's first occurrence
only, so a passage shared by n documents costs n matches, not n * n. A passage whose short seeds first stand scattered in
other documents is found by its longer ones, which stand in its source alone.
Matches between two documents are chained in order under a gap cost, with a
Fenwick tree for the best predecessor, and chains are aligned word by word.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import free_names
from tidemark.llm.near import text_hash
from tidemark.llm.words import held, slices
from tidemark.session import freed_shuffles, scratch_path

K = 5
#: Any exact common run of K + WINDOW - 1 words has a common seed.
WINDOW = 8
#: (words, window) of the seeds that are joined. An exact common run of 6, 19 and 39 words has one of each.
LEVELS = ((K, 2), (12, 8), (24, 16))
#: Cost of each word, of either document, between the starts of two chained seeds.
GAP = 0.1
#: Words beyond a chain's seeds to which its alignment may reach.
REACH = K + WINDOW + 3
#: A longer run of words without a partner ends a passage.
BREAK = 12
#: A single match counts if there is another this near on its diagonal.
FAR = 60
#: Cells of an alignment's table.
TABLE_CELLS = 40_000
#: Shorter aligned pieces are chance.
LEAST_PIECE = 8
#: Seeds of a range that is matched at once, and characters that on average bring one.
RANGE_SEEDS = 1_000_000
SEED_CHARS = 6
#: A seed of more documents of one batch is matched within the batch, and only its first occurrence is dealt.
HOT_DOCS = 64
#: Characters whose seeds are found at once, or one text; a batch holds many times that, and its workers share a machine.
SLICE_CHARS = 500_000
#: Low bytes of a seed that are not shuffled: 56 bits tell seeds apart, and alignment checks words.
_SPARED = 8
_CACHED_WORDS = 200_000
_SPREAD = [np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64)) for j in range(LEVELS[-1][0])]


class _Hashes(dict):
    """64-bit hashes of words, forgotten when there are too many."""

    def __missing__(self, word: str) -> int:
        if len(self) > _CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8"))
        return found


_WORD = regex.compile(r"\S+")


def word_hashes(text: str) -> np.ndarray:
    """One hash per word; words are what white space separates, in lower case."""
    return _hashed(text.lower().split())


def _hashed(words: list[str]) -> np.ndarray:
    return np.fromiter(map(held("passage words", _Hashes).__getitem__, words), "<u8", len(words))


def _hashed_where(words: list[str], ranges: Iterable[tuple[int, int]]) -> np.ndarray:
    """Hashes of the words in the ranges; 0 elsewhere."""
    out, done = np.zeros(len(words), "<u8"), 0
    for lo, hi in sorted(ranges):
        lo, hi = max(lo, done), min(hi, len(words))
        if lo < hi:
            out[lo:hi] = _hashed(words[lo:hi])
            done = hi
    return out


def _slid(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values, by doubling."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out


def seeds(words: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the minimizers. In a run of equal k-mers only the first counts."""
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, "i4"), np.empty(0, "<i8")
    mixed = _mixed(words, k)
    width = min(window, n)
    least = _slid(mixed, width, np.minimum)
    edge = np.zeros(width - 1, "<u8")
    top = _slid(np.concatenate([edge, least, edge]), width, np.maximum)
    chosen = mixed == top
    chosen[1:] &= mixed[1:] != mixed[:-1]
    at = np.flatnonzero(chosen)
    return at.astype("i4"), mixed[at].view("<i8")


def _mixed(words: np.ndarray, k: int) -> np.ndarray:
    """One hash for every run of k words."""
    n = len(words) - k + 1
    mixed = np.zeros(n, "<u8")
    folded = words ^ (words >> np.uint64(31))
    for j in range(k):
        mixed += folded[j : j + n] * _SPREAD[j]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def seeds_of_all(words: np.ndarray, sizes: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text numbers, positions and hashes of the minimizers of many texts whose words stand one after another: those of ``seeds``."""
    begin = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    span = window + k - 1
    found = [np.empty(0, np.int64)]
    hashes = [np.empty(0, "<i8")]
    if len(words) >= span:
        mixed = _mixed(words, k)
        least = _slid(mixed, window, np.minimum)
        least[text[: len(least)] != text[span - 1 :]] = 0  # windows over the border of two texts
        edge = np.zeros(window - 1, "<u8")
        top = _slid(np.concatenate([edge, least, edge]), window, np.maximum)
        chosen = (mixed == top) & (top != 0)
        again = np.r_[False, mixed[1:] == mixed[:-1]]
        again[begin[sizes >= k]] = False
        at = np.flatnonzero(chosen & ~again)
        found.append(at)
        hashes.append(mixed[at].view("<i8"))
    for i in np.flatnonzero((sizes >= k) & (sizes < span)).tolist():  # too short for a whole window
        at, hashed = seeds(words[begin[i] : begin[i] + sizes[i]], k, window)
        found.append(begin[i] + at.astype(np.int64))
        hashes.append(hashed)
    at = np.concatenate(found)
    return text[at], (at - begin[text[at]]).astype("i4"), np.concatenate(hashes)


class Fenwick:
    """Prefix maxima of (score, index) over ranks."""

    def __init__(self, size: int):
        self.size, self.best = size, [(float("-inf"), -1)] * (size + 1)

    def put(self, rank: int, item: tuple[float, int]) -> None:
        at = rank + 1
        while at <= self.size:
            if item > self.best[at]:
                self.best[at] = item
            at += at & -at

    def before(self, rank: int) -> tuple[float, int]:
        """The best of all ranks below ``rank``."""
        out = (float("-inf"), -1)
        while rank > 0:
            if self.best[rank] > out:
                out = self.best[rank]
            rank -= rank & -rank
        return out


def chains(own: list[int], other: list[int]) -> list[list[int]]:
    """Collinear chains of matches (own[i], other[i]), the best first; each match is in one chain at most.

    A match is worth K; going from one to the next costs GAP for every word
    between their starts in either document. As the cost is a sum over the two
    documents, the best predecessor is a prefix maximum.
    """
    n = len(own)
    if all(own[i] < own[i + 1] and other[i] < other[i + 1] for i in range(n - 1)):
        # in step, the match before is the best predecessor: what it reached only grows
        score, back, reached = [0.0] * n, [-1] * n, float("-inf")
        for i in range(n):
            way = GAP * (own[i] + other[i])
            gain = reached - way
            score[i], back[i] = (K + gain, i - 1) if gain > 0 else (float(K), -1)
            reached = score[i] + way
        return _best_first(score, back, range(n), own, other)
    order = sorted(range(n), key=lambda i: (own[i], other[i]))
    ranks = sorted(set(other))
    tree = Fenwick(len(ranks))
    score, back = [0.0] * len(own), [-1] * len(own)
    at = 0
    while at < len(order):
        group_end = at
        while group_end < len(order) and own[order[group_end]] == own[order[at]]:
            i = order[group_end]
            reached, before = tree.before(bisect_left(ranks, other[i]))
            gain = reached - GAP * (own[i] + other[i])
            score[i] = K + max(0.0, gain)
            back[i] = before if gain > 0 else -1
            group_end += 1
        for i in order[at:group_end]:  # a word is no predecessor of itself
            tree.put(bisect_left(ranks, other[i]), (score[i] + GAP * (own[i] + other[i]), i))
        at = group_end
    return _best_first(score, back, order, own, other)


def _best_first(score: list[float], back: list[int], order: Iterable[int], own: list[int], other: list[int]) -> list[list[int]]:
    """The chains that end with each match, the best first, without matches that a better one has."""
    used, out = [False] * len(own), []
    for end in sorted(order, key=lambda i: (-score[i], own[i], other[i])):
        chain, i = [], end
        while i >= 0 and not used[i]:
            chain.append(i)
            used[i] = True
            i = back[i]
        if chain:
            out.append(chain[::-1])
    return out


def _common_lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the best alignment of ``a`` with every beginning of ``b`` pairs."""
    row = np.zeros(len(b) + 1, np.int32)
    for word in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == word)))
    return row


def _partnered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words of ``a`` have a partner in the best alignment with ``b``."""
    if len(a) == 0 or len(b) == 0:
        return np.zeros(len(a), bool)
    if len(a) == len(b):
        same = a == b
        if same.mean() >= 0.5 or len(a) < 3:
            return same
    n, m = len(a), len(b)
    if n == 1:
        return np.array([(b == a[0]).any()])
    if n * m > TABLE_CELLS:  # halved where the best alignment crosses the middle, so memory stays linear
        half = n // 2
        cut = int(np.argmax(_common_lengths(a[:half], b) + _common_lengths(a[half:][::-1], b[::-1])[::-1]))
        return np.concatenate([_partnered(a[:half], b[:cut]), _partnered(a[half:], b[cut:])])
    out = np.zeros(n, bool)
    equal = a[:, None] == b[None, :]
    if not equal.any():
        return out
    table = np.zeros((n + 1, m + 1), np.int32)
    for i in range(1, n + 1):
        table[i, 1:] = np.maximum.accumulate(np.maximum(table[i - 1, 1:], table[i - 1, :-1] + equal[i - 1]))
    i, j = n, m
    while i and j:
        if equal[i - 1, j - 1] and table[i, j] == table[i - 1, j - 1] + 1:
            out[i - 1] = True
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j]:
            i -= 1
        else:
            j -= 1
    return out


def _partnered_in_step(a: np.ndarray, b: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """``_partnered`` of each part between the cuts, for parts of equal length in both."""
    same = a == b
    sums, sizes = np.add.reduceat(same, cuts[:-1], dtype=np.int64), np.diff(cuts)
    for g in np.flatnonzero((2 * sums < sizes) & (sizes >= 3)).tolist():
        part = slice(cuts[g], cuts[g + 1])
        same[part] = _partnered(a[part], b[part])
    return same


def align(own: np.ndarray, other: np.ndarray, at_own: list[int], at_other: list[int], similarity: float) -> list[tuple]:
    """(start, end, similarity) of passages of ``own`` that the chain's seeds and the words around them carry."""
    flags, first = [], max(0, at_own[0] - REACH)
    lead = min(at_own[0] - first, at_other[0])
    first = at_own[0] - lead
    flags.append(_partnered(own[first : at_own[0]], other[at_other[0] - lead : at_other[0]]))
    x, y = np.array(at_own), np.array(at_other)
    # from one change of diagonal to the next, words are compared at once
    ends = np.r_[np.flatnonzero(np.diff(x - y)), len(x) - 1]
    i = 0
    for j in ends.tolist():
        if j > i:
            flags.append(_partnered_in_step(own[x[i] : x[j]], other[y[i] : y[j]], x[i : j + 1] - x[i]))
        if j + 1 < len(x):
            flags.append(_partnered(own[x[j] : x[j + 1]], other[y[j] : y[j + 1]]))
        i = j + 1
    tail = min(K + REACH, len(own) - at_own[-1], len(other) - at_other[-1])
    flags.append(_partnered(own[at_own[-1] : at_own[-1] + tail], other[at_other[-1] : at_other[-1] + tail]))
    hits = np.flatnonzero(np.concatenate(flags))
    out = []
    for piece in np.split(hits, np.flatnonzero(np.diff(hits) > BREAK) + 1):
        # ends that hold the piece together badly are given up
        while len(piece) >= LEAST_PIECE and len(piece) < similarity * (piece[-1] + 1 - piece[0]):
            gaps = np.diff(piece)
            cut = int(np.argmax(gaps)) + 1
            piece = piece[:cut] if cut * 2 > len(piece) else piece[cut:]
        piece = _trimmed(piece)
        if len(piece) >= LEAST_PIECE:
            length = int(piece[-1] + 1 - piece[0])
            out.append((int(first + piece[0]), int(first + piece[0]) + length, len(piece) / length))
    return out


def _trimmed(hits: np.ndarray) -> np.ndarray:
    """The hits without those at the ends that stand behind more misses than hits: they are chance."""
    if len(hits) < 2:
        return hits
    worth = np.full(hits[-1] + 1 - hits[0], -2)
    worth[hits - hits[0]] = 1
    total, middle = np.cumsum(worth), len(worth) // 2
    start = int(np.argmin(np.r_[0, total[:middle]]))
    end = middle + int(np.argmax(total[middle:]))
    return hits[(hits - hits[0] >= start) & (hits - hits[0] <= end)]


def _united(pieces: list[tuple]) -> list[list]:
    out: list[list] = []
    for start, end, like, source in sorted(pieces, key=lambda p: (p[0], -p[1], p[3])):
        if out and start <= out[-1][1] + 2:
            held = out[-1]
            held[1] = max(held[1], end)
            held[2].append((end - start, like, source))
        else:
            out.append([start, end, [(end - start, like, source)]])
    return out


def merge_pieces(pieces: list[tuple], least_words: int) -> list[tuple]:
    """Unite pieces (start, end, similarity, source) that overlap or touch; keep those of enough words.

    What one source holds must be half of that at least, so that stock phrases
    of many documents make no passage. The source of a passage is that of its
    longest piece; its similarity is the mean over the pieces' words.
    """
    of: dict[int, list[tuple]] = {}
    for piece in pieces:
        of.setdefault(piece[3], []).append(piece)
    whole = []
    for source, own in of.items():
        for start, end, parts in _united(own):
            if 2 * (end - start) >= least_words:
                words = sum(n for n, _, _ in parts)
                whole.append((start, end, sum(n * like for n, like, _ in parts) / words, source))
    out = _united(whole)
    found = []
    for start, end, parts in out:
        if end - start >= least_words:
            words = sum(n for n, _, _ in parts)
            source = max(parts, key=lambda p: (p[0], -p[2]))[2]
            found.append((start, end, sum(n * like for n, like, _ in parts) / words, source))
    return found


# --- Spark ----------------------------------------------------------------------


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")
    )


def _planes(values: np.ndarray) -> bytes:
    """Unsigned numbers as planes of bytes, as many as the largest needs, after their count: few bytes, and equal ones side by side."""
    wide = max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([wide]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide].T.tobytes()


def _numbers(planes: bytes, n: int) -> np.ndarray:
    wide = planes[0]
    out = np.zeros((n, 8), np.uint8)
    out[:, :wide] = np.frombuffer(planes, np.uint8, offset=1).reshape(wide, n).T
    return out.reshape(-1).view("<u8")


_BLOCKS = ["range", "n", "seeds", "base", "docs", "places"]


def _packed(seed: np.ndarray, doc: np.ndarray, at: np.ndarray, ranges: np.ndarray) -> pa.RecordBatch:
    """One row per range of seeds; the seeds are sorted, so ranges stand together."""
    edges = [0, *(np.flatnonzero(ranges[1:] != ranges[:-1]) + 1).tolist(), len(ranges)]
    rows: list[tuple] = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        base = int(doc[a:b].min())
        rows.append((int(ranges[a]), b - a, _planes(seed[a:b]), base, _planes((doc[a:b] - base).view("<u8")), _planes(at[a:b])))
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _BLOCKS)


def _batch_seeds(docs: np.ndarray, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Seeds, documents and places of a batch, in pieces: tables over all words exist for one slice of its texts only."""
    found = [], [], []
    for first, last in slices(texts, SLICE_CHARS):
        hashed = [word_hashes(text) for text in texts[first:last]]
        sizes = np.fromiter(map(len, hashed), np.int64, len(hashed))
        words = np.concatenate([np.empty(0, "<u8"), *hashed])
        for level in LEVELS:
            owner, at, hashes = seeds_of_all(words, sizes, *level)
            for pieces, piece in zip(found, (hashes.view("<u8") >> np.uint64(_SPARED), docs[first:last][owner], at), strict=True):
                pieces.append(piece)
    return found


def _seed_blocks(texts: DataFrame, n_ranges: int) -> DataFrame:
    """All seeds with their document and place, one row per batch of texts and range of seeds (two where a range lies in two quarters).

    A seed that very many documents of a batch hold gets a range of its own for
    this batch, and only its first occurrence is dealt to the seeds of others: no
    seed brings more than a row per batch to one task.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own_range = n_ranges + (TaskContext.get().partitionId() << 32)
        for batch in batches:
            found = _batch_seeds(batch.column(0).to_numpy(), batch.column(1).to_pylist())
            all_seeds, all_docs, all_places = (np.concatenate([*c, np.empty(0, t)]) for c, t in zip(found, ("<u8", np.int64, "i4"), strict=True))
            del found
            quarter = (all_seeds >> np.uint64(62 - _SPARED)).astype(np.uint8)
            for q in range(4):  # sorted one after another, so what sorting needs is a quarter too
                of = np.flatnonzero(quarter == q)
                if not len(of):
                    continue
                seed, doc, at = all_seeds[of], all_docs[of], all_places[of]
                order = np.lexsort((doc, seed))
                seed, doc, at = seed[order], doc[order], at[order]
                ranges = (((seed >> np.uint64(24)) * np.uint64(n_ranges)) >> np.uint64(32)).astype(np.int64)
                new = np.r_[True, seed[1:] != seed[:-1]]
                run_of = np.cumsum(new) - 1
                other = np.r_[True, (doc[1:] != doc[:-1]) | new[1:]]
                hot = np.bincount(run_of, other)[run_of] > HOT_DOCS
                keep = ~hot | new
                yield _packed(seed[keep], doc[keep], at[keep], ranges[keep])
                if hot.any():
                    yield _packed(seed[hot], doc[hot], at[hot], np.full(int(hot.sum()), own_range))
                    own_range += 1

    return texts.mapInArrow(run, "range long, n int, seeds binary, base long, docs binary, places binary")


def _match(blocks: pa.Table) -> pa.Table:
    """Matches of one range: every occurrence of a seed with the seed's first, unless both are of one document."""
    rows = [c.to_pylist() for c in (blocks["n"], blocks["seeds"], blocks["base"], blocks["docs"], blocks["places"])]
    seed = np.concatenate([_numbers(s, n) for n, s in zip(rows[0], rows[1], strict=True)])
    doc = np.concatenate([_numbers(d, n).view("<i8") + base for n, base, d in zip(rows[0], rows[2], rows[3], strict=True)])
    at = np.concatenate([_numbers(p, n) for n, p in zip(rows[0], rows[4], strict=True)]).astype(np.int32)
    order = np.lexsort((at, doc, seed))
    seed, doc, at = seed[order], doc[order], at[order]
    new = np.r_[True, seed[1:] != seed[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(len(seed)), 0))
    of = np.flatnonzero(doc != doc[first])
    doc, src, own, other = doc[of], doc[first[of]], at[of], at[first[of]]
    order = np.lexsort((src, doc))
    doc, src, own, other = (c[order] for c in (doc, src, own, other))
    pairs = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (src[1:] != src[:-1])][: len(doc)])
    lists = [pa.ListArray.from_arrays(np.r_[pairs, len(doc)].astype(np.int32), pa.array(c)) for c in (own, other)]
    return pa.Table.from_arrays([pa.array(doc[pairs]), pa.array(src[pairs]), *lists], ["doc", "src", "own", "other"])


def _alone_near(i: int, own: list[int], other: list[int]) -> bool:
    """Whether a match that no chain took has another on about its diagonal near by, so that words between may agree."""
    for step in (-1, 1):
        j = i + step
        while 0 <= j < len(own) and abs(own[j] - own[i]) <= FAR:
            if abs((own[j] - own[i]) - (other[j] - other[i])) <= BREAK:
                return True
            j += step
    return False


def _near_in_source(found: list[list[int]], other: list[int]) -> list[tuple[int, int, list[list[int]]]]:
    """(lo, hi, chains): chains whose words of the source, lo to hi, overlap or nearly do, so that these are read once."""
    out: list[tuple[int, int, list[list[int]]]] = []
    for chain in sorted(found, key=lambda c: other[c[0]]):
        lo, hi = max(0, other[chain[0]] - REACH), other[chain[-1]] + K + REACH
        if out and lo <= out[-1][1] + FAR:
            out[-1] = (out[-1][0], max(out[-1][1], hi), [*out[-1][2], chain])
        else:
            out.append((lo, hi, [chain]))
    return out


def _chain_rows(matches: DataFrame) -> DataFrame:
    """Chains for every pair of documents that share two seeds; lists of matches are dealt by document and read in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = pa.list_(pa.list_(pa.int32()))
        schema = pa.schema([("doc", pa.int64()), ("src", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("own", lists), ("other", lists)])

        def found(columns: list[np.ndarray]) -> pa.RecordBatch:
            doc, src, own, other = columns
            edge = np.flatnonzero((doc[1:] != doc[:-1]) | (src[1:] != src[:-1])) + 1
            out: list[tuple] = []
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(doc)], strict=True):
                if b - a > 1:
                    pairs = sorted(set(zip(own[a:b].tolist(), other[a:b].tolist(), strict=True)))
                    x, y = [p[0] for p in pairs], [p[1] for p in pairs]
                    good = [c for c in chains(x, y) if len(c) > 1 or _alone_near(c[0], x, y)]
                    for lo, hi, together in _near_in_source(good, y):
                        own_at, other_at = ([[at[i] for i in chain] for chain in together] for at in (x, y))
                        out.append((int(doc[a]), int(src[a]), lo, hi, own_at, other_at))
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(schema.types)], schema=schema)

        held: list[list[np.ndarray]] = []
        for batch in batches:
            places = [batch.column(i) for i in (2, 3)]
            sizes = np.diff(places[0].offsets.to_numpy())
            columns = [np.repeat(batch.column(i).to_numpy(), sizes) for i in (0, 1)] + [p.flatten().to_numpy() for p in places]
            if not len(columns[0]):
                continue
            cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last document may go on
            if cut:
                held.append([c[:cut] for c in columns])
                yield found([np.concatenate(c) for c in zip(*held, strict=True)])
                held = []
            held.append([c[cut:] for c in columns])
        if held:
            yield found([np.concatenate(c) for c in zip(*held, strict=True)])

    dealt = matches.repartition("doc").sortWithinPartitions("doc", "src")
    return dealt.mapInArrow(run, "doc long, src long, lo int, hi int, own array<array<int>>, other array<array<int>>")


def _source_words(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(src, lo, hi, words): hashes of the words lo to hi of the source, one row per distinct range."""
    ranges = wanted.groupBy("src").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    joined = texts.withColumnRenamed("doc", "src").join(ranges, "src").select("src", "text", "ranges")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for src, text, ranges in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = _hashed_where(text.lower().split(), [(r["lo"], r["hi"]) for r in ranges])
                out += [(src, r["lo"], r["hi"], words[r["lo"] : r["hi"]].tobytes()) for r in ranges]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["src", "lo", "hi", "words"])

    return joined.mapInArrow(run, "src long, lo int, hi int, words binary")


def repeated_passages(docs: DataFrame, least_words: int = 50, similarity: float = 0.8) -> DataFrame:
    """Passages of at least ``least_words`` words that an earlier document (smaller doc_id) also holds.

    Rows: doc_id, start and end (code points, end exclusive), n_words,
    source_id (a document that holds the longest piece of it), similarity (the
    share of its words with a partner there, ``similarity`` or more in every
    piece), and on the row of a document's first passage ``rest``, its text
    without the passages, with text_hash, the hash of its text. Every seed is matched with its first occurrence, and
    pieces with different sources are united, so a passage is found however
    many documents hold parts of it. A document counts as a source if it
    shares two seeds, of any length. Rows with null doc_id or text take no part; rows that share a
    doc_id are not compared with each other; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = _texts(docs)
    path = scratch_path(spark, "chains")
    with freed_shuffles(spark):  # seeds and matches are most of what is shuffled; only their chains are read on
        chars = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
        blocks = _seed_blocks(texts, max(1, -(-chars // (SEED_CHARS * RANGE_SEEDS))))
        matches = blocks.groupBy("range").applyInArrow(_match, "doc long, src long, own array<int>, other array<int>")
        _chain_rows(matches).write.parquet(path)
    found = spark.read.parquet(path)
    source = _source_words(texts, found.select("src", "lo", "hi"))
    ready = found.join(source, ["src", "lo", "hi"]).groupBy("doc").agg(
        F.collect_list(F.struct("src", "lo", "own", "other", "words")).alias("chains")
    )
    joined = texts.join(ready, "doc").select("doc", "text", "chains", text_hash(F.col("text")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text, held, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += [(*p, key) for p in _passages_of(doc, text, held, least_words, similarity)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.int64()]
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["doc_id", "start", "end", "n_words", "source_id", "similarity", "rest", "text_hash"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    kinds = "doc_id long, start long, end long, n_words long, source_id long, similarity double, rest string, text_hash long"
    return joined.mapInArrow(run, kinds).distinct()


def without_repeats(docs: DataFrame, least_words: int = 50, similarity: float = 0.8) -> DataFrame:
    """docs without the passages that an earlier document holds; the first document keeps its own.

    A document of which nothing but white space would be left goes; one that
    was blank before stays. All columns stay as they are but ``text``.
    """
    found = repeated_passages(docs, least_words, similarity).where("rest is not null")
    of, key, rest, own = free_names(docs, "of", "key", "rest", "own")
    found = found.select(F.col("doc_id").alias(of), F.col("text_hash").alias(key), F.col("rest").alias(rest))
    keyed = docs.withColumn(own, text_hash(F.col("text").cast("string")))
    on = (F.col("doc_id").cast("long") == F.col(of)) & (F.col(own) == F.col(key))
    cut = keyed.join(found, on, "left").where(F.col(rest).isNull() | F.col(rest).rlike(r"\S"))
    return cut.withColumn("text", F.coalesce(rest, "text")).select(*("`" + c.replace("`", "``") + "`" for c in docs.columns))


def _passages_of(doc: int, text: str, held: list[dict], least_words: int, similarity: float) -> list[tuple]:
    around = [(max(0, own[0] - REACH), own[-1] + K + REACH) for together in held for own in together["own"]]
    words, pieces = _hashed_where(text.lower().split(), around), []
    for together in held:
        lo, other = together["lo"], np.frombuffer(together["words"], "<u8")
        for own, at in zip(together["own"], together["other"], strict=True):
            if own[-1] < len(words):
                for start, end, like in align(words, other, own, [o - lo for o in at], similarity):
                    pieces.append((start, end, like, together["src"]))
    found = merge_pieces(pieces, least_words)
    if not found:
        return []
    spans = [m.span() for m in _WORD.finditer(text)] if len(text.split()) == len(words) else []
    if len(spans) != len(words):  # lower-casing or rare white space changed the words: place them one by one
        spans, at = [], 0
        for word in text.split():
            at = text.index(word, at)
            spans.append((at, at + len(word)))
            at += len(word)
    out, kept, at = [], [], 0
    for start, end, like, source in found:
        a, b = spans[start][0], spans[end - 1][1]
        kept.append(text[at:a])
        at = b
        out.append([doc, a, b, end - start, source, like, None])
    kept.append(text[at:])
    out[0][-1] = "".join(kept)
    return [tuple(o) for o in out]
