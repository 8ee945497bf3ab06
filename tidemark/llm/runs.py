"""Periodic runs of words: stretches in which a short phrase repeats at least three times.

A run of period q that starts at s and is ``length`` words long is the same
thing as a maximal pair: the suffixes at s and s + q agree on exactly
``length - q`` words and the words before them differ. So runs are read off
the tree of LCP intervals, bottom-up. Every node keeps its positions in lists
by the word to their left; when two children meet, positions with different
left words make maximal pairs, and only pairs as near as half of what they
share (three periods or more) are looked up.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: A run is at least so many words and so many periods long.
LEAST_WORDS = 24
LEAST_PERIODS = 3
_RUN = "struct<start:long,length:long,period:long>"


def _shared(least_words: int, least_periods: int) -> int:
    """Words that the two suffixes of any run share at least: length - q, smallest over all periods q."""
    return min(max(least_words - q, (least_periods - 1) * q) for q in range(1, least_words + 1))


def _repeat_somewhere(codes: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the texts that hold some ``width`` words twice (or, by a collision of hashes, seem to)."""
    if len(codes) < width:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        spread = np.uint64(0x9E3779B97F4A7C15)
        each = (codes.astype(np.uint64) + np.uint64(1)) * spread
        each ^= each >> np.uint64(29)
        whole = None
        done, step = 0, 1
        # Windows of 1, 2, 4, ... words; those in the binary form of the width are laid end to end.
        while step <= width:
            if width & step:
                part = each[done : len(codes) - step + 1]
                whole = part.copy() if whole is None else whole[: len(part)] * np.uint64(0xBF58476D1CE4E5B9) + part
                whole ^= whole >> np.uint64(31)
                done += step
            each = each[:-step] * np.uint64(0x94D049BB133111EB) + each[step:]
            each ^= each >> np.uint64(31)
            step *= 2
        whole = whole[: len(codes) - width + 1]
        first, last = doc[: len(whole)], doc[width - 1 :]
        inside = np.flatnonzero(first == last)
        marked = whole[inside] * spread + first[inside].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(marked, kind="stable")
    twice = np.flatnonzero(marked[order[1:]] == marked[order[:-1]])
    return np.unique(doc[inside[order[twice]]])


def _suffix_order(first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and for every level k the ranks of the 2**k words from each place.

    ``first`` ends every text with a value of its own, so no suffix reaches
    into the next. A rank is the number of places with a smaller prefix; at
    each level only places that still share theirs are sorted again.
    """
    n = len(first)
    order = np.argsort(first, kind="stable")
    sorted_first = first[order]
    starts = np.flatnonzero(np.r_[True, sorted_first[1:] != sorted_first[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.r_[starts, n]))
    levels, step = [rank.astype(np.int32)], 1
    open_ = order[np.repeat(np.diff(np.r_[starts, n]) > 1, np.diff(np.r_[starts, n]))]
    while len(open_):
        ahead = open_ + step
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        both = rank[open_] * (n + 1) + second
        by = np.argsort(both, kind="stable")
        open_, both = open_[by], both[by]
        group = rank[open_]
        new_group = np.r_[True, group[1:] != group[:-1]]
        new_rank = np.r_[True, both[1:] != both[:-1]]
        places = np.arange(len(open_))
        group_at = np.maximum.accumulate(np.where(new_group, places, 0))
        rank_at = np.maximum.accumulate(np.where(new_rank, places, 0))
        rank[open_] = group + (rank_at - group_at)
        levels.append(rank.astype(np.int32))
        step *= 2
        single = new_rank & np.r_[new_rank[1:], True]
        open_ = open_[~single]
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at a and b have in common."""
    a, b = a.copy(), b.copy()
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = np.flatnonzero(levels[k][a] == levels[k][b])
        length[same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return length


class _Node:
    """Positions below an LCP interval: all of them in order, and by the word to their left."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: int):
        self.places, self.classes = [place], {left: [place]}

    def near(self, place: int, left: int, reach: int, left_of: dict[int, int]) -> Iterator[int]:
        """Positions within reach of this one whose left word differs from its own."""
        lo, hi = place - reach, place + reach
        a, b = bisect_left(self.places, lo), bisect_right(self.places, hi)
        if b - a <= len(self.classes):
            yield from (p for p in self.places[a:b] if left_of[p] != left)
            return
        for other, places in self.classes.items():
            if other != left:
                yield from places[bisect_left(places, lo) : bisect_right(places, hi)]


def _maximal_pairs(places: list[int], lefts: list[int], lcps: list[int], periods: int) -> Iterator[tuple[int, int, int]]:
    """(start, distance, shared words) of the maximal pairs of one interval that are near enough to be runs.

    ``places`` are in suffix order, ``lcps[t]`` is what t shares with t - 1.
    Positions of the smaller child are looked up in the larger and then join
    it, so each moves a logarithmic number of times.
    """
    left_of = dict(zip(places, lefts, strict=True))

    def meet(a: _Node, b: _Node, shared: int) -> Iterator[tuple[int, int, int]]:
        reach = shared // (periods - 1)
        for place in b.places:
            for other in a.near(place, left_of[place], reach, left_of):
                yield min(place, other), abs(place - other), shared
        for place in b.places:
            insort(a.places, place)
        for left, held in b.classes.items():
            mine = a.classes.setdefault(left, [])
            for place in held:
                insort(mine, place)

    stack: list[tuple[int, _Node]] = []
    for t in range(len(places) + 1):
        shared = lcps[t] if t < len(places) and stack else 0
        while len(stack) > 1 and stack[-1][0] > shared:
            level, top = stack.pop()
            below_level, below = stack.pop()
            if len(top.places) > len(below.places):
                top, below = below, top
            yield from meet(below, top, level)
            stack.append((below_level, below))
        if t < len(places):
            stack.append((shared, _Node(places[t], lefts[t])))


def find_runs(codes: np.ndarray, sizes: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period) by number of text, ordered by start and period.

    ``codes`` are the words of all texts one after another, ``sizes`` the
    words of each. Only texts in which enough words stand twice are sorted,
    and only intervals with two different left words and two places near
    enough are walked; neither can drop a run.
    """
    width = _shared(least_words, least_periods)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    chosen = _repeat_somewhere(codes, doc, width)
    if not len(chosen):
        return {}
    # The chosen texts end to end, each closed by a value that stands nowhere else.
    kept_sizes = sizes[chosen]
    closed = np.cumsum(kept_sizes + 1)
    begin = closed - kept_sizes - 1
    text = np.repeat(np.arange(len(chosen)), kept_sizes + 1)
    within = np.arange(closed[-1]) - begin[text]
    kinds = int(codes.max()) + 2
    source = np.minimum((ends - sizes)[chosen][text] + within, len(codes) - 1)
    last = within == kept_sizes[text]
    first = text * kinds + np.where(last, kinds - 1, codes[source])

    order, levels = _suffix_order(first)
    if len(levels) <= width.bit_length() - 1:
        return {}
    level = levels[width.bit_length() - 1]
    maybe = np.flatnonzero(level[order[1:]] == level[order[:-1]])
    shared = np.zeros(len(order) + 1, np.int64)
    shared[maybe + 1] = _common(levels, order[maybe], order[maybe + 1])
    del levels
    joined = shared >= width
    member = np.flatnonzero(joined[:-1] | joined[1:])
    if not len(member):
        return {}
    place = order[member]
    lcp = np.where(joined[member], shared[member], 0)
    heads = np.flatnonzero(lcp == 0)
    left = np.where(within[place] > 0, first[place - 1], -1)
    cluster = np.cumsum(lcp == 0) - 1
    many = np.minimum.reduceat(left, heads) != np.maximum.reduceat(left, heads)
    by = np.lexsort((place, cluster))
    gap = np.diff(place[by], prepend=-1)
    gap[heads] = len(first)
    close = np.minimum.reduceat(gap, heads) * (least_periods - 1) <= np.maximum.reduceat(lcp, heads)

    found: dict[int, dict[tuple[int, int], int]] = {}
    tails = np.r_[heads[1:], len(member)]
    for c in np.flatnonzero(many & close):
        part = slice(heads[c], tails[c])
        for start, period, common in _maximal_pairs(place[part].tolist(), left[part].tolist(), lcp[part].tolist(), least_periods):
            length = common + period
            if length >= least_words:
                runs = found.setdefault(int(text[start]), {})
                key = (int(within[start]), length)
                runs[key] = min(period, runs.get(key, period))
    return {int(chosen[t]): sorted((s, n, p) for (s, n), p in runs.items()) for t, runs in found.items()}


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest exact length / period; ties go to the smaller start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run holds after its first period."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    covered = np.cumsum(edge)[:-1] > 0
    return [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """Runs of every text, and the text without their repeats: doc_id, runs, strongest, collapsed.

    ``runs`` holds (start, length, period) ordered by start and period, starts
    being word numbers from 0; ``strongest`` is the one of greatest
    length / period (ties: smaller start, then period), null without runs;
    ``collapsed`` joins the words that stay by single blanks. Words are what
    stands between ASCII white space.

    A null or empty text has no words, no runs and an empty collapsed text. A
    very long text is one record: its memory grows with words times the
    logarithm of its longest repeat. Rows with repeated or null ids give a row
    each. Other columns, whatever their names, are not read; an empty table
    gives no rows.
    """
    names = ["doc_id", "runs", "strongest", "collapsed"]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            texts = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            flat = pa.array([w for words in texts for w in words], pa.binary())
            codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64) if len(flat) else np.empty(0, np.int64)
            found = find_runs(codes, sizes, least_words, least_periods)
            rows = [found.get(i, []) for i in range(len(texts))]
            shape = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in rows]
            best = [dict(zip(("start", "length", "period"), strongest(runs), strict=True)) if runs else None for runs in rows]
            texts = [b" ".join(_kept(words, runs) if runs else words) for words, runs in zip(texts, rows, strict=True)]
            columns = [batch.column(0), pa.array(shape, pa.list_(run)), pa.array(best, run), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(scan, f"doc_id long, runs array<{_RUN}>, strongest {_RUN}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, chosen by crc32(doc_id), end in a repeating phrase: doc_id and text.

    With h that checksum, g = h div 10, n words and h % 10 = 0, the words from
    a = g % n on repeat the first p = 1 + (n - a) div (3 + g % 8) of them. Null
    ids and texts without words stay as they are.
    """
    sum_ = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    chosen = F.coalesce(sum_ % 10 == 0, F.lit(False))
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = texts.select("*", words.alias("words"), F.floor(sum_ / 10).alias("g"))
    n = F.size("words")
    a = F.when(n > 0, F.col("g") % n)
    texts = texts.select("*", a.cast("int").alias("a"), (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int").alias("p"))
    again = F.transform("words", lambda w, i: F.when(i >= F.col("a"), F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))).otherwise(w))
    return texts.select("doc_id", F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """The digest columns of ``periodic_runs``: one row per document, all runs as one checksum."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = [F.col(f"strongest.{name}").alias(name) for name in ("start", "length", "period")]
    exponent = F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli")
    digests = [F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")]
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, exponent, *digests)
