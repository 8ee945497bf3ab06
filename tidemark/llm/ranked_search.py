"""Ranked lexical search over a length-stratified index.

Scores depend on a document's length only through its normaliser m, so
documents of equal m form a stratum, and within a stratum the postings of a
term are listed by tf: the impact of a list is computed once, whatever its
length. Strata are dealt whole to shards, the largest in pieces. In a shard an
item visits strata in the order of what they can hold at best and stops when
none left can enter its list.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import scratch_path

#: Characters between terms, and the numbers of the score.
NO_TERM = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
TERM = f"[^{NO_TERM}]+"
LENGTH_PARTS, FLAT_PARTS = 90, 10
SCALE, TF_WEIGHT, NORM_WEIGHT, TERM_SCALE = 1_000_000_000, 1000, 8, 1000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every byte to itself, to lower case, or to a blank; and whether it belongs to a term.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_IN_TERM = np.array([b != 32 for b in _BYTES])

#: Words of a shard, and of the pieces into which larger strata are cut.
SHARD_WORDS = 1_000_000
PIECE_WORDS = 100_000
#: Items that are ranked together, and strata that an item visits first.
ITEM_BLOCK = 2048
FIRST_STRATA = 8


@dataclass(frozen=True)
class LexicalIndex:
    """Postings (shard, term, df, m, copy, tf, n, docs) and the totals that scores need.

    A row holds one term's postings in one shard: ``docs`` list after list,
    ``n`` the length of each list, ``m``, ``copy`` and ``tf`` what its documents
    have in common. ``copy`` tells rows with the same doc_id apart.
    """

    postings: DataFrame
    documents: int
    words: int


def _written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a stored table, whose size the optimizer knows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _count_terms(texts: pa.Array) -> pa.Array:
    """Terms of every text, counted over the bytes of the batch: where a term byte follows another one or a border."""
    array = texts.cast(pa.large_binary())
    ends = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    inside = _IN_TERM[np.frombuffer(array.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begin = ends[:-1] - ends[0]
    at = begin[begin < len(inside)]
    begins[at] = inside[at]
    before = np.r_[0, np.cumsum(begins)]
    return pa.array(before[ends[1:] - ends[0]] - before[begin], pa.int64())


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers from each start up to its end, one range after another."""
    sizes = ends - starts
    total = np.cumsum(sizes)
    return np.repeat(starts - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Where any of the sorted columns changes."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[starts, len(values)], pa.int32()), pa.array(values, kind))


_POSTINGS = "shard int, term string, df long, m array<long>, copy array<int>, tf array<int>, n array<int>, docs array<long>"


def _post(rows: pa.Table) -> pa.Table:
    """The postings of one shard from its texts."""
    shard = rows["shard"][0].as_py()
    rows = rows.sort_by([("m", "ascending"), ("doc_id", "ascending")])
    m, ids = (rows[c].to_numpy() for c in ("m", "doc_id"))
    same = np.argsort(ids, kind="stable")
    first = _firsts(ids[same])
    copy = np.empty(len(ids), np.int64)
    copy[same] = np.arange(len(ids)) - np.repeat(first, np.diff(np.r_[first, len(ids)]))
    words = [t.translate(_BYTES).split() for t in rows["text"].cast(pa.binary()).to_pylist()]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    named = pa.array([w for text in words for w in text], pa.binary()).dictionary_encode()
    del words
    order = pc.sort_indices(named.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    term = place[named.indices.to_numpy()]
    both, tf = np.unique(term * len(ids) + np.repeat(np.arange(len(ids)), sizes), return_counts=True)
    term, doc = both // len(ids), both % len(ids)
    by = np.lexsort((doc, tf, copy[doc], m[doc], term))
    term, doc, tf = term[by], doc[by], tf[by]
    lists = _firsts(term, m[doc], copy[doc], tf)
    terms = _firsts(term)
    inner = np.searchsorted(lists, terms)
    columns = [
        pa.array(np.full(len(terms), shard, np.int32)), named.dictionary.take(order).cast(pa.string()), pa.array(np.diff(np.r_[terms, len(term)])),
        _lists(m[doc[lists]], inner, pa.int64()), _lists(copy[doc[lists]], inner, pa.int32()), _lists(tf[lists], inner, pa.int32()),
        _lists(np.diff(np.r_[lists, len(term)]), inner, pa.int32()), _lists(ids[doc], terms, pa.int64()),
    ]
    return pa.Table.from_arrays(columns, ["shard", "term", "df", "m", "copy", "tf", "n", "docs"])


def build_index(docs: DataFrame, path: str | None = None) -> LexicalIndex:
    """Index all documents (doc_id, text) by their lower-cased terms; the postings are written to ``path``.

    Lengths are counted first, since m needs the totals; texts are then dealt
    to shards of about ``SHARD_WORDS`` words, a stratum to one place unless it
    holds more than ``PIECE_WORDS``. Texts without terms, null texts and rows
    without doc_id are no documents; rows that repeat a doc_id are documents of
    their own. A very long text is one document in one shard. Other columns are
    not read; an empty table gives an empty index.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null and text is not null")
    sized = texts.withColumn("size", F.arrow_udf(_count_terms, "long")("text")).where("size > 0")
    strata = _written(sized.groupBy("size").agg(F.count("*").alias("docs")), "lengths")
    n, words = strata.agg(F.sum("docs"), F.sum(F.col("docs") * F.col("size"))).first()
    n, words = n or 0, words or 0
    m = F.lit(FLAT_PARTS) + F.expr(f"(cast({LENGTH_PARTS} as bigint) * size * {max(n, 1)}L) div {max(words, 1)}L")
    pieces = F.ceil(F.sum(F.col("docs") * F.col("size")) / PIECE_WORDS).cast("int").alias("pieces")
    large = strata.groupBy(m.alias("m")).agg(pieces).where("pieces > 1")
    shards = max(1, -(-words // SHARD_WORDS))
    salt = F.pmod(F.xxhash64("doc_id", "text"), F.coalesce("pieces", F.lit(1)))
    dealt = sized.withColumn("m", m).join(large, "m", "left")
    dealt = dealt.select(F.pmod(F.xxhash64("m", salt), F.lit(shards)).cast("int").alias("shard"), "m", "doc_id", "text")
    path = path or scratch_path(spark, "postings")
    dealt.groupBy("shard").applyInArrow(_post, _POSTINGS).write.parquet(path)
    return LexicalIndex(spark.read.parquet(path), n, words)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and where the list of each row starts."""
    array = column.combine_chunks()
    offsets = array.offsets.to_numpy().astype(np.int64)
    return array.flatten().to_numpy(), offsets - offsets[0]


class _Shard:
    """Postings of the asked terms in one shard: lists, (term, stratum) pairs and their bounds."""

    def __init__(self, rows: pa.Table):
        m, at = _flat(rows["m"])
        copy, tf, n = (_flat(rows[c])[0].astype(np.int64) for c in ("copy", "tf", "n"))
        docs = _flat(rows["docs"])[0]
        weight = np.repeat(rows["w"].to_numpy(), np.diff(at))
        impact = weight * ((SCALE * tf) // (TF_WEIGHT * tf + NORM_WEIGHT * m))
        self.m, stratum = np.unique(m, return_inverse=True)
        pairs = _firsts(np.repeat(np.arange(rows.num_rows), np.diff(at)), stratum)
        self.stratum, self.bound = stratum[pairs], np.maximum.reduceat(impact, pairs)
        ends = np.r_[0, np.cumsum(n)]
        self.begin, self.end = ends[pairs], ends[np.r_[pairs[1:], len(m)]]
        # A term's pairs stand together: from pair_at[row] up to pair_at[row + 1].
        self.pair_at = np.searchsorted(pairs, at)
        self.impact = np.repeat(impact, n)
        copies = np.repeat(copy, n)
        if copies.any():
            both, self.doc = np.unique(np.stack([docs, copies]), axis=1, return_inverse=True)
            self.ids = both[0]
        else:
            self.ids, self.doc = np.unique(docs, return_inverse=True)

    def best(self, terms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """doc_ids and scores of the k best documents for these rows (terms), best first, ties to the smaller id."""
        pairs = _ranges(self.pair_at[terms], self.pair_at[terms + 1])
        bound = np.zeros(len(self.m), np.int64)
        np.add.at(bound, self.stratum[pairs], self.bound[pairs])
        order = np.argsort(-bound, kind="stable")
        order = order[: np.count_nonzero(bound)]
        turn = np.full(len(bound), len(bound))
        turn[order] = np.arange(len(order))
        turns = turn[self.stratum[pairs]]
        by = np.argsort(turns, kind="stable")
        pairs, turns = pairs[by], turns[by]
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        done, step = 0, FIRST_STRATA
        while done < len(order) and (len(ids) < k or bound[order[done]] >= scores[-1]):
            a, b = np.searchsorted(turns, (done, done + step))
            at = _ranges(self.begin[pairs[a:b]], self.end[pairs[a:b]])
            docs, inverse = np.unique(self.doc[at], return_inverse=True)
            sums = np.zeros(len(docs), np.int64)
            np.add.at(sums, inverse, self.impact[at])
            ids, scores = np.concatenate([ids, self.ids[docs]]), np.concatenate([scores, sums])
            top = np.lexsort((ids, -scores))[:k]
            top = top[scores[top] > 0]
            ids, scores = ids[top], scores[top]
            done, step = done + step, step * 2
        return ids, scores


def _rank(k: int):
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        shard = _Shard(rows)
        items, at = _flat(rows["items"])
        term = np.repeat(np.arange(rows.num_rows), np.diff(at))
        by = np.argsort(items, kind="stable")
        items, term = items[by], term[by]
        cuts = _firsts(items)
        out: list[list[np.ndarray]] = [[], [], []]
        for a, b in zip(cuts, np.r_[cuts[1:], len(items)], strict=True):
            ids, scores = shard.best(term[a:b], k)
            for column, values in zip(out, (np.full(len(ids), items[a]), ids, scores), strict=True):
                column.append(values)
        return pa.Table.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out], schema=schema)

    return run


def search(index: LexicalIndex, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents of each item (item_id, text): item_id, rank, doc_id, score.

    Equal scores go by ascending doc_id; documents with score 0 are not
    returned, so an item may have fewer rows or none. Rows without item_id or
    text ask nothing; rows that repeat an item_id are one item with the terms
    of all of them. Terms of an item count once. What is asked is a stored
    table, so it is broadcast to the postings only if its size allows. Items are ranked in blocks of
    about ``ITEM_BLOCK``, each against all shards; a shard gives at most k
    documents an item.
    """
    asked = items.select(F.col("item_id").cast("long"), F.explode(_terms(F.col("text").cast("string"))).alias("term"))
    asked = _written(asked.where("item_id is not null").distinct(), "asked")
    blocks = max(1, -(-asked.select("item_id").distinct().count() // ITEM_BLOCK))
    df = index.postings.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    share = F.lit(float(2 * index.documents + 2)) / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(F.lit(float(TERM_SCALE)) * F.log(share)).cast("long").alias("w")
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block")
    asks = asked.join(df.select("term", weight), "term").groupBy("term", "w", block).agg(F.collect_list("item_id").alias("items"))
    asks = _written(asks, "asks")
    hits = index.postings.drop("df").join(asks, "term")
    found = hits.drop("term").groupBy("shard", "block").applyInArrow(_rank(k), "item_id long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
