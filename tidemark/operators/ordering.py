"""Positions in sort order without gathering a table anywhere.

A page by offset makes the engine keep ``offset + limit`` rows in one task. The
operators here count rows per key instead, lay the counts out by key range and
add up the ranges, so every position is known while each task sees one range.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import scratch_root
from tidemark.types import MAX_GATHER_ROWS, as_text, fits_one_task, typed_literal


def key_positions(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """One row per distinct key: the key, ``n_rows``, ``start`` and ``stop``.

    The rows of a key take the 0-based places ``start <= place < stop``. Counting
    comes first, so a key that holds much of the table is one narrow row. The
    key ranges are checkpointed: the pass that adds them up and the pass that
    places keys must see the same ranges, also when executors are lost.
    """
    scratch_root(df.sparkSession)
    counts = df.groupBy(*_quoted(keys)).agg(F.count("*").alias("n_rows"))
    by_range = [partitions, *_quoted(keys)] if partitions else _quoted(keys)
    ranges = (
        counts.repartitionByRange(*by_range)
        .withColumn("_range", F.spark_partition_id())
        .checkpoint()
    )
    # one row per range, never per key
    totals = {row["_range"]: row["n"] for row in ranges.groupBy("_range").agg(F.sum("n_rows").alias("n")).collect()}
    sizes = [totals.get(i, 0) for i in range(max(totals, default=0) + 1)]
    before = F.lit([0, *accumulate(sizes)][: len(sizes)]).cast("array<bigint>")
    running = F.sum("n_rows").over(
        Window.partitionBy("_range").orderBy(*_quoted(keys)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        ranges.withColumn("stop", F.element_at(before, F.col("_range") + 1) + running)
        .withColumn("start", F.col("stop") - F.col("n_rows"))
        .select(*_quoted(keys), "n_rows", "start", "stop")
    )


def batch_ledger(df: DataFrame, keys: Sequence[str], batch_rows: int) -> DataFrame:
    """Fixed-size batches in key order: ``batch_no, n_rows, lo, hi``.

    ``lo`` and ``hi`` are the first and last key (a struct for several keys). A
    key that spans several batches is split by arithmetic on its places.
    """
    first = F.expr(f"start div {batch_rows}")
    last = F.expr(f"(stop - 1) div {batch_rows}")
    key = _quoted(keys)[0] if len(keys) == 1 else F.struct(*_quoted(keys))
    spans = key_positions(df, keys).withColumn("batch_no", F.explode(F.sequence(first, last)))
    inside = F.least("stop", (F.col("batch_no") + 1) * batch_rows) - F.greatest("start", F.col("batch_no") * batch_rows)
    return spans.groupBy("batch_no").agg(
        F.sum(inside).alias("n_rows"), F.min(key).alias("lo"), F.max(key).alias("hi")
    )


def tie_safe_batches(df: DataFrame, column: str, batch_rows: int) -> DataFrame:
    """Batches that never split equal values: ``batch_no, n_rows, lo, hi``, ends inclusive.

    A value belongs to the batch its first row falls into, so a batch exceeds
    ``batch_rows`` by at most its last tie group. NULLs take no part.
    """
    return (
        key_positions(df.filter(F.col(f"`{column}`").isNotNull()), [column])
        .groupBy(F.expr(f"start div {batch_rows}").alias("batch_no"))
        .agg(F.sum("n_rows").alias("n_rows"), F.min(f"`{column}`").alias("lo"), F.max(f"`{column}`").alias("hi"))
    )


def page(
    df: DataFrame, keys: Sequence[str], offset: int, limit: int, max_gather: int = MAX_GATHER_ROWS
) -> DataFrame:
    """``ORDER BY keys LIMIT limit OFFSET offset``, sorted; the keys must order rows totally at both ends.

    Only the first and last key are looked up: from a top-k of keys if every
    task may send what it would keep, else from key positions (count per key,
    range shuffle, checkpoint). The page itself is a range filter and a
    distributed sort. A page that would cut a group of equal keys is an error,
    whatever its size.
    """
    if not keys:
        raise ValueError("paging needs an order key")
    if limit <= 0:
        return df.filter(F.lit(False))
    if fits_one_task(df, offset + limit + 1, max_gather):
        ends = _ends_by_top(df.select(*_quoted(keys)), keys, offset, limit)
    else:
        ends = _ends_by_position(df, keys, offset, limit)
    if ends is None:
        return df.filter(F.lit(False))
    return df.filter(_keys_between(df, keys, *ends)).orderBy(*_quoted(keys))


def last_rows(df: DataFrame, keys: Sequence[str], n_rows: int, count: int, max_gather: int = MAX_GATHER_ROWS) -> DataFrame:
    """The last of ``n_rows`` rows in key order, ``count`` of them, sorted: a page found from the far end if that is nearer."""
    if count <= 0:
        return df.filter(F.lit(False))
    if not fits_one_task(df, count + 1, max_gather):
        return page(df, keys, n_rows - count, count, max_gather)
    ends = _ends_by_top(df.select(*_quoted(keys)), keys, 0, count, descending=True)
    return df.filter(_keys_between(df, keys, *ends)).orderBy(*_quoted(keys)) if ends else df.filter(F.lit(False))


def _quoted(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"`{k}`") for k in keys]


def _cut_error(keys: Sequence[str]) -> ValueError:
    return ValueError(f"the page cuts a group of equal {list(keys)}: add a tie-breaking key")


def _ends_by_top(df: DataFrame, keys: Sequence[str], offset: int, limit: int, descending: bool = False):
    """First and last key of a page as texts, from the top keys; one key beyond either end shows a cut group."""
    way = [c.desc_nulls_last() if descending else c.asc_nulls_first() for c in _quoted(keys)]
    top = df.orderBy(*way).limit(offset + limit + 1)
    place = F.row_number().over(Window.orderBy(*way)) - 1
    wanted = [p for p in (offset - 1, offset, offset + limit - 1, offset + limit) if p >= 0]
    texts = F.array(*(as_text(F.col(f"`{k}`"), df.schema[k].dataType) for k in keys))
    numbered = top.select(texts.alias("texts"), place.alias("place"))
    last = F.max("place").over(Window.partitionBy())
    found = {r["place"]: r["texts"] for r in numbered.select("*", last.alias("last")).filter(F.col("place").isin(wanted) | (F.col("place") == F.col("last"))).collect()}
    if offset not in found:
        return None
    end = min(offset + limit - 1, max(found))
    for inner, outer in ((offset, offset - 1), (end, end + 1)):
        if outer in found and found[inner] == found[outer]:
            raise _cut_error(keys)
    return (found[end], found[offset]) if descending else (found[offset], found[end])


def _ends_by_position(df: DataFrame, keys: Sequence[str], offset: int, limit: int):
    key = F.struct(*_quoted(keys))
    inside = key_positions(df, keys).filter((F.col("start") < offset + limit) & (F.col("stop") > offset))
    ends = inside.agg(
        F.min(key).alias("lo"), F.max(key).alias("hi"), F.min("start").alias("start"), F.max("stop").alias("stop")
    )
    row = ends.select(_texts(df, keys, "lo"), _texts(df, keys, "hi"), "start", "stop").first()
    if row["start"] is None:
        return None
    if row["start"] < offset or row["stop"] > offset + limit:
        raise _cut_error(keys)
    return row["lo"], row["hi"]


def _texts(df: DataFrame, keys: Sequence[str], end: str) -> Column:
    return F.array(*(as_text(F.col(end)[k], df.schema[k].dataType) for k in keys)).alias(end)


def _keys_between(df: DataFrame, keys: Sequence[str], lo: Sequence, hi: Sequence) -> Column:
    """``lo <= keys <= hi``; the bound on the first key alone also reaches the scan."""
    low = [typed_literal(v, df.schema[k].dataType).alias(k) for k, v in zip(keys, lo)]
    high = [typed_literal(v, df.schema[k].dataType).alias(k) for k, v in zip(keys, hi)]
    key = F.struct(*_quoted(keys))
    within = (key >= F.struct(*low)) & (key <= F.struct(*high))
    if lo[0] is not None:
        within = F.col(f"`{keys[0]}`").between(low[0], high[0]) & within
    return within
