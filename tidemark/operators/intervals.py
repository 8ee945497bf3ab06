"""Places done per key as intervals that can be united in any order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

#: A cell holds 2**16 places, and a cell of the next level as many cells.
_BITS = 16
_LEVELS = (0, 16, 32, 48)
_LAST = (1 << 63) - 1


def done_intervals(
    df: DataFrame, key: str, seq: str, start: int = 0, step: int = 1, done: Column | None = None
) -> DataFrame:
    """``key, first, last``: the places done, as intervals cut at every 65,536th place.

    Places are those of :func:`contiguous_frontier`; order and repeats do not
    matter. A key with a row that marks no place keeps one row of nulls besides,
    so it stays known. A null key is a key like others, an empty table gives no rows.

    The cuts are at fixed places, so what tasks sort is never more than a cell,
    even if one key holds most of the table, and equal places make equal rows.
    """
    place = F.col(f"`{seq}`").cast("bigint")
    valid = (place >= start) & (F.pmod(place - start, F.lit(step)) == 0)
    if done is not None:
        valid = valid & done
    at = F.when(valid, F.expr(f"(cast(`{seq}` AS bigint) - ({start})) div {step}"))
    rows = df.select(F.col(f"`{key}`").alias("key"), at.alias("lo")).withColumn("hi", F.col("lo"))
    return _places(_joined(rows, _BITS), key, start, step)


def unite_intervals(*parts: DataFrame, key: str, start: int = 0, step: int = 1) -> DataFrame:
    """Union of what :func:`done_intervals` gave for parts of a table, in the same form.

    Parts may overlap, repeat and come in any order; uniting is associative, and
    saying a place twice changes nothing. Only intervals travel, not their rows.
    """
    rows = reduce(DataFrame.unionByName, (_indices(p, key, start, step) for p in parts))
    return _places(_joined(rows, _BITS), key, start, step)


def whole_intervals(pieces: DataFrame, key: str, start: int = 0, step: int = 1) -> DataFrame:
    """``key, first, last`` without the cuts; rows of nulls go.

    Only pieces that touch the border of a cell can go on beyond it, at most two
    a cell. So three rounds over cells of cells join them, none of which sorts
    more than two rows for each of 65,536 cells.
    """
    return _places(_whole(_indices(pieces, key, start, step).dropna(subset=["lo"])), key, start, step)


def interval_gaps(pieces: DataFrame, key: str, start: int = 0, step: int = 1) -> DataFrame:
    """``key, first, last``: the stretches not done before the last done place of a key.

    ``pieces`` are united ones. Gaps within cells come from neighbouring pieces,
    gaps of whole cells from neighbouring cells, level by level; then they are
    joined like intervals. A key that has nothing done has no gap.
    """
    level = _indices(pieces, key, start, step).dropna(subset=["lo"])
    found = []
    for shift in _LEVELS:
        cells = level.withColumn("cell", F.shiftright("lo", _BITS))
        beside = Window.partitionBy("key", "cell").orderBy("lo")
        # the uppermost cell has only the places that a bigint can count
        end = F.shiftleft("cell", _BITS) + F.lit((1 << min(_BITS, 63 - shift)) - 1)
        before = F.coalesce(F.lag("hi").over(beside) + 1, F.shiftleft("cell", _BITS))
        sides = cells.select("*", before.alias("before"), F.lead("lo").over(beside).isNull().alias("last"))
        inner = F.struct(F.col("before").alias("lo"), (F.col("lo") - 1).alias("hi"))
        is_open = F.col("last") & (F.col("hi") < end)
        outer = F.when(is_open, F.struct((F.col("hi") + 1).alias("lo"), end.alias("hi")))
        gaps = sides.select("key", F.explode(F.array(inner, outer)).alias("gap")).filter("gap.lo <= gap.hi")
        upper = F.shiftleft("gap.hi", shift) + F.lit((1 << shift) - 1)
        found.append(gaps.select("key", F.shiftleft("gap.lo", shift).alias("lo"), upper.alias("hi")))
        level = cells.select("key", F.col("cell").alias("lo"), F.col("cell").alias("hi")).distinct()
    # a gap of upper cells lies in one cell of its own level, so the rounds join gaps of all levels
    gaps = _whole(*found).filter(F.col("hi") < _LAST)
    return _places(gaps, key, start, step)


def interval_frontier(pieces: DataFrame, key: str, start: int = 0, step: int = 1) -> DataFrame:
    """``key, frontier, n_ahead`` as :func:`contiguous_frontier` tells them of the rows themselves.

    ``pieces`` are united ones. The first place after a piece is the frontier
    unless another piece begins there: two hash aggregations over the pieces.
    """
    rows = _indices(pieces, key, start, step)

    def mark(at: Column, is_done: bool, n: Column) -> Column:
        return F.struct(at.alias("place"), F.lit(is_done).alias("done"), n.cast("bigint").alias("n"))

    none, lo, hi = F.lit(0), F.col("lo"), F.col("hi")
    marks = F.when(lo.isNotNull(), F.array(mark(lo, True, hi - lo + 1), mark(hi + 1, False, none))).otherwise(
        F.array(mark(none.cast("bigint"), False, none))
    )
    marked = rows.select("key", F.explode(marks).alias("m")).select("key", "m.*")
    # pieces are united, so at most two marks meet at a place and there is nothing to add up before the rows are dealt
    places = _dealt(marked, "key", "place").groupBy("key", "place").agg(F.max("done").alias("done"), F.sum("n").alias("n"))
    started = F.max((F.col("place") == 0) & F.col("done"))
    first_gap = F.when(started, F.min(F.when(~F.col("done"), F.col("place")))).otherwise(F.lit(0).cast("bigint"))
    ends = places.groupBy("key").agg(first_gap.alias("gap"), F.sum("n").alias("n"))
    return ends.select(
        F.col("key").alias(key),
        (F.lit(start).cast("bigint") + F.col("gap") * step).alias("frontier"),
        (F.col("n") - F.col("gap")).alias("n_ahead"),
    )


def _indices(pieces: DataFrame, key: str, start: int, step: int) -> DataFrame:
    at = (F.expr(f"(`{end}` - ({start})) div {step}").alias(name) for end, name in (("first", "lo"), ("last", "hi")))
    return pieces.select(F.col(f"`{key}`").alias("key"), *at)


def _places(rows: DataFrame, key: str, start: int, step: int) -> DataFrame:
    first, last = (F.lit(start).cast("bigint") + F.col(c) * step for c in ("lo", "hi"))
    return rows.select(F.col("key").alias(key), first.alias("first"), last.alias("last"))


def _joined(rows: DataFrame, shift: int) -> DataFrame:
    """Rows of a cell that overlap or touch, joined. One row per beginning is sorted, repeats are not.

    Places compress well, so tasks sized by their shuffled bytes would hold very many: on the lowest level, where the
    rows are, cells are dealt by number.
    """
    cell = F.shiftright("lo", shift).alias("cell")
    rows = rows.groupBy("key", cell, "lo").agg(F.max("hi").alias("hi"))
    if shift == _BITS:
        rows = _dealt(rows, "key", "cell")
    inside = Window.partitionBy("key", "cell").orderBy("lo")
    reached = F.max("hi").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(F.col("lo") - 1 <= reached, 0).otherwise(1)
    return (
        rows.withColumn("apart", apart)
        .withColumn("island", F.sum("apart").over(inside))
        .groupBy("key", "cell", "island")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .select("key", "lo", "hi")
    )


#: Tasks a core of the session, where rows are dealt by number.
_TASKS_A_CORE = 4


def _dealt(rows: DataFrame, *by: str) -> DataFrame:
    """Rows dealt to several tasks a core, but no more than the session shuffles to; adaptive execution does not merge them."""
    spark = rows.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(min(shuffled, _TASKS_A_CORE * spark.sparkContext.defaultParallelism), *by)


def _whole(*levels: DataFrame) -> DataFrame:
    """Pieces joined over the borders of cells; further levels hold pieces of whole cells of theirs."""
    apart, pieces = [], levels[0]
    for n, shift in enumerate(_LEVELS[1:], 1):
        inner = F.lit((1 << shift) - 1)
        touches = (F.col("lo").bitwiseAND(inner) == 0) | (F.col("hi").bitwiseAND(inner) == inner)
        apart.append(pieces.filter(~touches))
        pieces = reduce(DataFrame.unionByName, [pieces.filter(touches), *levels[n : n + 1]])
        pieces = _joined(pieces, min(shift + _BITS, 63))
    return reduce(DataFrame.unionByName, [*apart, pieces])
