"""Contiguous progress per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def contiguous_frontier(
    df: DataFrame, key: str, seq: str, start: int = 0, step: int = 1, done: Column | None = None
) -> DataFrame:
    """``key, frontier, n_ahead``: the first place not done yet, and how many are done beyond it.

    Places are ``start, start + step, ...``; a row marks its place as done (only
    where ``done`` holds, if given). Order and repeats do not matter, places
    below ``start`` or off the grid are ignored, every key keeps a row.

    The frontier is the least place that is not done but follows a done one, or
    ``start`` if that is not done. Both facts are marked per place, so the work
    is two hash aggregations by (key, place) and by key: no window and no sort,
    and a key with much of the table is spread over all tasks.
    """
    place = F.col(seq).cast("bigint")
    valid = (place >= start) & (F.pmod(place - start, F.lit(step)) == 0)
    if done is not None:
        valid = valid & done
    valid = F.coalesce(valid, F.lit(False))

    def mark(at: Column, is_done: bool) -> Column:
        return F.struct(at.cast("bigint").alias("place"), F.lit(is_done).alias("done"))

    marks = F.when(valid, F.array(mark(place, True), mark(place + step, False))).otherwise(
        F.array(mark(F.lit(start), False))
    )
    places = (
        df.select(F.col(key), F.explode(marks).alias("m"))
        .groupBy(key, F.col("m.place").alias("place"))
        .agg(F.max("m.done").alias("done"))
    )
    started = F.max((F.col("place") == start) & F.col("done"))
    first_gap = F.min(F.when(~F.col("done"), F.col("place")))
    frontier = F.when(started, first_gap).otherwise(F.lit(start).cast("bigint"))
    below = F.expr(f"(frontier - ({start})) div {step}")
    return (
        places.groupBy(key)
        .agg(frontier.alias("frontier"), F.count_if("done").alias("n_done"))
        .select(key, "frontier", (F.col("n_done") - below).alias("n_ahead"))
    )
