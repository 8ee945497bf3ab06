"""Reading what is new: typed watermark predicates and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalar import month_number
from tidemark.operators.ordering import key_positions, page
from tidemark.types import MAX_GATHER_ROWS, SMALL_LIMIT, as_text, is_datetime, typed_literal


def newer_than(df: DataFrame, column: str, after: object, month_column: str | None = None) -> DataFrame:
    """Rows with ``column > after``. NULL watermarks never pass.

    ``after`` None means no lower bound. With ``month_column``, the month
    partition of the layout, older months are pruned too.
    """
    return in_range(df, column, after, None, month_column)


def in_range(
    df: DataFrame, column: str, after: object, upto: object, month_column: str | None = None
) -> DataFrame:
    """Rows with ``after < column <= upto``; either end may be None for open."""
    dtype = df.schema[column].dataType
    if month_column is not None and not is_datetime(dtype):
        raise ValueError(f"{column} has no month to prune by")
    keep: Column = F.col(f"`{column}`").isNotNull()
    if after is not None:
        low = typed_literal(after, dtype)
        keep = keep & (F.col(f"`{column}`") > low)
        if month_column is not None:
            keep = keep & (F.col(month_column) >= month_number(low))
    if upto is not None:
        high = typed_literal(upto, dtype)
        keep = keep & (F.col(f"`{column}`") <= high)
        if month_column is not None:
            keep = keep & (F.col(month_column) <= month_number(high))
    return df.filter(keep)


def read_cut(
    df: DataFrame,
    column: str,
    after: object,
    limit: int,
    max_gather: int = MAX_GATHER_ROWS,
    month_column: str | None = None,
) -> str | None:
    """Watermark of the ``limit``-th new row as text (of the last, if fewer; None if none).

    Reads the watermark column only. The usual small backlog is one aggregate;
    a long one is cut by a top-k if that is small, else from key positions.
    """
    new = newer_than(df, column, after, month_column).select(f"`{column}`")
    dtype = df.schema[column].dataType

    def text(row: DataFrame) -> str | None:
        return row.select(as_text("cut", dtype).alias("cut")).first()["cut"]

    def top() -> DataFrame:
        return new.orderBy(f"`{column}`").limit(limit).agg(F.max(f"`{column}`").alias("cut"))

    if limit <= min(SMALL_LIMIT, max_gather):
        return text(top())
    backlog = new.agg(F.count("*").alias("n"), F.max(f"`{column}`").alias("cut"))
    backlog = backlog.select("n", as_text("cut", dtype).alias("cut")).first()
    if backlog["n"] <= limit:
        return backlog["cut"]
    if backlog["n"] <= max_gather:
        return text(top())
    return text(key_positions(new, [column]).filter(F.col("start") < limit).agg(F.max(f"`{column}`").alias("cut")))


def tie_safe_batch(
    df: DataFrame, column: str, after: object, limit: int, max_gather: int = MAX_GATHER_ROWS
) -> DataFrame:
    """All rows up to and including the watermark of the ``limit``-th new row.

    The cut is known beforehand, so the batch itself is a filter with literal
    bounds that the scan can push down; it is neither sorted nor gathered.
    """
    upto = read_cut(df, column, after, limit, max_gather)
    if upto is None:
        return df.filter(F.lit(False))
    return in_range(df, column, after, upto)


def strict_batch(
    df: DataFrame, column: str, after: object, limit: int, *tiebreak: str, max_gather: int = MAX_GATHER_ROWS
) -> DataFrame:
    """The first ``limit`` rows above the watermark, in order.

    Only for columns without ties, as the next strict read skips the rest of a
    group of equal watermarks: ``tiebreak`` decides which of them come, and the
    whole key must be unique where the batch ends. A page of what is newer: its
    ends are looked up among the keys, and no task gathers the rows.
    """
    return page(newer_than(df, column, after), [column, *tiebreak], 0, limit, max_gather)


def batch_stats(batch: DataFrame, column: str, previous: object = None) -> DataFrame:
    """One row: ``n_rows`` and ``new_watermark``, the old one if the batch has none."""
    old = typed_literal(previous, batch.schema[column].dataType)
    return batch.agg(
        F.count("*").alias("n_rows"), F.coalesce(F.max(f"`{column}`"), old).alias("new_watermark")
    )
