"""Digests of watermark ranges: what a range holds, in one small row that adds up.

Count, exclusive or and sum of row hashes merge over batches in any order, and
one side can be taken from the other, so two tables are compared range by range
without moving a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.scalar import month_number
from tidemark.operators.missing import row_digest
from tidemark.types import is_datetime, typed_literal

#: Up to this many ranges are read by a filter with literal bounds; more are joined.
MAX_RANGE_FILTERS = 200

DIGEST_SCHEMA = T.StructType(
    [
        T.StructField("range", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("odd", T.LongType()),
        T.StructField("total", T.DecimalType(38, 0)),
    ]
)


def range_of(dtype: T.DataType, column: str, unit: str | int) -> Column:
    """The range a watermark falls into, as text: a calendar unit for times (in UTC), a width for integers.

    NULL watermarks are a range of their own.
    """
    value = F.col(f"`{column}`")
    if is_datetime(dtype):
        if not isinstance(unit, str):
            raise ValueError(f"{column} needs a calendar unit such as 'month', not {unit!r}")
        if isinstance(dtype, T.TimestampType):
            value = F.to_utc_timestamp(value, F.current_timezone())
        return F.date_format(F.date_trunc(unit, value), "yyyy-MM-dd'T'HH")
    if not isinstance(unit, int) or unit <= 0:
        raise ValueError(f"{column} needs a width above 0, not {unit!r}")
    return (value - F.pmod(value, F.lit(unit).cast(dtype))).cast("decimal(38,0)").cast("string")


def range_digests(df: DataFrame, column: str, unit: str | int, by: Sequence[str] = ()) -> DataFrame:
    """``range, n_rows, odd, total, lo, hi`` of the rows of every range, and of every value of ``by`` if given.

    ``lo`` and ``hi`` are the watermarks the range really spans. ``by`` columns
    take no part in the hashes. Every task sends one row per range it saw.
    """
    hashed = [c for c in df.columns if c not in by]
    first, second = row_digest(df.select(*(f"`{c}`" for c in hashed)))
    rows = df.select(
        *(f"`{c}`" for c in by),
        range_of(df.schema[column].dataType, column, unit).alias("range"),
        F.col(f"`{column}`").alias("at"),
        first.alias("h1"),
        second.cast("decimal(38,0)").alias("h2"),
    )
    return rows.groupBy(*(f"`{c}`" for c in by), "range").agg(
        F.count("*").alias("n_rows"),
        F.bit_xor("h1").alias("odd"),
        F.sum("h2").cast("decimal(38,0)").alias("total"),
        F.min("at").alias("lo"),
        F.max("at").alias("hi"),
    )


def uneven_digests(source: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ranges whose digests differ: ``range``, source minus ledger as ``n_rows, odd, total``, and the source's ``lo, hi``.

    Added to the ledger, these rows make it equal to the source. The ledger may
    have many rows for a range.
    """
    kind = source.schema["lo"].dataType
    ends = [F.lit(None).cast(kind).alias(end) for end in ("lo", "hi")]
    taken = ledger.select("range", (-F.col("n_rows")).alias("n_rows"), "odd", (-F.col("total")).cast("decimal(38,0)").alias("total"), *ends)
    both = source.select("range", "n_rows", "odd", "total", "lo", "hi").unionByName(taken)
    net = both.groupBy("range").agg(
        F.sum("n_rows").alias("n_rows"),
        F.bit_xor("odd").alias("odd"),
        F.sum("total").cast("decimal(38,0)").alias("total"),
        F.max("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )
    return net.filter("n_rows <> 0 OR odd <> 0 OR total <> 0")


def rows_of_ranges(
    df: DataFrame, column: str, ranges: DataFrame, unit: str | int, month_column: str | None = None
) -> DataFrame:
    """Rows of the given ranges (``range, lo, hi``), which are a stored, usually short table.

    A few ranges become literal bounds that the scan can skip by, with the month
    partition if there is one; many are joined by their range. A range without
    ``lo`` that is not the one of NULLs has no row in the source.
    """
    dtype = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if ranges.count() > MAX_RANGE_FILTERS:
        label = range_of(dtype, column, unit)
        wanted = ranges.select(F.col("range").alias("_range"))
        return df.join(wanted, label.eqNullSafe(F.col("_range")), "left_semi")
    keep = F.lit(False)
    # at most MAX_RANGE_FILTERS rows
    for row in ranges.select("range", F.col("lo").cast("string"), F.col("hi").cast("string")).collect():
        if row["range"] is None:
            keep = keep | value.isNull()
        elif row["lo"] is not None:
            lo, hi = (typed_literal(row[end], dtype) for end in ("lo", "hi"))
            inside = (value >= lo) & (value <= hi)
            if month_column is not None:
                inside = inside & F.col(f"`{month_column}`").between(month_number(lo), month_number(hi))
            keep = keep | inside
    return df.filter(keep)
