"""Comparing source and target: counts, statuses, checksums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.watermark import union_all


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table, n_rows`` of many tables in one job."""
    return union_all(
        [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows") for name, df in tables.items()]
    )


def reconcile_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``table, src, dst, diff, status``; status is match, target_short or target_extra.

    A short target may be right where its rows are folded by key; it is reported,
    never raised.
    """
    sides = union_all(
        [
            side.agg(F.count("*").alias("n")).select(
                F.lit(name).alias("table"),
                (F.col("n") if is_source else F.lit(0)).cast("bigint").alias("src"),
                (F.lit(0) if is_source else F.col("n")).cast("bigint").alias("dst"),
            )
            for name, pair in pairs.items()
            for side, is_source in zip(pair, (True, False))
        ]
    )
    diff = F.col("src") - F.col("dst")
    status = F.when(diff > 0, "target_short").when(diff < 0, "target_extra").otherwise("match")
    return (
        sides.groupBy("table")
        .agg(F.sum("src").alias("src"), F.sum("dst").alias("dst"))
        .select("table", "src", "dst", diff.alias("diff"), status.alias("status"))
    )


def uneven_ranges(
    source: DataFrame, target: DataFrame, key: str, width: int, columns: Sequence[str] = ()
) -> DataFrame:
    """Key ranges whose rows differ: ``range_start, src, dst`` (row counts).

    An extension: it narrows down where :func:`missing_rows` has to look. Row
    hashes are combined by exclusive or and by sum, so no row is shuffled.
    """
    columns = list(columns) or source.columns
    start = (F.col(key) - F.pmod(F.col(key), F.lit(width))).alias("range_start")

    def summed(df: DataFrame, sign: int) -> DataFrame:
        row = F.xxhash64(*columns, *(F.isnull(c) for c in columns))
        return df.select(start, row.alias("h"), F.lit(sign).alias("side"))

    both = summed(source, 1).unionByName(summed(target, -1))
    return (
        both.groupBy("range_start")
        .agg(
            F.count_if(F.col("side") == 1).alias("src"),
            F.count_if(F.col("side") == -1).alias("dst"),
            F.bit_xor("h").alias("odd"),
            F.sum(F.col("h").cast("decimal(38,0)") * F.col("side")).alias("net"),
        )
        .filter((F.col("src") != F.col("dst")) | (F.col("odd") != 0) | (F.col("net") != 0))
        .select("range_start", "src", "dst")
    )
