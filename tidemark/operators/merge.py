"""Folding an appended target by key.

The rules follow the merge behaviour a target table declares: keep the latest
row, cancel pairs of opposite sign, or add up. All folds aggregate partially
before the shuffle, so a task sends at most one row per key it saw, however
many versions a key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def replacing_merge(
    df: DataFrame, keys: Sequence[str], version: str | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """One row per key: greatest version, then greatest arrival order.

    The rank filter becomes a group limit on both sides of the shuffle.
    """
    ranking = [*([version] if version else []), *order]
    if not ranking:
        raise ValueError("give a version or an arrival order")
    latest = Window.partitionBy(*keys).orderBy(*(F.desc_nulls_last(c) for c in ranking))
    return df.withColumn("_place", F.row_number().over(latest)).filter("_place = 1").drop("_place")


def collapsing_merge(df: DataFrame, keys: Sequence[str], sign: str, order: Sequence[str]) -> DataFrame:
    """Per key: the last +1 row if the signs sum above zero, the first -1 row below, none at zero."""
    row = F.struct(*(f"`{c}`" for c in df.columns if c not in keys))
    at = F.struct(*order)
    by = [F.col(f"`{k}`") for k in keys]
    up = F.col(sign) > 0
    down = F.col(sign) < 0
    folded = df.groupBy(*by).agg(
        F.sum(sign).alias("_net"),
        F.max_by(F.when(up, row), F.when(up, at)).alias("_last"),
        F.min_by(F.when(down, row), F.when(down, at)).alias("_first"),
    )
    kept = F.when(F.col("_net") > 0, F.col("_last")).otherwise(F.col("_first"))
    rows = folded.filter("_net <> 0").select(*by, kept.alias("_row")).select(*by, "_row.*")
    return rows.select(*(f"`{c}`" for c in df.columns))


def versioned_collapse(
    df: DataFrame, keys: Sequence[str], version: str, sign: str, values: Sequence[str] = ()
) -> DataFrame:
    """``keys, version, net`` where the signs of a version do not cancel out.

    No arrival order is needed. ``values`` are taken from one row of the sign
    that is left; rows of one version and sign are copies of each other.
    """
    aggregates = [F.sum(sign).cast("bigint").alias("net")]
    if values:
        row = F.struct(*values)
        aggregates += [
            F.max_by(F.when(F.col(sign) > 0, row), F.when(F.col(sign) > 0, row)).alias("_up"),
            F.max_by(F.when(F.col(sign) < 0, row), F.when(F.col(sign) < 0, row)).alias("_down"),
        ]
    left = df.groupBy(*keys, version).agg(*aggregates).filter("net <> 0")
    if not values:
        return left
    kept = F.when(F.col("net") > 0, F.col("_up")).otherwise(F.col("_down"))
    return left.select(*keys, version, "net", kept.alias("_row")).select(*keys, version, "net", "_row.*")


def summing_merge(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], drop_zero: bool = True
) -> DataFrame:
    """Per key the sums of the named columns and ``n_rows``; all-zero rows are dropped.

    Nothing is rounded and every sum has the type of its column: integers and
    decimals are added exactly, as decimals, and a sum that its type cannot hold
    is an error; doubles and floats are plain double sums, whose last digits may
    depend on the order of the rows. The zero rule looks at those sums.
    """

    def total(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.sum(name).cast(kind)
        exact = F.col(name) if isinstance(kind, T.DecimalType) else F.col(name).cast("decimal(28,0)")
        return F.sum(exact).cast(kind)

    summed = df.groupBy(*keys).agg(*(total(c).alias(c) for c in columns), F.count("*").alias("n_rows"))
    if not drop_zero:
        return summed
    all_zero = F.lit(True)
    for name in columns:
        all_zero = all_zero & (F.coalesce(F.col(name), F.lit(0)) == 0)
    return summed.filter(~all_zero)
