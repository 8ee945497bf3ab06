"""Bounded samples for fitting models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_SPAN = 1 << 32


def bounded_sample(df: DataFrame, key: Column, bound: int, seed: int = 7) -> DataFrame:
    """At most ``bound`` rows, chosen by the hash of ``key``: all of a small table, an even share of a large one.

    One count decides the share, so no rows are sorted and the choice is the
    same on every run.
    """
    n = df.count()
    if n <= bound:
        return df
    share = int(_SPAN * 0.95 * bound / n)
    return df.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(_SPAN)) < share).limit(bound)
