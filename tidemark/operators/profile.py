"""Profiling JSON lines that are held as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalar import field_of, is_blank, json_value


def profile_lines(
    df: DataFrame, line: str, field: str, kind: str = "integer", by: Sequence[str] = ()
) -> DataFrame:
    """``n_lines, n_bad, max_value`` of a text column, optionally per group.

    Blank lines are not counted. Malformed lines, missing fields and values of
    another type are skipped; integers (up to 64-bit unsigned, also negative)
    compare as numbers and datetimes as points in time.
    """
    parsed = df.select("*", json_value(line).alias("_parsed"))  # once per line
    text = field_of(F.col("_parsed"), field)
    if kind == "integer":
        value = F.when(F.regexp_like(text, F.lit(r"^-?[0-9]+$")), text).try_cast("decimal(20,0)")
    elif kind == "datetime":
        value = text.try_cast("timestamp_ntz")
    else:
        raise ValueError(f"no comparison for {kind!r}")
    return parsed.groupBy(*by).agg(
        F.count_if(~is_blank(line)).alias("n_lines"),
        F.count_if(~is_blank(line) & F.col("_parsed").isNull()).alias("n_bad"),
        F.max(value).alias("max_value"),
    )
