"""Choosing, profiling and reading the column that orders change."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions.scalar import name_in
from tidemark.operators.projection import VIRTUAL_KINDS, default_kind
from tidemark.types import Watermark, as_text, is_datetime, is_watermark_integer

# Names preferred for a watermark, and the text of "no value yet".
PREFERRED_DATETIME = ("updated_at", "modified_at", "event_time", "created_at", "timestamp")
PREFERRED_INTEGER = ("_version", "version", "id")
DATETIME_SENTINEL = "1970-01-01 00:00:00"
INTEGER_SENTINEL = "0"

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType(), False),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("nullable", T.BooleanType(), False),
        T.StructField("default_kind", T.StringType(), False),
    ]
)


def column_catalog(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """One row per column of the given schemas."""
    rows = [
        (table, position, field.name, field.dataType.simpleString(), field.nullable, default_kind(field))
        for table, schema in schemas.items()
        for position, field in enumerate(schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def choose_from_catalog(catalog: DataFrame) -> DataFrame:
    """``table, kind, column`` for every table of a column catalog.

    Four tiers decide (preferred datetime, any datetime, preferred integer, any
    integer), then not-nullable before nullable, then column order. Tables
    without a candidate are kept with kind ``count``.
    """
    dated = F.col("type").isin("timestamp", "timestamp_ntz", "date")
    whole = F.col("type").isin("bigint", "decimal(20,0)")
    tier = (
        F.when(F.col("default_kind").isin(*VIRTUAL_KINDS), None)
        .when(dated & name_in("name", PREFERRED_DATETIME), 1)
        .when(dated, 2)
        .when(whole & name_in("name", PREFERRED_INTEGER), 3)
        .when(whole, 4)
    )
    best = Window.partitionBy("table").orderBy(F.asc_nulls_last("tier"), "nullable", "position")
    kind = F.when(F.col("tier") <= 2, "datetime").when(F.col("tier") <= 4, "integer").otherwise("count")
    return (
        catalog.withColumn("tier", tier)
        .withColumn("place", F.row_number().over(best))
        .filter("place = 1")
        .select("table", kind.alias("kind"), F.when(F.col("tier").isNotNull(), F.col("name")).alias("column"))
    )


def choose(schema: T.StructType, excluded: Sequence[str] = ()) -> Watermark:
    """The same rule for one schema; an excluded choice falls back to counting."""

    def tier(field: T.StructField) -> int | None:
        if default_kind(field) in VIRTUAL_KINDS:
            return None
        if is_datetime(field.dataType):
            return 1 if field.name.lower() in PREFERRED_DATETIME else 2
        if is_watermark_integer(field.dataType):
            return 3 if field.name.lower() in PREFERRED_INTEGER else 4
        return None

    ranked = [
        (tier(field), field.nullable, position, field.name)
        for position, field in enumerate(schema.fields)
        if tier(field) is not None
    ]
    if not ranked:
        return Watermark("count")
    best_tier, _, _, name = min(ranked)
    if name in excluded:
        return Watermark("count")
    return Watermark("datetime" if best_tier <= 2 else "integer", name)


def sentinel(dtype: T.DataType) -> Column:
    """The value that stands for "nothing seen yet", in the column's own type."""
    text = DATETIME_SENTINEL if is_datetime(dtype) else INTEGER_SENTINEL
    return F.lit(text).cast(dtype)


def max_watermark(df: DataFrame, column: str) -> DataFrame:
    """One row, ``watermark``: the maximum, NULL if there is none or it is the sentinel."""
    top = F.max(f"`{column}`")
    return df.agg(F.nullif(top, sentinel(df.schema[column].dataType)).alias("watermark"))


def max_watermarks(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``table, watermark`` as text for many tables in one job."""
    parts = [
        max_watermark(df, column).select(
            F.lit(name).alias("table"),
            as_text("watermark", df.schema[column].dataType).alias("watermark"),
        )
        for name, (df, column) in tables.items()
    ]
    return union_all(parts)


def read_max(df: DataFrame, column: str) -> str | None:
    """The plain maximum as text, for the saved state; a failed read raises."""
    dtype = df.schema[column].dataType
    return df.agg(F.max(f"`{column}`").alias("m")).select(as_text("m", dtype).alias("m")).first()["m"]


def watermark_profile(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """How fit each candidate is: rows, NULLs, distinct values, range, largest tie.

    NULL rows never pass a watermark predicate and ties decide how far a
    tie-safe batch may overshoot. ``exact=False`` needs no shuffle of values,
    estimates the distinct count and leaves ``largest_tie`` NULL.
    """
    kinds = [df.schema[name].dataType for name in columns]
    cells = [
        F.struct(F.lit(i).alias("i"), *(F.col(f"`{n}`").alias(f"v{i}") if i == j else F.lit(None).cast(k).alias(f"v{j}") for j, k in enumerate(kinds)))
        for i, n in enumerate(columns)
    ]
    if exact:
        # one scan: a row per cell, with the value in the place of its column and its own type
        values = [f"v{j}" for j in range(len(kinds))]
        unpivoted = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
        counted = unpivoted.groupBy("i", *values).agg(F.count("*").alias("n"))
        known = F.coalesce(*(F.when(F.col(v).isNotNull(), True) for v in values), F.lit(False))
        whole = counted.groupBy("i").agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_null"),
            F.count_if(known).alias("n_distinct"),
            *(F.min(v).alias(f"lo{j}") for j, v in enumerate(values)),
            *(F.max(v).alias(f"hi{j}") for j, v in enumerate(values)),
            F.max(F.when(known, F.col("n"))).alias("largest_tie"),
        )
        lo, hi = (F.coalesce(*(as_text(f"{end}{j}", k) for j, k in enumerate(kinds))) for end in ("lo", "hi"))
        names = F.array(*map(F.lit, columns))
        found = whole.select(F.get(names, F.col("i")).alias("column"), "n_rows", "n_null", "n_distinct", lo.alias("min_value"), hi.alias("max_value"), "largest_tie")
        every = df.sparkSession.createDataFrame([(n,) for n in columns], "column string")  # also those of an empty table
        none = F.lit(0).cast("bigint")
        return every.join(found, "column", "left").select(
            "column", *(F.coalesce(c, none).alias(c) for c in ("n_rows", "n_null", "n_distinct")), "min_value", "max_value", "largest_tie"
        )
    measures = []
    for i, (name, kind) in enumerate(zip(columns, kinds)):
        value = F.col(f"`{name}`")
        measures.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count("*").alias("n_rows"),
                F.count_if(value.isNull()).alias("n_null"),
                F.approx_count_distinct(value).alias("n_distinct"),
                as_text(F.min(value), kind).alias("min_value"),
                as_text(F.max(value), kind).alias("max_value"),
                F.lit(None).cast("bigint").alias("largest_tie"),
            )
        )
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
