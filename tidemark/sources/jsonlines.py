"""JSON lines as source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.scalar import is_blank, json_is_bad
from tidemark.types import TIMESTAMP_OPTIONS

BAD_LINE = "_corrupt_record"


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """One object per line, blank lines skipped.

    Strict reads fail on a malformed line. Tolerant ones skip it, like any field
    they cannot read becomes NULL; :func:`count_bad_lines` tells how many.
    """
    reader = spark.read.options(**TIMESTAMP_OPTIONS)
    if strict:
        return reader.schema(schema).option("mode", "FAILFAST").json(path)
    return reader.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_with_bad_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows, with the text of a malformed line in ``_corrupt_record``."""
    kept = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    reader = spark.read.options(**TIMESTAMP_OPTIONS)
    return reader.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE).json(path)


def count_bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``n_lines`` that are not blank and ``n_bad`` among them."""
    return spark.read.text(path).agg(
        F.count_if(~is_blank("value")).alias("n_lines"), F.count_if(json_is_bad("value")).alias("n_bad")
    )


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """One object per line with NULL fields and whole microseconds written out."""
    df.write.mode(mode).options(ignoreNullFields="false", **TIMESTAMP_OPTIONS).json(path)
