"""The digest ledger: per stored batch, what it holds of every watermark range."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.digests import DIGEST_SCHEMA, range_digests
from tidemark.sources.target import BATCH_COLUMN, discard_uncommitted, read_target, target_schema
from tidemark.types import TableSpec


def ledger_path(state_path: str, table: str) -> str:
    return f"{state_path}_digests/{quote(table, safe='')}"


def write_digests(digests: DataFrame, state_path: str, table: str) -> None:
    """Store digests of some batches (BATCH_COLUMN and the columns of DIGEST_SCHEMA); those batches replace theirs.

    For between a batch and its state row, like the batch itself: a replay
    writes the same partitions again.
    """
    typed = digests.select(BATCH_COLUMN, *(F.col(f.name).cast(f.dataType) for f in DIGEST_SCHEMA.fields))
    writer = typed.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BATCH_COLUMN).parquet(ledger_path(state_path, table))


def read_digests(spark: SparkSession, state_path: str, table: str, upto: int) -> DataFrame | None:
    """Digests of the batches committed up to a state's; None if none was ever kept."""
    path = ledger_path(state_path, table)
    if target_schema(spark, path) is None:
        return None
    return spark.read.parquet(path).filter(F.col(BATCH_COLUMN) <= upto).select(*DIGEST_SCHEMA.names)


def discard_digests(df: DataFrame, state_path: str, table: str, last_seq: int) -> list[int]:
    """After a restart: drop digests of batches above the last one the state log knows."""
    return discard_uncommitted(df, ledger_path(state_path, table), last_seq)


def record_digests(
    spark: SparkSession,
    spec: TableSpec,
    column: str | None,
    columns: Sequence[str],
    target: str,
    state_path: str,
    after: int,
    upto: int,
) -> None:
    """Keep the digests of the stored batches ``after < batch <= upto``, if the table asks for it.

    They are taken from what is stored, so they vouch for the target and not
    for what the source held a moment before or after. For between data and
    state row; digests of batches that were never recorded are dropped first.
    """
    if spec.late_ranges is None or column is None or target_schema(spark, target) is None:
        return
    stored = read_target(spark, target, keep_layout=True)
    stored = stored.filter((F.col(BATCH_COLUMN) > after) & (F.col(BATCH_COLUMN) <= upto))
    stored = stored.select(*(f"`{c}`" for c in columns), BATCH_COLUMN)
    discard_digests(stored, state_path, spec.name, after)
    write_digests(range_digests(stored, column, spec.late_ranges, [BATCH_COLUMN]), state_path, spec.name)
