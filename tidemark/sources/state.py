"""The sync-state log: append-only rows, the latest per table counts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import astuple
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import delete_files, path_exists
from tidemark.sources.writer import check_writer
from tidemark.types import TableState

STATE_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("synced_rows", T.LongType()),
        T.StructField("initial_sync_complete", T.BooleanType()),
        T.StructField("watermark_column", T.StringType()),
        T.StructField("watermark_value", T.StringType()),
        T.StructField("batch_seq", T.LongType()),
    ]
)


def latest_per_key(df: DataFrame, keys: list[str], order: str | list[str]) -> DataFrame:
    """The row with the greatest ``order`` of every key."""
    order = [order] if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(last).select(*keys, "_row.*").select(*df.columns)


def fold_state(log: DataFrame) -> DataFrame:
    """One row per table."""
    return latest_per_key(log, ["table"], "batch_seq")


def append_state_rows(rows: DataFrame, path: str, table: str) -> None:
    """Add rows of one table to the log, after the data they speak of are stored.

    Every table has its own folder: tables are copied side by side, and two
    jobs that append to one folder would share its staging area.
    """
    check_writer(rows.sparkSession, path)
    typed = rows.select(*(F.col(f.name).cast(f.dataType) for f in STATE_SCHEMA.fields))
    typed.write.mode("append").parquet(f"{path}/table-{quote(table, safe='')}")


def append_state(spark: SparkSession, path: str, states: Iterable[TableState]) -> None:
    """Add single states to the log, a small file each."""
    for state in states:
        fields = zip(STATE_SCHEMA.names, astuple(state))
        row = spark.range(0, 1, 1, 1).select(*(F.lit(value).alias(name) for name, value in fields))
        append_state_rows(row, path, state.table)


def read_state_log(spark: SparkSession, path: str) -> DataFrame:
    """The log; empty if there is none yet, an error if it is something else."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], STATE_SCHEMA)
    try:
        log = spark.read.option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder that was claimed, without a row yet
            return spark.createDataFrame([], STATE_SCHEMA)
        raise
    found = {f.name: f.dataType for f in log.schema.fields}
    if found != {f.name: f.dataType for f in STATE_SCHEMA.fields}:
        raise ValueError(f"{path} is no state log: {log.schema.simpleString()}")
    return log.select(*STATE_SCHEMA.names)


def compact_state_log(spark: SparkSession, path: str, above: int = 0) -> int:
    """Replace a log of more than ``above`` files by its latest rows; returns how many files went.

    For the writer of the log, between polls. The latest rows are appended before
    older files are deleted, and saying a row twice changes nothing, so a crash
    at any point leaves a log that reads the same.
    """
    log = read_state_log(spark, path)
    old = log.inputFiles()
    if len(old) <= above:
        return 0
    latest = load_state(spark, path)
    if len(old) <= len(latest):
        return 0
    append_state(spark, path, latest.values())
    delete_files(spark, old)
    return len(old)


def load_state(spark: SparkSession, path: str) -> dict[str, TableState]:
    """Latest state by table name; one row per table comes to the driver."""
    return {row["table"]: TableState(**row.asDict()) for row in fold_state(read_state_log(spark, path)).collect()}


def state_of(states: dict[str, TableState], table: str) -> TableState:
    return states.get(table, TableState(table))


def pending_batches(planned: DataFrame, log: DataFrame, table: str) -> DataFrame:
    """Planned batches (``batch_seq``) the log does not hold yet for the table."""
    done = log.filter(F.col("table") == table).select("batch_seq")
    return planned.join(done, "batch_seq", "left_anti")
