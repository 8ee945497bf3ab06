"""The first copy of a table, and the state that lets changes follow it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.delta import in_range
from tidemark.operators.ordering import tie_safe_batches
from tidemark.operators.projection import project
from tidemark.operators.watermark import choose, read_max
from tidemark.session import path_exists
from tidemark.sources.ledger import record_digests
from tidemark.sources.state import append_state, load_state, state_of
from tidemark.sources.target import (
    BATCH_COLUMN,
    MONTH_COLUMN,
    check_target,
    read_target,
    write_batch,
)
from tidemark.types import TableSpec, TableState, Watermark, as_text, typed_literal


@dataclass(frozen=True)
class CopyResult:
    """What happened to one table; ``status`` is ok, skipped, target_short or error."""

    table: str
    status: str
    n_rows: int = 0
    error: str | None = None


def table_watermark(df: DataFrame, spec: TableSpec) -> Watermark:
    return spec.watermark or choose(df.schema, spec.excluded)


def snapshot_rows(df: DataFrame, watermark: Watermark, upto: str | None) -> DataFrame:
    """Rows a snapshot up to a fixed watermark holds.

    Rows without a watermark are in it, since no delta will ever see them; rows
    beyond the bound are left to the first delta, so nothing falls between.
    """
    if watermark.by_count:
        return df
    column = F.col(f"`{watermark.column}`")
    if upto is None:
        return df.filter(column.isNull())
    return df.filter((column <= typed_literal(upto, df.schema[watermark.column].dataType)) | column.isNull())


def snapshot_table(
    spark: SparkSession, df: DataFrame, spec: TableSpec, target: str, state_path: str
) -> CopyResult:
    """Copy a table as batch 0 and save the bound the copy was taken at.

    The bound is read before the copy starts. One partitioned job reads and
    writes; its tasks take the place of page workers.
    """
    watermark = table_watermark(df, spec)
    upto = None if watermark.by_count else read_max(df, watermark.column)
    rows = project(snapshot_rows(df, watermark, upto), spec.withheld)
    check_target(rows, target)
    n_rows = write_batch(rows, target, 0, spec.month_of, spec.sort_key)
    record_digests(spark, spec, watermark.column, rows.columns, target, state_path, -1, 0)
    append_state(spark, state_path, [TableState(spec.name, n_rows, True, watermark.column, upto, 0)])
    stored = read_target(spark, target, keep_layout=True).filter(F.col(BATCH_COLUMN) == 0).count() if n_rows else 0
    return CopyResult(spec.name, "ok" if stored >= n_rows else "target_short", n_rows)


def snapshot_in_parts(
    spark: SparkSession,
    df: DataFrame,
    spec: TableSpec,
    target: str,
    state_path: str,
    before_part: Callable[[int], object] | None = None,
) -> CopyResult:
    """The same copy in ``spec.parts`` watermark ranges, each stored and recorded by itself.

    A run that is interrupted goes on after the last part of its saved state,
    which a compacted log still holds: parts are stored in order, and the ranges
    are planned once, below the state folder, and kept. Parts are whole tie
    groups of about equal size; rows without a watermark are in the first.
    ``before_part`` is told the number of each part before it is read.
    """
    watermark = table_watermark(df, spec)
    if watermark.by_count:
        return snapshot_table(spark, df, spec, target, state_path)
    plan_path = f"{state_path}_plans/{quote(spec.name, safe='')}"
    if not path_exists(spark, f"{plan_path}/_SUCCESS"):  # a plan whose write died is made again
        _plan_parts(df, watermark.column, spec.parts).write.mode("overwrite").parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    state = state_of(load_state(spark, state_path), spec.name)
    check_target(project(df, spec.withheld), target)
    last = plan.agg(F.max("batch_seq")).first()[0]
    # one row per part
    for part in plan.filter(F.col("batch_seq") > state.batch_seq).orderBy("batch_seq").collect():
        rows = in_range(df, watermark.column, part["after"], part["upto"], spec.month_column)
        if before_part is not None:
            before_part(part["batch_seq"])
        if part["batch_seq"] == 0:
            rows = snapshot_rows(df, watermark, part["upto"])
        rows = project(rows, spec.withheld)
        n_rows = write_batch(rows, target, part["batch_seq"], spec.month_of, spec.sort_key)
        seq = part["batch_seq"]
        record_digests(spark, spec, watermark.column, rows.columns, target, state_path, seq - 1, seq)
        state = TableState(
            spec.name,
            state.synced_rows + n_rows,
            part["batch_seq"] == last,
            watermark.column,
            part["upto"],
            part["batch_seq"],
        )
        append_state(spark, state_path, [state])
    stored = read_target(spark, target, keep_layout=True, upto=last).count() if state.synced_rows else 0
    return CopyResult(spec.name, "ok" if stored >= state.synced_rows else "target_short", state.synced_rows)


def _plan_parts(df: DataFrame, column: str, parts: int) -> DataFrame:
    """``batch_seq, after, upto`` of each part; one part without bounds for an empty table."""
    spark, dtype = df.sparkSession, df.schema[column].dataType
    n_rows = df.agg(F.count(f"`{column}`")).first()[0]
    batches = tie_safe_batches(df, column, max(1, -(-n_rows // parts)))
    # at most ``parts`` rows
    ends = [row["hi"] for row in batches.orderBy("batch_no").select(as_text("hi", dtype).alias("hi")).collect()]
    ends = ends or [None]
    bounds = [(seq, after, upto) for seq, (after, upto) in enumerate(zip([None, *ends], ends))]
    return spark.createDataFrame(bounds, "batch_seq long, after string, upto string").coalesce(1)


def snapshot_plus_delta(df: DataFrame, watermark: Watermark, upto: str) -> DataFrame:
    """The snapshot and everything after it as one table: each row exactly once."""
    later = in_range(df, watermark.column, upto, None)
    return snapshot_rows(df, watermark, upto).unionByName(later)


def fold_target(
    spark: SparkSession,
    spec: TableSpec,
    target: str,
    folded: str,
    upto: int,
    fold: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Rewrite the committed batches of a target into one at a new path, folded on the way.

    ``fold`` gets the rows with their batch number, the arrival order that merges
    need. A table cannot be read and overwritten in one job, hence the new path.
    """
    rows = fold(read_target(spark, target, keep_layout=True, upto=upto))
    return write_batch(rows.drop(BATCH_COLUMN, MONTH_COLUMN), folded, 0, spec.month_of, spec.sort_key)
