"""Rows that arrive below the saved watermark, found by digests however old they are."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.digests import range_digests, rows_of_ranges, uneven_digests
from tidemark.operators.missing import missing_rows
from tidemark.operators.projection import project
from tidemark.plans.incremental import check_watermark, store
from tidemark.plans.snapshot import snapshot_rows, table_watermark
from tidemark.session import scratch_path
from tidemark.sources.ledger import read_digests, record_digests
from tidemark.sources.target import MONTH_COLUMN, read_target, target_schema
from tidemark.types import TableSpec, TableState


def uneven_ranges_of(
    spark: SparkSession, df: DataFrame, spec: TableSpec, state: TableState, target: str, state_path: str
) -> DataFrame:
    """Ranges up to the saved watermark in which source and ledger differ, as a stored table.

    Columns as of :func:`~tidemark.operators.digests.uneven_digests`. The source
    is scanned once and sends one row per task and range. A target whose batches
    were stored before digests were asked for gets its ledger here.
    """
    watermark = table_watermark(df, spec)
    source = project(snapshot_rows(df, watermark, state.watermark_value), spec.withheld)
    known = read_digests(spark, state_path, spec.name, state.batch_seq)
    if known is None:
        record_digests(spark, spec, watermark.column, source.columns, target, state_path, -1, state.batch_seq)
        known = read_digests(spark, state_path, spec.name, state.batch_seq)
    digests = range_digests(source, watermark.column, spec.late_ranges)
    if known is None:  # nothing is stored yet
        known = digests.select("range", "n_rows", "odd", "total").filter(F.lit(False))
    path = scratch_path(spark, "uneven")
    uneven_digests(digests, known).write.parquet(path)
    return spark.read.parquet(path)


def late_in_ranges(
    spark: SparkSession, df: DataFrame, spec: TableSpec, state: TableState, target: str, uneven: DataFrame
) -> DataFrame:
    """Source rows of uneven ranges that the target lacks, as a multiset; other ranges are not read on either side."""
    watermark = table_watermark(df, spec)
    held = snapshot_rows(df, watermark, state.watermark_value)
    rows = project(rows_of_ranges(held, watermark.column, uneven, spec.late_ranges, spec.month_column), spec.withheld)
    if target_schema(spark, target) is None:
        return rows
    month = MONTH_COLUMN if spec.month_of == watermark.column else None
    stored = read_target(spark, target, keep_layout=True, upto=state.batch_seq)
    stored = rows_of_ranges(stored, watermark.column, uneven, spec.late_ranges, month)
    return missing_rows(rows, stored)


def add_late_ranges(
    spark: SparkSession, df: DataFrame, spec: TableSpec, state: TableState, target: str, state_path: str
) -> TableState:
    """Store rows that came late, of any age, as a batch of their own; the watermark stays.

    The batch's digests are what the source had more than the ledger, so a
    range is read again only after it has changed again. Rows that were changed
    in place are stored in their new form beside the old one, which a merge by
    key folds; rows deleted from the source stay (see ``plans.mirror_table``).
    An empty batch notes a change that brought no new row. Tables without
    ``late_ranges`` or without a watermark are left as they are.
    """
    watermark = table_watermark(df, spec)
    if spec.late_ranges is None or watermark.by_count:
        return state
    check_watermark(state, watermark)
    uneven = uneven_ranges_of(spark, df, spec, state, target, state_path)
    if uneven.isEmpty():
        return state
    late = late_in_ranges(spark, df, spec, state, target, uneven)
    moved = replace(state, batch_seq=state.batch_seq + 1)
    return store(spark, late, spec, moved, target, state_path, digests=uneven)
