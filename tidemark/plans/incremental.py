"""Following a table: one poll, a drained backlog, a bounded catch-up."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.delta import in_range, newer_than, read_cut
from tidemark.operators.missing import missing_rows, same_rows, tail_by_count
from tidemark.operators.ordering import key_positions
from tidemark.operators.projection import project
from tidemark.operators.watermark import read_max
from tidemark.plans.snapshot import table_watermark
from tidemark.sources.ledger import record_digests, write_digests
from tidemark.sources.state import append_state, append_state_rows
from tidemark.sources.target import (
    BATCH_COLUMN,
    check_target,
    discard_uncommitted,
    read_target,
    target_schema,
    write_batch,
    write_batches,
)
from tidemark.types import (
    DEFAULT_BATCH_ROWS,
    MAX_BROADCAST_ROWS,
    TableSpec,
    TableState,
    Watermark,
    as_text,
)


def check_watermark(state: TableState, watermark: Watermark) -> None:
    """A saved value is only good for the column it was read from."""
    if state.batch_seq >= 0 and state.watermark_column != watermark.column:
        raise ValueError(
            f"{state.table}: saved watermark is of {state.watermark_column}, now {watermark.column} is chosen"
        )


def poll_once(
    df: DataFrame, spec: TableSpec, state: TableState, batch_rows: int = DEFAULT_BATCH_ROWS
) -> tuple[DataFrame | None, TableState]:
    """The next batch and the state to save once it is stored; ``(None, state)`` if nothing is new.

    The batch ends at a whole group of equal watermarks. ``synced_rows`` of the
    new state is still the old count: the writer knows how many rows it wrote.
    """
    watermark = table_watermark(df, spec)
    check_watermark(state, watermark)
    after = state.watermark_value
    upto = read_cut(df, watermark.column, after, batch_rows, month_column=spec.month_column)
    if upto is None:
        return None, state
    rows = project(in_range(df, watermark.column, after, upto, spec.month_column), spec.withheld)
    moved = replace(
        state, watermark_column=watermark.column, watermark_value=upto, batch_seq=state.batch_seq + 1
    )
    return rows, moved


def store(
    spark: SparkSession,
    rows: DataFrame,
    spec: TableSpec,
    state: TableState,
    target: str,
    state_path: str,
    digests: DataFrame | None = None,
) -> TableState:
    """Data first, digests next, state last: a crash in between replays the same partition.

    ``digests`` are those of the batch, if they are known; else they are taken from what was stored.
    """
    check_target(rows, target)
    n_rows = write_batch(rows, target, state.batch_seq, spec.month_of, spec.sort_key)
    if digests is not None:
        write_digests(digests.withColumn(BATCH_COLUMN, F.lit(state.batch_seq)), state_path, spec.name)
    else:
        seq = state.batch_seq
        record_digests(spark, spec, state.watermark_column, rows.columns, target, state_path, seq - 1, seq)
    saved = replace(state, synced_rows=state.synced_rows + n_rows)
    append_state(spark, state_path, [saved])
    return saved


def poll_table(
    spark: SparkSession,
    df: DataFrame,
    spec: TableSpec,
    state: TableState,
    target: str,
    state_path: str,
    batch_rows: int = DEFAULT_BATCH_ROWS,
    by_position: bool = False,
) -> TableState:
    """One poll of one table, stored. The state returned is the one given if nothing was new."""
    if table_watermark(df, spec).by_count:
        return _poll_by_content(spark, df, spec, state, target, state_path, by_position)
    rows, moved = poll_once(df, spec, state, batch_rows)
    return state if rows is None else store(spark, rows, spec, moved, target, state_path)


def _poll_by_content(spark, df, spec, state, target, state_path, by_position) -> TableState:
    """Without a watermark: rows the target lacks, or on request those after its count."""
    check_watermark(state, Watermark("count"))
    source = project(df, spec.withheld)
    check_target(source, target)
    # an earlier write of this batch that was never recorded does not count as stored
    if target_schema(spark, target) is None:  # an empty copy may have left no file
        stored = source.filter(F.lit(False))
    else:
        stored = read_target(spark, target, upto=state.batch_seq).select(*(f"`{c}`" for c in source.columns))
    if not by_position and same_rows(source, stored):  # the usual poll: nothing is shuffled
        return state
    if by_position:
        kept = tail_by_count(df, stored, spec.sort_key)
        rows = project(kept, spec.withheld)
    else:
        rows = missing_rows(source, stored)
    check_target(rows, target)
    seq = state.batch_seq + 1
    n_rows = write_batch(rows, target, seq, spec.month_of, spec.sort_key)
    if n_rows == 0:
        return state
    saved = replace(state, synced_rows=state.synced_rows + n_rows, batch_seq=seq)
    append_state(spark, state_path, [saved])
    return saved


def recover(spark: SparkSession, df: DataFrame, spec: TableSpec, state: TableState, target: str) -> list[int]:
    """Once after a restart: drop batches that were stored but never recorded."""
    rows = project(df, spec.withheld)
    return discard_uncommitted(rows, target, state.batch_seq, spec.month_of, spec.sort_key)


def drain(
    spark: SparkSession,
    df: DataFrame,
    spec: TableSpec,
    state: TableState,
    target: str,
    state_path: str,
    batch_rows: int = DEFAULT_BATCH_ROWS,
) -> TableState:
    """Work off the backlog that exists now in batches of whole tie groups.

    One pass over the watermark column finds the batch of every value; a second
    pass looks each row's batch up and writes all batches in one job, so the
    number of batches does not multiply the scans. The lookup has one row per
    distinct watermark; its rows are counted, and it is broadcast only if they
    are few. Otherwise both sides are shuffled, and adaptive execution splits hot
    values. A row that arrived since, with a value of its own, goes into the
    last batch. Numbers of batches may have gaps where a tie group fills several.
    """
    watermark = table_watermark(df, spec)
    check_watermark(state, watermark)
    column, dtype = watermark.column, df.schema[watermark.column].dataType
    new = newer_than(df, column, state.watermark_value, spec.month_column).select(f"`{column}`")
    if new.isEmpty():
        return state
    check_target(project(df, spec.withheld), target)
    recover(spark, df, spec, state, target)
    seq = F.lit(state.batch_seq + 1) + F.expr(f"start div {batch_rows}")
    values = key_positions(new, [column]).select(f"`{column}`", seq.alias(BATCH_COLUMN), "stop")
    ends = values.groupBy(F.col(BATCH_COLUMN).alias("batch_seq")).agg(
        F.max(f"`{column}`").alias("hi"), F.max("stop").alias("stop"), F.count("*").alias("n_values")
    )
    last = ends.select(
        F.max("batch_seq").alias("seq"), as_text(F.max("hi"), dtype).alias("hi"), F.sum("n_values").alias("n_values")
    ).first()
    rows = in_range(df, column, state.watermark_value, last["hi"], spec.month_column)
    lookup = values.select(f"`{column}`", BATCH_COLUMN)
    if last["n_values"] <= MAX_BROADCAST_ROWS:
        lookup = F.broadcast(lookup)
    placed = rows.join(lookup, column, "left").select(
        *(f"`{c}`" for c in df.columns), F.coalesce(BATCH_COLUMN, F.lit(last["seq"])).alias(BATCH_COLUMN)
    )
    kept = project(placed, spec.withheld)
    n_rows = write_batches(kept, target, spec.month_of, spec.sort_key)
    columns = [c for c in kept.columns if c != BATCH_COLUMN]
    record_digests(spark, spec, column, columns, target, state_path, state.batch_seq, last["seq"])
    final = replace(
        state,
        synced_rows=state.synced_rows + n_rows,
        watermark_column=column,
        watermark_value=last["hi"],
        batch_seq=last["seq"],
    )
    total = F.when(F.col("batch_seq") == last["seq"], final.synced_rows).otherwise(state.synced_rows + F.col("stop"))
    log = ends.select(
        F.lit(spec.name).alias("table"),
        total.alias("synced_rows"),
        F.lit(state.initial_sync_complete).alias("initial_sync_complete"),
        F.lit(column).alias("watermark_column"),
        as_text("hi", dtype).alias("watermark_value"),
        "batch_seq",
    )
    append_state_rows(log, state_path, spec.name)
    return final


def catch_up(
    spark: SparkSession, df: DataFrame, spec: TableSpec, state: TableState, target: str, state_path: str
) -> TableState:
    """The whole backlog as one bounded range: one scan, fully parallel, one state row."""
    watermark = table_watermark(df, spec)
    check_watermark(state, watermark)
    new = newer_than(df, watermark.column, state.watermark_value, spec.month_column)
    upto = read_max(new, watermark.column)
    if upto is None:
        return state
    recover(spark, df, spec, state, target)
    rows = project(in_range(df, watermark.column, state.watermark_value, upto, spec.month_column), spec.withheld)
    moved = replace(
        state, watermark_column=watermark.column, watermark_value=upto, batch_seq=state.batch_seq + 1
    )
    return store(spark, rows, spec, moved, target, state_path)


def add_late_rows(
    spark: SparkSession,
    df: DataFrame,
    spec: TableSpec,
    state: TableState,
    target: str,
    state_path: str,
    keys: list[str],
    lookback: str,
) -> TableState:
    """Store rows that arrived below the saved watermark as a batch of their own; the watermark stays.

    For before a poll or drain, as often as the source's lateness asks for.
    Only rows within ``lookback`` of the watermark are compared.
    """
    watermark = table_watermark(df, spec)
    check_watermark(state, watermark)
    if watermark.by_count or state.watermark_value is None or target_schema(spark, target) is None:
        return state
    stored = read_target(spark, target, upto=state.batch_seq)
    late = project(late_rows(df, stored, watermark.column, keys, lookback, state.watermark_value), spec.withheld)
    if late.isEmpty():
        return state
    return store(spark, late, spec, replace(state, batch_seq=state.batch_seq + 1), target, state_path)


def late_rows(
    df: DataFrame, target: DataFrame, column: str, keys: list[str], lookback: str, upto: str
) -> DataFrame:
    """Rows at or below the saved watermark, within ``lookback`` of it, that the target lacks by key.

    An extension for sources whose rows may arrive late; ``lookback`` is an
    interval such as ``"2 days"``.
    """
    bound = F.lit(upto).cast(df.schema[column].dataType)
    at = F.col(f"`{column}`")
    recent = (at <= bound) & (at > bound - F.expr(f"INTERVAL {lookback}"))
    held = target.filter(recent).select(*(f"`{k}`" for k in keys))
    return df.filter(recent).join(held, keys, "left_anti").select(*(f"`{c}`" for c in df.columns))
