"""Tables mirrored by key: updates and deletes of the source reach the target as well."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.changes import SIGN_COLUMN, pending_changes, signed_rows
from tidemark.operators.merge import collapsing_merge
from tidemark.operators.projection import project
from tidemark.sources.state import append_state
from tidemark.sources.target import BATCH_COLUMN, MONTH_COLUMN, check_target, read_target, target_schema, write_batch
from tidemark.types import TableSpec, TableState


def mirror_table(
    spark: SparkSession, df: DataFrame, spec: TableSpec, state: TableState, target: str, state_path: str
) -> TableState:
    """Append what changed since the last call as one batch of signed rows; the state given if nothing did.

    The key is ``spec.mirror_key`` and must be unique in the source. The stored
    batches are folded and compared with the source in one aggregate. A batch
    holds an old row with -1 and a new one with +1, so the target is a change
    feed too: :func:`read_changes`. Replays replace their batch.
    """
    source = project(df, spec.withheld)
    missing = [k for k in spec.mirror_key if k not in source.columns]
    if missing or not spec.mirror_key:
        raise ValueError(f"{spec.name}: a mirror needs its key among the columns that are copied: {missing}")
    if any(c.lower() == SIGN_COLUMN for c in source.columns):
        raise ValueError(f"the target keeps signs in {SIGN_COLUMN}: rename or exclude it")
    if state.batch_seq >= 0 and state.watermark_column is not None:
        raise ValueError(f"{spec.name} was followed by {state.watermark_column}, it can't be mirrored in the same target")
    check_target(source.withColumn(SIGN_COLUMN, F.lit(1)), target)
    if target_schema(spark, target) is None:
        stored = source.withColumns({SIGN_COLUMN: F.lit(1), BATCH_COLUMN: F.lit(0)}).filter(F.lit(False))
    else:
        stored = read_target(spark, target, keep_layout=True, upto=state.batch_seq)
    rows = signed_rows(pending_changes(stored, source, spec.mirror_key, [BATCH_COLUMN]))
    seq = state.batch_seq + 1
    n_rows = write_batch(rows, target, seq, spec.month_of, spec.sort_key)
    if n_rows == 0 and state.initial_sync_complete:
        return state
    saved = replace(state, synced_rows=state.synced_rows + n_rows, initial_sync_complete=True, batch_seq=seq)
    append_state(spark, state_path, [saved])
    return saved


def read_changes(spark: SparkSession, target: str, after: int, upto: int) -> DataFrame:
    """The change feed ``after < batch <= upto``: signed rows with SIGN_COLUMN and BATCH_COLUMN."""
    rows = read_target(spark, target, keep_layout=True, upto=upto)
    return rows.filter(F.col(BATCH_COLUMN) > after).drop(MONTH_COLUMN)


def fold_mirror(spark: SparkSession, target: str, keys: tuple[str, ...], upto: int) -> DataFrame:
    """The state of the source as of a batch."""
    rows = read_target(spark, target, keep_layout=True, upto=upto).drop(MONTH_COLUMN)
    return collapsing_merge(rows, keys, SIGN_COLUMN, [BATCH_COLUMN]).drop(SIGN_COLUMN, BATCH_COLUMN)
