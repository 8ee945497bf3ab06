"""Many tables: first copy, poll cycle, and both in turn."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.incremental import drain, poll_table, recover
from tidemark.plans.late import add_late_ranges
from tidemark.plans.mirror import fold_mirror, mirror_table
from tidemark.plans.snapshot import CopyResult, snapshot_in_parts, snapshot_table, table_watermark
from tidemark.sources.state import compact_state_log, load_state, state_of
from tidemark.sources.target import read_target
from tidemark.sources.writer import claim_writer
from tidemark.types import DEFAULT_BATCH_ROWS, DEFAULT_WORKERS, TableSpec, TableState

Reader = Callable[[str], DataFrame]

# Files of the state log per table before a poll cycle compacts it.
LOG_FILES = 20


def target_path(root: str, table: str) -> str:
    return f"{root}/{table}"


def state_path(root: str) -> str:
    return f"{root}/sync_state"


def claim_tables(spark: SparkSession, specs: Iterable[TableSpec], root: str) -> None:
    """Make this session the only writer of these tables and their state log, from before its first read on."""
    claim_writer(spark, state_path(root), *(target_path(root, spec.name) for spec in specs))


def read_synced(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of a table that the state log vouches for; batches that were never recorded are left out."""
    state = state_of(load_state(spark, state_path(root)), table)
    return read_target(spark, target_path(root, table), upto=state.batch_seq)


def read_mirrored(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The state of a mirrored table as of its last recorded batch."""
    state = state_of(load_state(spark, state_path(root)), spec.name)
    return fold_mirror(spark, target_path(root, spec.name), spec.mirror_key, state.batch_seq)


def copy_tables(
    spark: SparkSession, read: Reader, specs: Sequence[TableSpec], root: str, workers: int = DEFAULT_WORKERS
) -> list[CopyResult]:
    """First copy of every table that is not complete yet; the start of a run.

    What an interrupted run stored for a complete table but never recorded is
    dropped.
    A few tables are in flight at once so that small ones do not leave the
    cluster idle. A table that fails is reported; the others go on.
    """
    states = load_state(spark, state_path(root))

    def copy(spec: TableSpec) -> CopyResult:
        df, state, target = read(spec.name), state_of(states, spec.name), target_path(root, spec.name)
        if state.initial_sync_complete:
            recover(spark, df, spec, state, target)
            return CopyResult(spec.name, "skipped")
        if spec.mirror_key:
            stored = mirror_table(spark, df, spec, state, target, state_path(root))
            return CopyResult(spec.name, "ok", stored.synced_rows)
        in_parts = spec.parts > 1 or state.batch_seq >= 0  # parts that were begun are finished
        snapshot = snapshot_in_parts if in_parts else snapshot_table
        return snapshot(spark, df, spec, target, state_path(root))

    return _for_each(spark, copy, specs, workers)


def poll_cycle(
    spark: SparkSession,
    read: Reader,
    specs: Sequence[TableSpec],
    root: str,
    batch_rows: int = DEFAULT_BATCH_ROWS,
    workers: int = DEFAULT_WORKERS,
) -> list[CopyResult]:
    """One poll of every copied table; a table that fails waits for the next cycle.

    Tables with ``late_ranges`` first get what arrived below their watermark.

    Each poll adds a small file to the state log, which is compacted before
    there are many to a table.
    """
    compact_state_log(spark, state_path(root), above=LOG_FILES * len(specs))
    return _follow_up(spark, read, specs, root, batch_rows, workers, poll_table)


def drain_cycle(
    spark: SparkSession,
    read: Reader,
    specs: Sequence[TableSpec],
    root: str,
    batch_rows: int = DEFAULT_BATCH_ROWS,
    workers: int = DEFAULT_WORKERS,
) -> list[CopyResult]:
    """The whole backlog of every copied table, late rows first; tables without a watermark are polled."""

    def follow(spark, df, spec, state, target, log, batch_rows) -> TableState:
        step = poll_table if table_watermark(df, spec).by_count else drain
        return step(spark, df, spec, state, target, log, batch_rows)

    return _follow_up(spark, read, specs, root, batch_rows, workers, follow)


def sync_tables(
    spark: SparkSession,
    read: Reader,
    specs: Sequence[TableSpec],
    root: str,
    batch_rows: int = DEFAULT_BATCH_ROWS,
    workers: int = DEFAULT_WORKERS,
) -> list[CopyResult]:
    """Copy what is missing, then drain until no healthy table has anything new."""
    compact_state_log(spark, state_path(root))
    results = copy_tables(spark, read, specs, root, workers)
    totals = {r.table: r for r in results}
    active = [s for s in specs if totals[s.name].status != "error"]
    while active:
        followed = drain_cycle(spark, read, active, root, batch_rows, workers)
        for r in followed:
            last = totals[r.table]
            drained = last.status == "skipped" and r.n_rows
            status = r.status if r.status == "error" or drained else last.status
            totals[r.table] = CopyResult(r.table, status, last.n_rows + r.n_rows, r.error)
        moving = {r.table for r in followed if r.status == "ok" and r.n_rows}
        active = [s for s in active if s.name in moving]
    return [totals[s.name] for s in specs]


def _follow_up(
    spark: SparkSession,
    read: Reader,
    specs: Sequence[TableSpec],
    root: str,
    batch_rows: int,
    workers: int,
    step: Callable[..., TableState],
) -> list[CopyResult]:
    states = load_state(spark, state_path(root))

    def follow(spec: TableSpec) -> CopyResult:
        before = state_of(states, spec.name)
        if not before.initial_sync_complete:
            return CopyResult(spec.name, "skipped")
        df, target = read(spec.name), target_path(root, spec.name)
        if spec.mirror_key:
            after = mirror_table(spark, df, spec, before, target, state_path(root))
        else:
            caught_up = add_late_ranges(spark, df, spec, before, target, state_path(root))
            after = step(spark, df, spec, caught_up, target, state_path(root), batch_rows)
        return CopyResult(spec.name, "ok", after.synced_rows - before.synced_rows)

    return _for_each(spark, follow, specs, workers)


def _for_each(
    spark: SparkSession, work: Callable[[TableSpec], CopyResult], specs: Sequence[TableSpec], workers: int
) -> list[CopyResult]:
    def guarded(spec: TableSpec) -> CopyResult:
        try:
            return work(spec)
        except Exception as error:  # one table must not stop the others
            return CopyResult(spec.name, "error", error=str(error))

    with ThreadPoolExecutor(max_workers=workers) as pool:
        return list(pool.map(inheritable_thread_target(spark)(guarded), specs))
