"""Progress kept as intervals: one small increment per batch, united when read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.intervals import unite_intervals
from tidemark.session import delete_files, list_files, list_folder
from tidemark.sources.target import BATCH_COLUMN, read_target, write_batch


def record_intervals(pieces: DataFrame, path: str, batch_seq: int) -> int:
    """Store what a batch has done; the same batch again replaces itself. Returns the intervals.

    Batches are counted from 0 on and may be recorded in any order.
    """
    if batch_seq < 0:
        raise ValueError(f"batches are counted from 0 on, not {batch_seq}")
    return write_batch(pieces, path, batch_seq)


def read_intervals(spark: SparkSession, path: str, key: str, start: int = 0, step: int = 1) -> DataFrame:
    """All that is recorded, united."""
    return unite_intervals(read_target(spark, path), key=key, start=start, step=step)


def compact_intervals(spark: SparkSession, path: str, key: str, start: int = 0, step: int = 1) -> int:
    """Unite the recorded increments into one; returns how many files went.

    For the one writer of the record, between batches. The union is stored below
    a number no batch has before older files are deleted, and saying a place
    twice changes nothing, so a crash at any point, or a batch written again
    afterwards, leaves a record that reads the same.
    """
    held = {seq: files for seq, files in _files_by_batch(spark, path).items() if files}
    if len(held) < 2:
        return 0
    # below all numbers so far, so the union never replaces what it is read from
    seq = min(-1 - max(held), min(held) - 1)
    write_batch(read_intervals(spark, path, key, start, step), path, seq)
    old = [file for files in held.values() for file in files]
    delete_files(spark, old)
    return len(old)


def _files_by_batch(spark: SparkSession, path: str) -> dict[int, list[str]]:
    names = {folder: folder.rsplit("/", 1)[-1] for folder in list_folder(spark, path)}
    prefix = f"{BATCH_COLUMN}="
    return {int(n.removeprefix(prefix)): list_files(spark, f) for f, n in names.items() if n.startswith(prefix)}
