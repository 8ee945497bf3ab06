"""Small value types that the operators share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Defaults that users of the replication tool rely on.
DEFAULT_BATCH_ROWS = 300_000
DEFAULT_WORKERS = 3
POLL_INTERVAL = "5 seconds"

# A top-k merges what every task keeps in one last task. That is fine for small
# limits and small tables; anything larger goes by key ranges instead.
MAX_GATHER_ROWS = 1_000_000

SMALL_LIMIT = 100

# Up to this many narrow lookup rows (a key and a number) may be broadcast.
MAX_BROADCAST_ROWS = 1_000_000

# JSON cuts timestamps to milliseconds unless told otherwise.
TIMESTAMP_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


@dataclass(frozen=True)
class Watermark:
    """Which column orders change: ``kind`` is datetime, integer or count."""

    kind: str
    column: str | None = None

    @property
    def by_count(self) -> bool:
        return self.kind == "count"


@dataclass(frozen=True)
class TableSpec:
    """What to copy of one table and how to lay it out in the target.

    ``month_of`` names the date column whose month partitions the target.
    ``month_column`` names a partition column of the source that holds the month
    of its watermark: reads of new rows prune by it, and it is not copied.
    ``parts`` above 1 makes the first copy of a large table resumable.
    ``late_ranges`` keeps digests of the watermark's ranges, by which rows are
    found that arrive below it: a calendar unit ("month") or a width.
    ``mirror_key`` makes the target a mirror by that unique key: every poll
    compares whole states, so updates and deletes are applied too.
    """

    name: str
    sort_key: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()
    month_of: str | None = None
    month_column: str | None = None
    watermark: Watermark | None = None
    parts: int = 1
    late_ranges: str | int | None = None
    mirror_key: tuple[str, ...] = ()

    @property
    def withheld(self) -> tuple[str, ...]:
        return (*self.excluded, self.month_column) if self.month_column else self.excluded


@dataclass(frozen=True)
class TableState:
    """Last saved progress of one table; one row of the state log."""

    table: str
    synced_rows: int = 0
    initial_sync_complete: bool = False
    watermark_column: str | None = None
    watermark_value: str | None = None
    batch_seq: int = -1


def fits_one_task(df: DataFrame, limit: int, max_gather: int = MAX_GATHER_ROWS) -> bool:
    """Whether a top-k of ``limit`` rows may end in one task, which gets up to that many from every task of the scan.

    Very few rows may, however many tasks there are; else the table is counted.
    """
    return limit <= max_gather and (limit <= SMALL_LIMIT or df.count() <= max_gather)


def is_datetime(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))


def is_watermark_integer(dtype: T.DataType) -> bool:
    """64-bit integers; unsigned ones arrive as ``decimal(20,0)``."""
    return isinstance(dtype, T.LongType) or dtype == T.DecimalType(20, 0)


def typed_literal(value: object, dtype: T.DataType) -> Column:
    """The *literal* takes the column's type, so filters reach the Parquet scan."""
    return F.lit(value).cast(dtype)


def as_text(column: str | Column, dtype: T.DataType) -> Column:
    """A watermark value as text that casts back to the same value.

    Zoned timestamps are written in UTC, so a later session in another time
    zone reads the same instant.
    """
    column = F.col(column) if isinstance(column, str) else column
    if isinstance(dtype, T.TimestampType):
        utc = F.to_utc_timestamp(column, F.current_timezone())
        return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return column.cast("string")
