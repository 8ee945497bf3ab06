"""The target table: batches that replace themselves, months, sorted files."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.functions.scalar import month_number
from tidemark.session import delete_files, list_files, list_folder, path_exists
from tidemark.sources.writer import check_writer

# Names that no source should hold; a table that does is refused before anything is written.
BATCH_COLUMN = "tidemark_batch"
MONTH_COLUMN = "tidemark_month"


def month_layout(df: DataFrame, date_column: str, sort_key: Sequence[str] = ()) -> DataFrame:
    """Add the month and bring its rows together, each piece sorted by the key.

    The rebalance sends a month to one task but lets adaptive execution split a
    month that is too large, whatever its rows hold, and join small ones.
    """
    missing = [c for c in (date_column, *sort_key) if c not in df.columns]
    if missing:
        raise ValueError(f"the layout needs columns that are excluded: {missing}")
    monthly = df.withColumn(MONTH_COLUMN, month_number(F.col(f"`{date_column}`")))
    return monthly.hint("rebalance", MONTH_COLUMN).sortWithinPartitions(MONTH_COLUMN, *_quoted(sort_key))


def check_schema(df: DataFrame, target: T.StructType) -> None:
    """Names and types must agree; a target is never adapted by guess."""
    ours = {f.name: f.dataType for f in df.schema.fields}
    theirs = {f.name: f.dataType for f in target.fields if f.name not in (BATCH_COLUMN, MONTH_COLUMN)}
    if ours != theirs:
        odd = sorted(n for n in ours.keys() | theirs.keys() if ours.get(n) != theirs.get(n))
        raise ValueError(f"source and target differ in columns {odd}")


def check_names(df: DataFrame) -> None:
    """The layout's own columns must not come from the source: they would vanish on reading."""
    clash = sorted(c for c in df.columns if c.lower() in (BATCH_COLUMN, MONTH_COLUMN))
    if clash:
        raise ValueError(f"the target keeps its layout in columns {clash}: rename or exclude them")


def check_target(df: DataFrame, path: str) -> None:
    """Before every write: this session's claim, free names, and the schema of what is already stored."""
    check_writer(df.sparkSession, path)
    check_names(df)
    existing = target_schema(df.sparkSession, path)
    if existing is not None:
        check_schema(df, existing)


def target_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema of an existing target, from one footer; None if there is none."""
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without data files
            return None
        raise


def write_batch(
    df: DataFrame,
    path: str,
    batch_seq: int,
    month_of: str | None = None,
    sort_key: Sequence[str] = (),
) -> int:
    """Write one batch as its own partition and return its row count.

    A repeated batch replaces itself, so a write that is replayed after a crash
    changes nothing. Rows are counted in the task that writes them.
    """
    check_writer(df.sparkSession, path)
    if month_of is not None:
        rows = month_layout(df, month_of, sort_key)
    else:
        rows = df.sortWithinPartitions(*_quoted(sort_key)) if sort_key else df
    layout = [MONTH_COLUMN] if month_of is not None else []
    return _write_counted(rows, f"{path}/{BATCH_COLUMN}={batch_seq}", layout, "static")


def write_batches(
    df: DataFrame, path: str, month_of: str | None = None, sort_key: Sequence[str] = ()
) -> int:
    """Write all batches of ``df``, told apart by its column BATCH_COLUMN, in one job.

    Only the batches in ``df`` are replaced. As in :func:`month_layout`, the rows
    of a batch come together and adaptive execution splits a batch that is too
    large.
    """
    check_writer(df.sparkSession, path)
    layout = [BATCH_COLUMN]
    if month_of is not None:
        df = df.withColumn(MONTH_COLUMN, month_number(F.col(f"`{month_of}`")))
        layout.append(MONTH_COLUMN)
    rows = df.hint("rebalance", *layout).sortWithinPartitions(*layout, *_quoted(sort_key))
    return _write_counted(rows, path, layout, "dynamic")


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def _write_counted(rows: DataFrame, path: str, layout: Sequence[str], overwrite: str) -> int:
    counted = Observation()
    writer = rows.observe(counted, F.count("*").alias("n_rows")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", overwrite).partitionBy(*layout).parquet(path)
    return counted.get["n_rows"]


def discard_uncommitted(
    df: DataFrame, path: str, last_seq: int, month_of: str | None = None, sort_key: Sequence[str] = ()
) -> list[int]:
    """Delete the files of batches above the last one the state log knows; for a restart.

    A run that died between data and state may have left them. Their files are
    found by listing alone: no job runs and no committed file is opened, however
    many batches were left. ``df`` gives the session.
    """
    spark = df.sparkSession
    check_writer(spark, path)
    if not path_exists(spark, path):
        return []
    stale: dict[int, list[str]] = {}
    for folder in list_folder(spark, path):
        name = folder.rsplit("/", 1)[-1]
        if name.startswith(f"{BATCH_COLUMN}=") and int(name.split("=")[1]) > last_seq:
            stale[int(name.split("=")[1])] = list_files(spark, folder)
    delete_files(spark, (file for files in stale.values() for file in files))
    return sorted(seq for seq, files in stale.items() if files)


def read_target(
    spark: SparkSession, path: str, keep_layout: bool = False, upto: int | None = None
) -> DataFrame:
    """All batches, or those committed up to a state's; the layout columns only on request."""
    df = spark.read.parquet(path)
    if upto is not None:
        df = df.filter(F.col(BATCH_COLUMN) <= upto)
    return df if keep_layout else df.drop(BATCH_COLUMN, MONTH_COLUMN)


def write_derived(
    batch: DataFrame, batch_seq: int, sinks: Mapping[str, Callable[[DataFrame, int], object]]
) -> list[tuple[str, str | None]]:
    """Feed derived tables from a batch that is already stored.

    A sink gets the batch and its number, so that it can replace what a replay
    wrote before. Returns ``(sink, error)`` for each: a failing derived table is
    reported and neither blocks the others nor the base rows.
    """
    results = []
    for name, write in sinks.items():
        try:
            write(batch, batch_seq)
            results.append((name, None))
        except Exception as error:  # a sink may fail in any way
            results.append((name, str(error)))
    return results
