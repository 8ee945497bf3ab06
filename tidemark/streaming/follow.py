"""Following a folder of files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.projection import project
from tidemark.session import path_exists
from tidemark.sources.target import BATCH_COLUMN, check_target, write_batch, write_derived
from tidemark.types import POLL_INTERVAL, TIMESTAMP_OPTIONS


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    excluded: Sequence[str] = (),
    max_files: int | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """New files of a folder (or a glob) as a stream, with excluded columns left out."""
    reader = spark.readStream.schema(schema).format(file_format)
    if file_format == "json":
        reader = reader.options(**TIMESTAMP_OPTIONS)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return project(reader.load(path), excluded)


def drop_repeats(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Each key once within the delay; state older than that is dropped.

    Event times without a zone are read in the session's zone.
    """
    timed = stream.withColumn("_event_time", F.col(f"`{event_time}`").cast("timestamp"))
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")


def errors_path(target: str) -> str:
    return f"{target}_errors"


def derived_errors(spark: SparkSession, target: str) -> DataFrame:
    """``batch, sink, error`` of derived tables that could not be fed; no rows if there was none."""
    schema = "sink string, error string, batch long"
    if not path_exists(spark, errors_path(target)):
        return spark.createDataFrame([], schema).select("batch", "sink", "error")
    return spark.read.schema(schema).parquet(errors_path(target)).select("batch", "sink", "error")


def follow(
    stream: DataFrame, target: str, checkpoint: str, once: bool = False, interval: str = POLL_INTERVAL
) -> StreamingQuery:
    """Append a stream to a Parquet table exactly once, every few seconds.

    ``once`` takes what is there and ends. The checkpoint belongs to the query:
    a restart goes on where it stopped. A target of another schema is an error.
    """
    check_target(stream, target)
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return _start(writer, once, interval)


def follow_in_batches(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    once: bool = False,
    interval: str = POLL_INTERVAL,
    month_of: str | None = None,
    sort_key: Sequence[str] = (),
    derived: Mapping[str, Callable[[DataFrame, int], object]] | None = None,
    on_error: Callable[[str, str], object] | None = None,
) -> StreamingQuery:
    """The same into the batch layout, with derived tables fed after the base rows.

    A replayed batch replaces its own partition. Derived tables read the stored
    batch, so the source is not read twice. Their errors go to ``on_error`` and,
    as rows ``batch, sink, error`` that a replay of the batch replaces, to the
    table beside the target that :func:`derived_errors` reads.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        check_target(batch, target)
        write_batch(batch, target, batch_id, month_of, sort_key)
        if derived:
            spark = batch.sparkSession
            stored = spark.read.schema(batch.schema).parquet(f"{target}/{BATCH_COLUMN}={batch_id}")
            failed = [(sink, error) for sink, error in write_derived(stored, batch_id, derived) if error is not None]
            path = f"{errors_path(target)}/batch={batch_id}"
            if failed or path_exists(spark, path):
                spark.createDataFrame(failed, "sink string, error string").write.mode("overwrite").parquet(path)
            for sink, error in failed if on_error else ():
                on_error(sink, error)

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return _start(writer, once, interval)


def _start(writer, once: bool, interval: str) -> StreamingQuery:
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()
