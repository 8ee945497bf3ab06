"""The latest version of every key as a stream of changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: The column of the change log that tells what a row does, and what it says.
OP_COLUMN = "tidemark_op"
INSERT, UPDATE = "insert", "update"
#: Rows that a task holds, one per key, before it deals them.
HELD_ROWS = 100_000
#: Tasks that may share the rows of one key.
SPREAD = 8
#: Groups that keys are dealt to; a group's state is read and written at once.
BUCKETS = 1024
#: Fixed value: the engine's state store that keeps state on disk.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_disk_state(spark: SparkSession) -> None:
    """Keep streaming state in the store on disk; for before a stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def latest_versions(
    stream: DataFrame, keys: Sequence[str], version: Sequence[str], keep: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """A change log of the greatest version of every key: the stream's columns and OP_COLUMN.

    A row that is not newer than what its key has shown before is dropped,
    however late it comes; of several new versions in one micro-batch only the
    greatest is told. So the log is at most as long as the stream, the last row
    of a key is its latest version, and folding the log by ``version`` is the
    same as folding the whole stream. Versions compare column by column, NULL
    below everything; of equal versions the first seen stays, so add columns
    that break ties. NULL keys are a key.

    Each task deals the newest row per key only, in buckets of keys. State is
    one row per key, in a store on disk that checkpoints with the stream. The
    state of a bucket is read and written as one value, once a micro-batch that
    has rows of it: calls to Python cost more than rows. For hundreds of
    millions of keys and small batches take more ``buckets``; they are fixed for
    the life of a checkpoint. Strings that are keys differ if their bytes do.
    ``keep``, such as "30 days", forgets keys that had no newer version
    for so long (by the clock): a still older version would then come out again.
    Such a stream has something to wait for as long as it holds keys, so it is
    for following continuously: a run that is to end when caught up would not.
    """
    missing = [c for c in (*keys, *version) if c not in stream.columns]
    if missing or not keys or not version:
        raise ValueError(f"keys and versions must be columns of the stream: {missing}")
    if any(c.lower() == OP_COLUMN for c in stream.columns):
        raise ValueError(f"the change log tells what a row does in {OP_COLUMN}: rename that column")
    spark = stream.sparkSession
    use_disk_state(spark)
    life = _milliseconds(spark, keep) if keep else None
    bucket = F.pmod(F.xxhash64(*(stream[f"`{k}`"] for k in keys)), F.lit(buckets)).alias("bucket")
    told = T.StructType([*stream.schema.fields, T.StructField(OP_COLUMN, T.StringType())])
    at = [[stream.columns.index(c) for c in names] for names in (keys, version)]
    drop_older, fold, tell = _steps(*at, life, spark.createDataFrame([], told).toArrow().schema)
    rows = stream.select(bucket, *(stream[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(stream.columns)))
    # dealt before Python sees them: a file may be one task, and a key with very many rows goes to several
    dealt = rows.repartition("bucket", F.pmod(F.xxhash64(*(f"c{i}" for i in at[1])), F.lit(SPREAD)))
    changes = dealt.mapInArrow(drop_older, "bucket long, rows binary").groupBy("bucket").applyInPandasWithState(
        fold, "told binary", "held binary", "append", "ProcessingTimeTimeout" if life else "NoTimeout"
    )
    return changes.mapInArrow(tell, told)


def _steps(keys: list[int], version: list[int], life: int | None, told):
    # Functions made here travel to the workers by value, which need not have this library.
    import pickle

    import pandas as pd
    import pyarrow as pa

    held_rows, told_rows, insert, update = HELD_ROWS, 10_000, INSERT, UPDATE

    def ordered(value):
        if isinstance(value, (dict, list)):
            return tuple(map(ordered, value.values() if isinstance(value, dict) else value))
        return value

    nested = any(pa.types.is_nested(told.field(i).type) for i in version)
    exact = not any(pa.types.is_nested(told.field(i).type) or pa.types.is_floating(told.field(i).type) for i in keys)

    def rank(row):
        its = [ordered(row[i]) if nested else row[i] for i in version]
        return tuple([(False, 0) if v is None else (True, v) for v in its])

    def named(value):
        if isinstance(value, tuple):
            return tuple(map(named, value))
        return ("NaN",) if value != value else value  # NaN is one key

    def name_of(row):
        return tuple([row[i] if exact else named(ordered(row[i])) for i in keys])

    def values(column):
        return (column.cast(pa.int64()) if pa.types.is_timestamp(column.type) else column).to_pylist()

    def keep_newest(best, rows):
        for row in rows:
            name, its = name_of(row), rank(row)
            known = best.get(name)
            if known is None or its > known[0]:
                best[name] = (its, row)

    def drop_older(batches):
        """The newest row of each key that a task reads, one blob per bucket; many rows are dealt in turns."""

        def dealt():
            blobs = pa.array([pickle.dumps([row for _, row in best.values()]) for best in held.values()], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), blobs], ["bucket", "rows"])

        held, read = {}, 0
        for batch in batches:
            parts = {}
            for number, *row in zip(*map(values, batch.columns), strict=True):
                parts.setdefault(number, []).append(tuple(row))
            for number, rows in parts.items():
                best = held.setdefault(number, {})
                read -= len(best)
                keep_newest(best, rows)
                read += len(best)
            if read >= held_rows:
                yield dealt()
                held, read = {}, 0
        if held:
            yield dealt()

    def fold(key, frames, state):
        now = state.getCurrentProcessingTimeMs() if life else 0
        held = pickle.loads(state.get[0]) if state.exists else {}
        if life:
            held = {name: known for name, known in held.items() if known[1] > now}
        best, out = {}, []
        if not state.hasTimedOut:
            for frame in frames:
                for blob in frame["rows"]:
                    keep_newest(best, pickle.loads(blob))
        for name, (its, row) in best.items():
            known = held.get(name)
            if known is None or its > rank(known[0]):
                held[name] = (row, now + life if life else 0)
                out.append((*row, insert if known is None else update))
        if held:
            state.update((pickle.dumps(held),))
            if life:
                state.setTimeoutDuration(max(1, min(expires for _, expires in held.values()) - now))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame({"told": [pickle.dumps(out)]})

    def tell(batches):
        def rows():
            for batch in batches:
                for blob in batch.column(0).to_pylist():
                    yield from pickle.loads(blob)

        found = rows()
        while part := [row for row, _ in zip(found, range(told_rows))]:  # noqa: B905
            arrays = []
            for column, field in zip(zip(*part, strict=True), told, strict=True):
                timed = pa.types.is_timestamp(field.type)
                arrays.append(pa.array(column, pa.int64()).cast(field.type) if timed else pa.array(column, field.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=told)

    return drop_older, fold, tell


def _milliseconds(spark: SparkSession, interval: str) -> int:
    micros = spark.sql(f"SELECT unix_micros(timestamp'1970-01-01 00:00:00Z' + INTERVAL {interval})").first()[0]
    if micros <= 0:
        raise ValueError(f"{interval!r} is no time to keep state for")
    return micros // 1000
