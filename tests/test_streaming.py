"""Following files: exactly once, replay, derived tables, repeats."""

from pyspark.sql import functions as F

from tidemark import sources, streaming

TIMEOUT = 120


def add_file(spark, folder, start, stop):
    at = F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).cast("timestamp_ntz")
    spark.range(start, stop, 1, 1).select("id", at.alias("at"), (F.col("id") % 3).alias("k")).write.mode(
        "append"
    ).parquet(folder)


def stream_of(spark, folder, **options):
    return streaming.read_stream(spark, folder, spark.read.parquet(folder).schema, **options)


def run(query):
    assert query.awaitTermination(TIMEOUT)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_files_arrive_once_across_restarts(spark, folder):
    source, target, offsets = (f"{folder}/{n}" for n in ("in", "out", "offsets"))
    for start in range(0, 50, 10):
        add_file(spark, source, start, start + 10)
    run(streaming.follow(stream_of(spark, source, max_files=2), target, offsets, once=True))
    assert ids(spark.read.parquet(target)) == list(range(50))
    add_file(spark, source, 5, 15)  # late values in a new file are read like any other
    run(streaming.follow(stream_of(spark, source), target, offsets, once=True))
    assert ids(spark.read.parquet(target)) == sorted([*range(50), *range(5, 15)])
    run(streaming.follow(stream_of(spark, source), target, offsets, once=True))
    assert spark.read.parquet(target).count() == 60


def test_excluded_columns_stay_behind(spark, folder):
    add_file(spark, f"{folder}/in", 0, 5)
    stream = stream_of(spark, f"{folder}/in", excluded=["k"])
    run(streaming.follow(stream, f"{folder}/out", f"{folder}/offsets", once=True))
    assert spark.read.parquet(f"{folder}/out").columns == ["id", "at"]


def test_batches_replay_into_themselves_and_feed_derived_tables(spark, folder):
    source, target, offsets = (f"{folder}/{n}" for n in ("in", "out", "offsets"))
    for start in (0, 10, 20):
        add_file(spark, source, start, start + 10)
    errors, view = [], f"{folder}/view"

    def count_per_key(batch, seq):
        batch.groupBy("k").count().write.mode("overwrite").parquet(f"{view}/batch_seq={seq}")

    def view_is_broken(batch, seq):
        raise RuntimeError("view is broken")

    def start(derived):
        return streaming.follow_in_batches(
            stream_of(spark, source, max_files=1),
            target,
            offsets,
            once=True,
            month_of="at",
            sort_key=["id"],
            derived=derived,
            on_error=lambda sink, error: errors.append((sink, error)),
        )

    run(start({"good": count_per_key, "bad": view_is_broken}))
    assert ids(sources.read_target(spark, target)) == list(range(30))
    assert [e[0] for e in errors] == ["bad"] * 3 and "view is broken" in errors[0][1]

    # the data of the next batch are stored, but its commit is lost: it runs again
    add_file(spark, source, 30, 40)
    lost = spark.read.parquet(source).filter("id >= 30 AND id < 35")
    sources.write_batch(lost, target, 3, "at")
    run(start(None))
    assert ids(sources.read_target(spark, target)) == list(range(40))
    assert spark.read.parquet(view).agg({"count": "sum"}).first()[0] == 30


def test_repeats_within_the_delay_are_dropped(spark, folder):
    source, target, offsets = (f"{folder}/{n}" for n in ("in", "out", "offsets"))
    add_file(spark, source, 0, 20)
    add_file(spark, source, 10, 30)
    zoned = stream_of(spark, source).withColumn("at", F.col("at").cast("timestamp"))
    once = streaming.drop_repeats(zoned, ["id"], "at", "1 hour")
    run(streaming.follow(once, target, offsets, once=True))
    assert ids(spark.read.parquet(target)) == list(range(30))


def test_continuous_trigger_keeps_polling(spark, folder):
    source, target, offsets = (f"{folder}/{n}" for n in ("in", "out", "offsets"))
    add_file(spark, source, 0, 5)
    query = streaming.follow(stream_of(spark, source), target, offsets, interval="200 milliseconds")
    try:
        query.processAllAvailable()
        add_file(spark, source, 5, 9)
        query.processAllAvailable()
    finally:
        query.stop()
    assert ids(spark.read.parquet(target)) == list(range(9))


def test_json_lines_are_followed_with_their_microseconds(spark, folder):
    df = spark.range(5).select("id", F.timestamp_micros(F.col("id")).cast("timestamp_ntz").alias("at"))
    sources.write_json_lines(df, f"{folder}/in")
    stream = streaming.read_stream(spark, f"{folder}/in", df.schema, file_format="json")
    run(streaming.follow(stream, f"{folder}/out", f"{folder}/offsets", once=True))
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/out").collect())) == sorted(map(tuple, df.collect()))
