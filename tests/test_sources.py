"""State log, JSON lines, batches and the month layout."""

import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import sources
from tidemark.types import TableState


def test_unknown_table_starts_from_nothing(spark, folder):
    assert sources.load_state(spark, folder) == {}
    state = sources.state_of({}, "t")
    assert (state.synced_rows, state.initial_sync_complete, state.watermark_value) == (0, False, None)


def test_latest_state_wins_and_tables_are_independent(spark, folder):
    log = [TableState(t, 37 * n + len(t), n > 2, None if n < 2 else "seen_on", None if n < 2 else f"2031-05-{n + 10}", n)
           for n in range(5) for t in ("harbour", "tides", "odd/name=1") if n < 3 or t != "tides"]
    for state in log:
        sources.append_state(spark, folder, [state])
    assert sources.load_state(spark, folder) == {state.table: state for state in log}
    assert sources.read_state_log(spark, folder).count() == len(log)


def test_compacting_the_log_changes_nothing(spark, folder):
    assert sources.compact_state_log(spark, folder) == 0
    for n in range(5):
        sources.append_state(spark, folder, [TableState("a", n, True, "ts", f"2024-01-0{n + 1}", n)])
    sources.append_state(spark, folder, [TableState("b", 7, False, None, None, 0)])
    before = sources.load_state(spark, folder)
    assert sources.compact_state_log(spark, folder) == 6
    assert sources.load_state(spark, folder) == before
    assert sources.read_state_log(spark, folder).count() == 2
    assert sources.compact_state_log(spark, folder) == 0
    sources.append_state(spark, folder, [TableState("a", 9, True, "ts", "2024-02-01", 9)])
    assert sources.load_state(spark, folder)["a"].batch_seq == 9


def test_layout_names_and_other_schemas_are_refused(spark, folder):
    rows = spark.range(3).withColumn("tidemark_month", F.lit(1))
    with pytest.raises(ValueError, match="tidemark_month"):
        sources.check_target(rows, folder + "/t")
    sources.write_batch(spark.range(3).withColumn("batch_seq", F.lit(5)).withColumn("yyyymm", F.lit("x")), folder + "/t", 0)
    assert sources.read_target(spark, folder + "/t").columns == ["id", "batch_seq", "yyyymm"]
    for other in (spark.range(3), spark.range(3).selectExpr("cast(id as string) id", "5 AS batch_seq", "'x' AS yyyymm")):
        with pytest.raises(ValueError, match="differ"):
            sources.check_target(other, folder + "/t")


def test_stale_batches_go_without_a_job(spark, folder):
    for seq in range(12):
        sources.write_batch(spark.range(seq + 1), folder, seq)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    assert sources.discard_uncommitted(spark.range(1), folder, 3) == list(range(4, 12))
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert sources.read_target(spark, folder).count() == 1 + 2 + 3 + 4
    assert sources.discard_uncommitted(spark.range(1), folder, 3) == []


def test_a_foreign_or_broken_log_is_an_error(spark, folder):
    spark.range(3).write.parquet(folder + "/other")
    with pytest.raises(ValueError, match="no state log"):
        sources.load_state(spark, folder + "/other")
    sources.append_state(spark, folder + "/log", [TableState("a", 1, True, None, None, 0)])
    for path in glob.glob(folder + "/log/table-a/part-*.parquet"):
        with open(path, "r+b") as file:
            file.write(b"XXXX")
            file.seek(-4, 2)
            file.write(b"XXXX")
    with pytest.raises(Exception):
        sources.load_state(spark, folder + "/log")


def test_pending_batches(spark, folder):
    sources.append_state(spark, folder, [TableState("a", 1, False, None, None, n) for n in (0, 2)])
    sources.append_state(spark, folder, [TableState("b", 1, False, None, None, 1)])
    planned = spark.range(4).withColumnRenamed("id", "batch_seq")
    left = sources.pending_batches(planned, sources.read_state_log(spark, folder), "a")
    assert sorted(r["batch_seq"] for r in left.collect()) == [1, 3]


def write_lines(path, *lines):
    with open(path, "w") as file:
        file.write("\n".join(lines))
    return path


def test_json_lines_strict_and_tolerant(spark, tmp_path):
    path = write_lines(tmp_path / "x.jsonl", '{"v":5}', "", "not-json", "   ", '{"v":3}')
    schema = spark.createDataFrame([], "v long").schema
    tolerant = sources.read_json_lines(spark, str(path), schema, strict=False)
    assert sorted(r["v"] for r in tolerant.collect()) == [3, 5]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|[Mm]alformed"):
        sources.read_json_lines(spark, str(path), schema).collect()
    kept = sources.read_with_bad_lines(spark, str(path), schema)
    assert sorted((r["v"], r["_corrupt_record"]) for r in kept.collect() if r["v"]) == [(3, None), (5, None)]
    assert [r["_corrupt_record"] for r in kept.collect() if r["v"] is None] == ["not-json"]
    assert tuple(sources.count_bad_lines(spark, str(path)).first()) == (3, 1)


def test_json_lines_keep_every_type(spark, folder):
    df = spark.sql(
        "SELECT 1L AS id, timestamp_ntz'2024-01-01 00:00:00.000001' AS t, "
        "timestamp'2024-01-01 00:00:00.000002Z' AS z, date'2024-02-29' AS d, "
        "cast(18446744073709551615 AS decimal(20,0)) AS u, array(1.5f, null) AS xs, map('k', 1) AS m, "
        "cast(null AS string) AS s, struct('a\"b' AS q) AS n"
    )
    sources.write_json_lines(df, folder)
    back = sources.read_json_lines(spark, folder, df.schema)
    assert [r.asDict(True) for r in back.collect()] == [r.asDict(True) for r in df.collect()]
    sources.write_json_lines(df, folder)
    assert sources.read_json_lines(spark, folder, df.schema).count() == 2
    assert '"s":null' in spark.read.text(folder).first()[0]


def dated(spark, n=200):
    at = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id AS int) % 90)")
    return spark.range(n).select("id", at.alias("at"), (F.col("id") % 7).alias("v"))


def test_a_replayed_batch_replaces_itself(spark, folder):
    df = dated(spark)
    assert sources.write_batch(df.filter("id < 50"), folder, 0) == 50
    assert sources.write_batch(df.filter("id >= 50 AND id < 60"), folder, 1) == 10
    assert sources.write_batch(df.filter("id >= 50"), folder, 1) == 150
    assert sorted(r["id"] for r in sources.read_target(spark, folder).collect()) == list(range(200))
    assert sources.write_batch(df.filter("false"), folder, 1) == 0
    assert sources.read_target(spark, folder).count() == 50


def test_month_layout_prunes_and_sorts(spark, folder):
    df = dated(spark)
    assert sources.write_batch(df, folder, 0, "at", ["v", "id"]) == 200
    stored = sources.read_target(spark, folder, keep_layout=True)
    assert {r["tidemark_month"] for r in stored.select("tidemark_month").distinct().collect()} == {202401, 202402, 202403}
    assert stored.filter(F.col("tidemark_month") != F.date_format("at", "yyyyMM").cast("int")).count() == 0
    assert sources.read_target(spark, folder).columns == ["id", "at", "v"]
    one_file = glob.glob(folder + "/tidemark_batch=0/tidemark_month=202402/*.parquet")[0]
    rows = [(r["v"], r["id"]) for r in spark.read.parquet(one_file).collect()]
    assert rows == sorted(rows)


def test_the_layout_splits_a_hot_month(spark, folder):
    """Copies of one row fill one month; adaptive execution must not leave them to one task."""
    hot = spark.range(0, 200_000, 1, 8).select(
        F.lit(datetime(2024, 5, 1)).cast("timestamp_ntz").alias("at"), F.lit("x").alias("v")
    )
    saved = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        assert sources.write_batch(hot, folder, 0, "at") == 200_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", saved)
    assert len(glob.glob(folder + "/tidemark_batch=0/tidemark_month=202405/*.parquet")) > 1


def test_layout_needs_its_columns(spark):
    with pytest.raises(ValueError, match="excluded"):
        sources.month_layout(dated(spark).drop("v"), "at", ["v"])


def test_schema_mismatch_is_an_error(spark, folder):
    assert sources.target_schema(spark, folder) is None
    sources.write_batch(dated(spark), folder, 0, "at")
    schema = sources.target_schema(spark, folder)
    sources.check_schema(dated(spark), schema)
    with pytest.raises(ValueError, match="'v'"):
        sources.check_schema(dated(spark).withColumn("v", F.col("v").cast("string")), schema)
    with pytest.raises(ValueError, match="'extra'"):
        sources.check_schema(dated(spark).withColumn("extra", F.lit(1)), schema)


def test_a_failing_derived_table_blocks_nothing(spark, folder):
    seen = []

    def broken(batch, seq):
        raise RuntimeError("no such view")

    sinks = {"a": broken, "b": lambda df, seq: seen.append((df.count(), seq))}
    results = sources.write_derived(spark.range(3), 7, sinks)
    assert results == [("a", "no such view"), ("b", None)] and seen == [(3, 7)]


def test_catalog_tables_without_views(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    for name in ("orders", "customer"):
        spark.range(3).write.parquet(f"{folder}/{name}")
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW temp_{name} AS SELECT 1")
        spark.sql(f"CREATE TABLE IF NOT EXISTS shop.{name} (id BIGINT) USING parquet LOCATION '{folder}/{name}'")
    spark.sql("CREATE VIEW IF NOT EXISTS shop.recent AS SELECT * FROM shop.orders")
    assert sources.list_tables(spark, "shop") == ["customer", "orders"]
    assert sources.table_reader(spark, "shop")("orders").count() == 3
    assert sources.file_reader(spark, folder)("customer").count() == 3
