"""Positions, ledgers, pages and cuts against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import operators as ops


def keyed(spark, values, parts=4):
    rows = [(v, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k long, id long").repartition(parts)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key."""
    rnd = random.Random(5)
    values = [7] * 400 + [rnd.randrange(-50, 300) for _ in range(800)]
    rnd.shuffle(values)
    return values, keyed(spark, values).cache()


def test_positions_cover_every_place_once(skewed):
    values, df = skewed
    places = [0] * len(values)
    in_order = sorted(values)
    for row in ops.key_positions(df, ["k"]).collect():
        assert row["stop"] - row["start"] == row["n_rows"]
        for place in range(row["start"], row["stop"]):
            places[place] += 1
            assert in_order[place] == row["k"]
    assert set(places) == {1}


@pytest.mark.parametrize("batch_rows", [1, 7, 100, 399, 5000])
def test_ledger_splits_hot_keys_exactly(skewed, batch_rows):
    values, df = skewed
    in_order = sorted(values)
    got = {r["batch_no"]: (r["n_rows"], r["lo"], r["hi"]) for r in ops.batch_ledger(df, ["k"], batch_rows).collect()}
    want = {}
    for start in range(0, len(in_order), batch_rows):
        chunk = in_order[start : start + batch_rows]
        want[start // batch_rows] = (len(chunk), chunk[0], chunk[-1])
    assert got == want


def test_ledger_over_several_keys_and_nulls(spark):
    rows = [(None, 1), ("b", 2), ("a", 3), ("a", 1), (None, 0)]
    df = spark.createDataFrame(rows, "s string, n long")
    got = sorted((r["batch_no"], r["n_rows"], tuple(r["lo"]), tuple(r["hi"])) for r in ops.batch_ledger(df, ["s", "n"], 2).collect())
    assert got == [
        (0, 2, (None, 0), (None, 1)),
        (1, 2, ("a", 1), ("a", 3)),
        (2, 1, ("b", 2), ("b", 2)),
    ]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "k long, id long")
    assert ops.key_positions(empty, ["k"]).count() == 0
    assert ops.batch_ledger(empty, ["k"], 10).count() == 0
    assert ops.tie_safe_batches(empty, "k", 10).count() == 0
    assert ops.read_cut(empty, "k", None, 10) is None
    assert ops.read_cut(empty, "k", None, 10, max_gather=-1) is None
    assert ops.page(empty, ["k"], 5, 5, max_gather=-1).count() == 0


@pytest.mark.parametrize("batch_rows", [1, 10, 250])
def test_tie_safe_batches_are_whole_and_bounded(skewed, batch_rows):
    values, df = skewed
    batches = sorted(tuple(r) for r in ops.tie_safe_batches(df, "k", batch_rows).collect())
    assert sum(b[1] for b in batches) == len(values)
    for (_, n, lo, hi), following in zip(batches, [*batches[1:], None]):
        assert n == sum(lo <= v <= hi for v in values)
        assert n < batch_rows + values.count(hi)
        assert following is None or hi < following[2]


@pytest.mark.parametrize("max_gather", [10**6, 1200 * 2, -1])
@pytest.mark.parametrize("limit", [1, 5, 300, 500, 5000])
def test_tie_safe_batch_equals_rank(skewed, limit, max_gather):
    values, df = skewed
    new = sorted(v for v in values if v > -10)
    cut = new[min(limit, len(new)) - 1]
    got = sorted(r["k"] for r in ops.tie_safe_batch(df, "k", -10, limit, max_gather).collect())
    assert got == [v for v in new if v <= cut]


def test_strict_batch_has_the_exact_size(skewed):
    values, df = skewed
    got = [r["k"] for r in ops.strict_batch(df, "k", -10, 300, "id").collect()]
    assert got == sorted(v for v in values if v > -10)[:300]


@pytest.mark.parametrize("offset, limit", [(0, 10), (3, 4), (95, 10), (100, 5), (0, 100)])
@pytest.mark.parametrize("max_gather", [10**6, -1])
def test_pages(spark, offset, limit, max_gather):
    rows = [(f"g{i % 3}", None if i == 50 else i, float(i) / 7) for i in range(100)]
    df = spark.createDataFrame(rows, "g string, n int, x double").repartition(4)
    in_order = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0))
    got = sorted((tuple(r) for r in ops.page(df, ["g", "n"], offset, limit, max_gather).collect()), key=str)
    assert got == sorted(in_order[offset : offset + limit], key=str)


def test_pages_by_time_keep_microseconds(spark):
    df = spark.range(40).select((F.timestamp_micros(F.col("id"))).cast("timestamp_ntz").alias("t"), "id")
    got = sorted(r["id"] for r in ops.page(df, ["t"], 13, 7, max_gather=-1).collect())
    assert got == list(range(13, 20))


def test_a_page_must_not_cut_equal_keys(spark):
    df = keyed(spark, [1, 1, 1, 2])
    with pytest.raises(ValueError, match="tie-breaking"):
        ops.page(df, ["k"], 0, 2, max_gather=-1)
    with pytest.raises(ValueError):
        ops.page(df, [], 0, 2)


def test_tail_by_count_takes_the_far_end(spark):
    source = spark.range(50)
    for max_gather in (10**6, -1):
        tail = ops.tail_by_count(source, spark.range(44), ["id"], max_gather)
        assert sorted(r["id"] for r in tail.collect()) == list(range(44, 50))
    assert ops.tail_by_count(source, spark.range(60), ["id"]).count() == 0
    with pytest.raises(ValueError):
        ops.tail_by_count(source, spark.range(1), [])


def test_predicate_reaches_the_scan(spark, folder):
    spark.range(100).selectExpr("id", "timestamp_micros(id) AS at").write.parquet(folder)
    df = spark.read.parquet(folder)
    plan = ops.in_range(df, "at", "1970-01-01 00:00:00.000010", "1970-01-01 00:00:00.000020").select("at")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(at," in text and "LessThanOrEqual(at," in text
    assert "ReadSchema: struct<at:timestamp>" in text
    assert plan.count() == 10


@pytest.mark.parametrize("max_gather", [0, 10**6])
def test_pages_and_tails_are_alike_at_any_size(spark, max_gather):
    """Sorted, and an error where the end cuts equal keys, whichever way the ends are found."""
    df = spark.range(60).selectExpr("(id * 37) % 60 AS id", "id div 8 AS t").repartition(5)
    assert [r["id"] for r in ops.page(df, ["id"], 10, 6, max_gather).collect()] == list(range(10, 16))
    assert [r["id"] for r in ops.page(df, ["id"], 57, 20, max_gather).collect()] == [57, 58, 59]
    assert [r["id"] for r in ops.tail_by_count(df, spark.range(52), ["id"], max_gather).collect()] == list(range(52, 60))
    assert [r["id"] for r in ops.strict_batch(df, "id", 20, 4, max_gather=max_gather).collect()] == [21, 22, 23, 24]
    assert len(ops.page(df, ["t"], 8, 16, max_gather).collect()) == 16
    for cut in (
        lambda: ops.page(df, ["t"], 4, 12, max_gather),
        lambda: ops.page(df, ["t"], 8, 9, max_gather),
        lambda: ops.tail_by_count(df, spark.range(50), ["t"], max_gather),
        lambda: ops.strict_batch(df, "t", 1, 3, max_gather=max_gather),
    ):
        with pytest.raises(ValueError, match="equal"):
            cut()


def test_a_large_limit_gathers_nothing(spark):
    df = spark.range(50).repartition(3)
    plan = ops.strict_batch(df, "id", None, 2_000_000, max_gather=0)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan


def test_columns_with_dots(spark):
    df = spark.range(20).withColumnRenamed("id", "a.b")
    assert ops.page(df, ["a.b"], 3, 4).count() == 4
    assert ops.tie_safe_batch(df, "a.b", 4, 5).count() == 5
    assert ops.newer_than(df, "a.b", 15).count() == 4
