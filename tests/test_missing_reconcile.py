"""Missing rows, counts, ranges and the contiguous frontier."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark import operators as ops


def bag(df):
    return Counter(tuple(map(str, r)) for r in df.collect())


@pytest.mark.parametrize("by_digest", [False, True])
def test_missing_rows_are_a_multiset_difference(spark, by_digest):
    rnd = random.Random(1)

    def some(n):
        return [(rnd.randrange(5), rnd.choice([None, "a", "b"])) for _ in range(n)]

    a, b = some(200), some(150)
    schema = "k long, v string"
    src, dst = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    missing = bag(ops.missing_rows(src, dst, by_digest))
    assert missing == Counter(tuple(map(str, r)) for r in (Counter(a) - Counter(b)).elements())
    surplus = bag(ops.surplus_rows(src, dst, by_digest))
    assert surplus == Counter(tuple(map(str, r)) for r in (Counter(b) - Counter(a)).elements())


@pytest.mark.parametrize("by_digest", [False, True])
def test_nulls_zeros_and_microseconds_are_told_apart(spark, by_digest):
    one = spark.sql(
        "SELECT null AS a, 'x' AS b, timestamp_ntz'2024-01-01 00:00:00.000001' AS t, 0.0d AS d"
    )
    other = spark.sql(
        "SELECT 'x' AS a, null AS b, timestamp_ntz'2024-01-01 00:00:00.000001' AS t, 0.0d AS d "
        "UNION ALL SELECT null, 'x', timestamp_ntz'2024-01-01 00:00:00.000002', 0.0d"
    )
    assert ops.missing_rows(one, other, by_digest).count() == 1
    negative_zero = one.withColumn("d", F.lit(-0.0))
    assert ops.missing_rows(one, negative_zero, by_digest).count() == 0


@pytest.mark.parametrize("by_digest", [False, True])
def test_maps_compare_by_content(spark, by_digest):
    one = spark.sql("SELECT 1 AS id, map('a', 1, 'b', 2) AS m UNION ALL SELECT 2, map('c', 3)")
    other = spark.sql("SELECT map('b', 2, 'a', 1) AS m, 1 AS id")
    rest = ops.missing_rows(one, other, by_digest)
    assert [(r["id"], r["m"]) for r in rest.collect()] == [(2, {"c": 3})]
    assert rest.columns == ["id", "m"]


@pytest.mark.parametrize("by_digest", [False, True])
def test_nested_values_keep_their_bounds(spark, by_digest):
    one = spark.sql("SELECT array(1, 2) AS a, array() AS b, struct(null AS p, 1 AS q) AS s")
    for other in (
        "SELECT array(1) AS a, array(2) AS b, struct(null AS p, 1 AS q) AS s",
        "SELECT array(1, null, 2) AS a, array() AS b, struct(null AS p, 1 AS q) AS s",
        "SELECT array(1, 2) AS a, array() AS b, struct(1 AS p, null AS q) AS s",
        "SELECT array(1, 2) AS a, null AS b, struct(null AS p, 1 AS q) AS s",
    ):
        target = spark.createDataFrame([], "a array<int>, b array<int>, s struct<p:int,q:int>").unionByName(
            spark.sql(other).selectExpr(
                "cast(a AS array<int>) a", "cast(b AS array<int>) b", "cast(s AS struct<p:int,q:int>) s"
            )
        )
        source = one.selectExpr(
            "cast(a AS array<int>) a", "cast(b AS array<int>) b", "cast(s AS struct<p:int,q:int>) s"
        )
        assert ops.missing_rows(source, target, by_digest).count() == 1, other
        assert ops.missing_rows(source, source, by_digest).count() == 0


def test_many_copies_of_one_row_are_written_by_many_tasks(spark):
    source = spark.range(0, 200_003, 1, 4).select(F.lit("x").alias("v"), F.lit(None).cast("int").alias("n"))
    rest = ops.missing_rows(source, source.limit(3))
    per_task = [r["n_rows"] for r in rest.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n_rows")).collect()]
    assert sum(per_task) == 200_000 and max(per_task) < 120_000
    assert rest.distinct().count() == 1


def test_content_finds_what_position_misses(spark):
    """A new row that sorts first: the tail by count copies the wrong row."""
    source = spark.createDataFrame([(i,) for i in range(10)], "id long")
    target = source.filter("id > 0")
    assert [r["id"] for r in ops.missing_rows(source, target).collect()] == [0]
    assert [r["id"] for r in ops.tail_by_count(source, target, ["id"]).collect()] == [9]


def test_reconcile_statuses(spark):
    pairs = {
        "same": (spark.range(3), spark.range(3)),
        "short": (spark.range(3), spark.range(1)),
        "extra": (spark.range(0), spark.range(2)),
        "empty": (spark.range(0), spark.range(0)),
    }
    got = {r["table"]: (r["src"], r["dst"], r["diff"], r["status"]) for r in ops.reconcile_counts(pairs).collect()}
    assert got == {
        "same": (3, 3, 0, "match"),
        "short": (3, 1, 2, "target_short"),
        "extra": (0, 2, -2, "target_extra"),
        "empty": (0, 0, 0, "match"),
    }


def test_uneven_ranges_see_changed_values(spark):
    source = spark.range(100).selectExpr("id", "id * 2 AS v")
    target = source.withColumn("v", F.when(F.col("id") == 42, 0).otherwise(F.col("v")))
    got = [tuple(r) for r in ops.uneven_ranges(source, target, "id", 10).collect()]
    assert got == [(40, 10, 10)]
    assert ops.uneven_ranges(source, source, "id", 10).count() == 0


@pytest.mark.parametrize(
    "start, step, completed, frontiers",
    [
        (7, 3, [7, 10, 13, 16], [10, 13, 16, 19]),
        (7, 3, [16, 13, 10, 7], [7, 7, 7, 19]),
        (-20, 20, [20, -20, 0], [-20, 0, 40]),
        (1, 1, [1, 1, 2, 2], [2, 2, 3, 3]),
        (250, 25, [], []),
        (0, 10, [0, 5, 10, -10], [10, 10, 20, 20]),
    ],
)
def test_frontier_after_every_step(spark, start, step, completed, frontiers):
    """Each prefix of the completions is one key."""
    rows = [(n, seq) for n in range(1, len(completed) + 1) for seq in completed[:n]]
    df = spark.createDataFrame(rows, "key int, seq long")
    got = {r["key"]: r["frontier"] for r in ops.contiguous_frontier(df, "key", "seq", start, step).collect()}
    assert [got[n] for n in sorted(got)] == frontiers


def test_frontier_against_brute_force(spark):
    rnd = random.Random(9)
    rows = [("hot", rnd.randrange(300)) for _ in range(900)] + [(f"k{rnd.randrange(30)}", rnd.randrange(12)) for _ in range(600)]
    rows += [("none", None), ("odd", -3)]
    df = spark.createDataFrame(rows, "key string, seq long").repartition(6)
    got = {r["key"]: (r["frontier"], r["n_ahead"]) for r in ops.contiguous_frontier(df, "key", "seq").collect()}
    want = {}
    for key in {k for k, _ in rows}:
        done = {s for k, s in rows if k == key and s is not None and s >= 0}
        frontier = next(p for p in range(len(done) + 1) if p not in done)
        want[key] = (frontier, sum(s > frontier for s in done))
    assert got == want


def test_same_rows_in_any_order(spark):
    df = spark.range(500).selectExpr("id", "IF(id % 7 = 0, null, id % 11) AS v", "array(id, null) AS a")
    assert ops.same_rows(df, df.repartition(5, "v").select("a", "v", "id"))
    assert not ops.same_rows(df, df.filter("id <> 250"))
    assert not ops.same_rows(df, df.unionByName(df.limit(1)))
    assert not ops.same_rows(df, df.withColumn("v", F.when(F.col("id") == 3, 9).otherwise(F.col("v"))))
    assert ops.same_rows(df.limit(0), df.limit(0))
    plan = ops.missing_rows(df, df.filter("id > 9"), by_digest=True)
    assert "SortMergeJoin" not in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == 10
