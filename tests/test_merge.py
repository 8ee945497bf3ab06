"""Folds against plain Python, with a hot key and ties."""

import random

import pytest

from pyspark.sql import functions as F
from tidemark import operators as ops
from tidemark.sources import latest_per_key


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    keys = ["hot"] * 300 + [f"k{rnd.randrange(40)}" for _ in range(600)]
    return [(k, rnd.randrange(6), i, rnd.choice([-1, 1])) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "key string, ver long, seq long, sign int").repartition(5)


def test_replacing_by_version_then_arrival(df, rows):
    want = {}
    for row in rows:
        if row[0] not in want or (row[1], row[2]) > want[row[0]][1:3]:
            want[row[0]] = row
    assert {tuple(r) for r in ops.replacing_merge(df, ["key"], "ver", ["seq"]).collect()} == set(want.values())


def test_replacing_by_arrival_only(df, rows):
    last = {row[0]: row for row in rows}
    assert {tuple(r) for r in ops.replacing_merge(df, ["key"], order=["seq"]).collect()} == set(last.values())
    assert {tuple(r) for r in latest_per_key(df, ["key"], "seq").collect()} == set(last.values())
    with pytest.raises(ValueError):
        ops.replacing_merge(df, ["key"])


def test_collapsing(df, rows):
    want = set()
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        net = sum(r[3] for r in mine)
        if net > 0:
            want.add([r for r in mine if r[3] > 0][-1])
        elif net < 0:
            want.add([r for r in mine if r[3] < 0][0])
    assert {tuple(r) for r in ops.collapsing_merge(df, ["key"], "sign", ["seq"]).collect()} == want


def test_versioned_collapse(df, rows):
    want = {}
    for key, ver, _, sign in rows:
        want[key, ver] = want.get((key, ver), 0) + sign
    got = {(r["key"], r["ver"]): r["net"] for r in ops.versioned_collapse(df, ["key"], "ver", "sign").collect()}
    assert got == {k: n for k, n in want.items() if n}


def test_versioned_collapse_keeps_the_values_of_the_sign_left(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, "a"), (1, 1, -1, "a"), (1, 2, 1, "b"), (2, 1, -1, "c")], "id int, ver int, sign int, v string"
    )
    got = {tuple(r) for r in ops.versioned_collapse(df, ["id"], "ver", "sign", ["v"]).collect()}
    assert got == {(1, 2, 1, "b"), (2, 1, -1, "c")}


def test_summing_drops_only_all_zero_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.5), ("a", -1, -0.5), ("b", 1, 0.25), ("b", -1, 0.25), ("c", None, None)],
        "key string, n long, x double",
    )
    got = {r["key"]: (r["n"], float(r["x"]), r["n_rows"]) for r in ops.summing_merge(df, ["key"], ["n", "x"]).collect()}
    assert got == {"b": (0, 0.5, 2)}
    assert ops.summing_merge(df, ["key"], ["n", "x"], drop_zero=False).count() == 3


def test_sums_are_not_rounded_and_keep_their_types(spark):
    df = spark.createDataFrame(
        [("tiny", 1e-5, 1), ("huge", 1e36, 2), ("huge", 1e36, 3), ("mixed", 1.00004, -7), ("mixed", 1.00004, 7), ("gone", 2.5, 4), ("gone", -2.5, -4)],
        "key string, x double, n int",
    ).withColumn("d", F.col("n").cast("decimal(9,3)") / 1000).withColumn("d", F.col("d").cast("decimal(12,6)"))
    summed = ops.summing_merge(df, ["key"], ["x", "n", "d"])
    assert [f.dataType for f in summed.schema.fields[1:4]] == [f.dataType for f in df.schema.fields[1:4]]
    got = {r["key"]: (r["x"], r["n"]) for r in summed.collect()}
    assert got == {"tiny": (1e-5, 1), "huge": (2e36, 5), "mixed": (2.00008, 0)}
    with pytest.raises(Exception, match="(?i)overflow|out of"):
        big = spark.createDataFrame([(1, 2**62)] * 3, "k int, n long")
        ops.summing_merge(big, ["k"], ["n"]).collect()


def test_folds_aggregate_before_the_shuffle(df):
    """A hot key must shrink to one row per task before it moves."""

    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    replacing = plan(ops.replacing_merge(df, ["key"], "ver", ["seq"]))
    assert replacing.count("WindowGroupLimit") == 2
    for frame in (
        ops.collapsing_merge(df, ["key"], "sign", ["seq"]),
        ops.versioned_collapse(df, ["key"], "ver", "sign"),
        ops.summing_merge(df, ["key"], ["seq"]),
        latest_per_key(df, ["key"], "seq"),
    ):
        assert "partial_" in plan(frame)
