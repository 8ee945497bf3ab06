"""Differences of tables: by a sketch of sums, and as a change feed that is applied."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import plans, sources
from tidemark.operators import sketch
from tidemark.types import TableSpec

SCHEMA = "k long, v string, tags map<string,int>, xs array<double>"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain(value):
    return tuple(sorted(value.items())) if isinstance(value, dict) else tuple(value) if isinstance(value, list) else value


def bag(df):
    return Counter(tuple(plain(v) for v in r) for r in df.collect())


def drawn(draw, n):
    return [(draw.choice([None, *range(40)]), draw.choice([None, "", "a", "b"]), draw.choice([None, {}, {"x": 1, "y": 2}]), draw.choice([None, [], [0.5, None]])) for _ in range(n)]


# --- sketch -------------------------------------------------------------------


def test_hash_of_a_long_is_the_engines(spark):
    longs = [0, 1, -1, 2**63 - 1, -(2**63), 123456789, -987654321012345]
    ours = sketch._hash_of_hash(np.array(longs, np.int64).view(np.uint64)).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in longs], "x long").select(F.xxhash64("x"))
    assert ours == [r[0] for r in df.collect()]


@pytest.mark.parametrize("cells", [2, 64])
def test_sketch_is_the_multiset_difference(spark, cells):
    """Repeated rows, NULLs and maps; a sketch of two cells has to grow."""
    draw = random.Random(cells)
    for _ in range(2):
        common = drawn(draw, 80) * 2
        source, target = common + drawn(draw, 30), common + drawn(draw, 30)
        src, dst = table(spark, source).repartition(3), table(spark, target)
        want = bag(src) - bag(dst)
        assert bag(ops.missing_by_sketch(src, dst, cells=cells)) == want
        assert bag(ops.surplus_by_sketch(src, dst, cells=cells)) == bag(dst) - bag(src)


def test_counts_of_hashes(spark):
    rows = [(1, "a", None, None)] * 7 + [(2, "b", None, None)]
    other = [(1, "a", None, None)] * 2 + [(3, "c", None, None)] * 4
    net = ops.uneven_hashes(table(spark, rows), table(spark, other))
    assert sorted(r["net"] for r in net.collect()) == [-4, 1, 5]
    assert ops.uneven_hashes(table(spark, rows), table(spark, rows)).count() == 0


def test_too_large_a_difference_goes_the_exact_way(spark):
    src, dst = spark.range(5000), spark.range(4000, 4100)
    assert ops.uneven_hashes(src, dst, cells=8, max_cells=64) is None
    missing = ops.missing_by_sketch(src, dst, cells=8, max_cells=64)
    assert missing.count() == 4900 and missing.filter("id BETWEEN 4000 AND 4099").count() == 0


def test_sizes_grow_to_what_counts_show(spark, monkeypatch):
    """Not one scan per doubling where counts already tell how many rows differ."""
    sizes, plain_sketch = [], sketch.difference_sketch
    monkeypatch.setattr(sketch, "difference_sketch", lambda s, t, cells: (sizes.append(cells), plain_sketch(s, t, cells))[1])
    assert ops.uneven_hashes(spark.range(20_000), spark.range(100), cells=16).count() == 19_900
    assert sizes == [16, 16384]


def test_sketch_moves_no_rows(spark):
    """What is exchanged are cells, after partial sums."""
    df = spark.range(100_000).withColumn("v", F.repeat(F.lit("x"), 200))
    plan = ops.difference_sketch(df, df, 64)._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange", 1)
    assert "hashpartitioning(cell" in after.split("\n")[0] and "partial_sum" in after and "sum(" in before


# --- change feed ----------------------------------------------------------------


def changes_of(df):
    return {r["k"]: (r["op"], r["before"] and r["before"]["v"], r["after"] and r["after"]["v"]) for r in df.collect()}


def test_every_kind_of_change(spark):
    old = [(1, "same", {"a": 1, "b": 2}, [1.0]), (2, "old", None, None), (3, "gone", {}, []), (None, "null key", None, None), (5, None, None, None), (6, "x", {"a": 1}, None)]
    new = [(1, "same", {"b": 2, "a": 1}, [1.0]), (2, "new", None, None), (4, "came", None, None), (None, "changed", None, None), (5, None, None, None), (6, "x", {"a": 2}, None)]
    found = changes_of(ops.snapshot_changes(table(spark, old), table(spark, new).select("xs", "tags", "k", "v"), ["k"]))
    assert found == {2: ("update", "old", "new"), 3: ("delete", "gone", None), 4: ("insert", None, "came"),
                     None: ("update", "null key", "changed"), 6: ("update", "x", "x")}


def test_a_key_that_stands_twice_is_an_error(spark):
    one, two = table(spark, [(1, "a", None, None)]), table(spark, [(1, "a", None, None)] * 2)
    for old, new in ((one, two), (two, one), (two, two)):
        with pytest.raises(PySparkException, match="not unique"):
            ops.snapshot_changes(old, new, ["k"]).collect()


def test_one_shuffle(spark):
    old, new = spark.range(1000).withColumn("v", F.lit(1)), spark.range(500, 1500).withColumn("v", F.lit(2))
    plan = ops.snapshot_changes(old, new, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def unique(rows):
    return list({r[0]: r for r in rows}.values())


def test_mirror_follows_random_states(spark, folder):
    """After every state the fold equals the source; the feed of each batch is the difference."""
    draw = random.Random(9)
    spec = TableSpec("t", mirror_key=("k",))
    target, log = plans.target_path(folder, "t"), plans.state_path(folder)
    seen = [Counter()]
    for step in range(5):
        rows = [] if step == 3 else unique(drawn(draw, 50))
        result = plans.sync_tables(spark, lambda _: table(spark, rows), [spec], folder)[0]  # noqa: B023
        assert result.error is None, result.error
        seen.append(bag(table(spark, rows)))
        assert bag(plans.read_mirrored(spark, folder, spec)) == seen[-1]
        seq = sources.load_state(spark, log)["t"].batch_seq
        feed = plans.read_changes(spark, target, seq - 1, seq)
        came, went = (bag(feed.filter(f"tidemark_sign = {s}").drop("tidemark_sign", "tidemark_batch")) for s in (1, -1))
        assert came - went == seen[-1] - seen[-2] and went - came == seen[-2] - seen[-1]
    last = sources.load_state(spark, log)["t"]
    plans.sync_tables(spark, lambda _: table(spark, rows), [spec], folder)
    assert sources.load_state(spark, log)["t"] == last


def test_a_crash_before_the_state_is_replayed(spark, folder):
    spec = TableSpec("t", mirror_key=("k",))
    target, log = plans.target_path(folder, "t"), plans.state_path(folder)
    first = [(i, "a", None, None) for i in range(20)]
    plans.sync_tables(spark, lambda _: table(spark, first), [spec], folder)
    state = sources.load_state(spark, log)["t"]
    plans.mirror_table(spark, table(spark, first[:5]), spec, state, target, f"{log}_lost")  # stored, never recorded
    now = [(i, "b", None, None) for i in range(10, 30)]
    plans.sync_tables(spark, lambda _: table(spark, now), [spec], folder)
    assert bag(plans.read_mirrored(spark, folder, spec)) == bag(table(spark, now))


def test_refused_mirrors(spark, folder):
    df = table(spark, [(1, "a", None, None)])
    for spec, source in (
        (TableSpec("t", mirror_key=("nope",)), df),
        (TableSpec("t", mirror_key=("k",), excluded=("k",)), df),
        (TableSpec("t", mirror_key=("k",)), df.withColumn("Tidemark_Sign", F.lit(1))),
        (TableSpec("t", mirror_key=("k",)), df.withColumn("tidemark_batch", F.lit(1))),
    ):
        assert plans.sync_tables(spark, lambda _: source, [spec], folder)[0].status == "error"  # noqa: B023
    plans.sync_tables(spark, lambda _: df, [TableSpec("t")], folder)
    assert plans.sync_tables(spark, lambda _: df, [TableSpec("t", mirror_key=("k",))], folder)[0].status == "error"  # its rows have no signs
