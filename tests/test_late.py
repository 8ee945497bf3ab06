"""Rows below the watermark: digests find them, and only ranges that differ are read."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import plans, sources
from tidemark.operators import digests
from tidemark.types import TableSpec

SPEC = TableSpec("t", late_ranges="month")


def table(spark, rows):
    """``(id, day or None, v)`` rows."""
    df = spark.createDataFrame(rows, "id long, day int, v string")
    at = F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(day)")
    return df.select("id", at.alias("updated_at"), "v")


def bag(df):
    return Counter(tuple(r) for r in df.select("id", "updated_at", "v").collect())


def sync(spark, df, folder, spec=SPEC, **options):
    result = plans.sync_tables(spark, lambda _: df, [spec], folder, **options)[0]
    assert result.error is None, result.error
    return result


def state(spark, folder):
    return sources.load_state(spark, plans.state_path(folder))["t"]


def test_any_age_through_sync_alone(spark, folder):
    draw = random.Random(5)
    rows = [(i, draw.randint(0, 1500), "a") for i in range(400)]
    visible = rows[:150]
    sync(spark, table(spark, visible), folder)
    for upto in (220, 300, 400):
        visible = rows[:upto] + [(1000 + upto, None, "no watermark"), (7, 7, "twice"), (7, 7, "twice")]
        sync(spark, table(spark, visible), folder, batch_rows=40)
        held = bag(plans.read_synced(spark, folder, "t"))
        assert all(held[row] >= n for row, n in bag(table(spark, visible)).items())
    later = {(1000 + upto, None, "no watermark") for upto in (220, 300)}
    assert sum(held.values()) == len(visible) + len(later)  # what left the source since stays in the target
    before = state(spark, folder)
    assert sync(spark, table(spark, visible), folder).n_rows == 0
    assert state(spark, folder) == before


@pytest.mark.parametrize("spec", [TableSpec("t", late_ranges=10), TableSpec("t", late_ranges=1000, parts=3)])
def test_integer_watermarks(spark, folder, spec):
    whole = spark.range(-50, 200).withColumn("v", F.col("id") % 3)
    sync(spark, whole.filter("id % 7 <> 0 AND id < 150"), folder, spec)
    sync(spark, whole, folder, spec)
    assert Counter(map(tuple, plans.read_synced(spark, folder, "t").collect())) == Counter(map(tuple, whole.collect()))


def test_a_target_that_kept_no_digests_before(spark, folder):
    rows = [(i, i, "a") for i in range(90)]
    sync(spark, table(spark, rows[::2]), folder, TableSpec("t"))
    sync(spark, table(spark, rows), folder)
    assert bag(plans.read_synced(spark, folder, "t")) == bag(table(spark, rows))


def test_changes_in_place_and_deletes_settle(spark, folder):
    """A changed old row is stored once more, a deleted one is noted; neither is looked at again."""
    rows = [(i, i * 10, "a") for i in range(60)]
    sync(spark, table(spark, rows), folder)
    now = [(5, 50, "changed") if r[0] == 5 else r for r in rows if r[0] != 9]
    assert sync(spark, table(spark, now), folder).n_rows == 1
    held = bag(plans.read_synced(spark, folder, "t"))
    assert held == bag(table(spark, rows)) + bag(table(spark, [(5, 50, "changed")]))
    target, log = plans.target_path(folder, "t"), plans.state_path(folder)
    assert plans.uneven_ranges_of(spark, table(spark, now), SPEC, state(spark, folder), target, log).isEmpty()


def test_a_crash_before_the_state_repeats_nothing(spark, folder, monkeypatch):
    rows = [(i, i, "a") for i in range(80)]
    sync(spark, table(spark, rows[::2]), folder)
    for module in ("tidemark.plans.incremental.append_state", "tidemark.plans.incremental.append_state_rows"):
        monkeypatch.setattr(module, lambda *_: (_ for _ in ()).throw(OSError("died")))
    more = rows + [(i, i, "b") for i in range(80, 130)]
    died = plans.sync_tables(spark, lambda _: table(spark, more), [SPEC], folder, batch_rows=9)[0]
    assert died.status == "error"
    monkeypatch.undo()
    sync(spark, table(spark, more), folder, batch_rows=30)
    assert bag(plans.read_synced(spark, folder, "t")) == bag(table(spark, more))
    target, log = plans.target_path(folder, "t"), plans.state_path(folder)
    assert plans.uneven_ranges_of(spark, table(spark, more), SPEC, state(spark, folder), target, log).isEmpty()


def scan_metrics(df):
    """Files and rows the scan of a plan without shuffles read."""
    df._jdf.queryExecution().toRdd().count()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    metric = leaf.metrics()
    return metric.apply("numFiles").value(), metric.apply("numOutputRows").value()


def test_equal_ranges_are_not_read(spark, folder):
    """Of a source by month, only the months that differ are opened."""
    df = table(spark, [(i, i, "a") for i in range(1200)])
    source = f"{folder}_source"
    sources.write_batch(df, source, 0, "updated_at", ["updated_at"])
    whole = spark.read.parquet(source).drop("tidemark_batch").withColumnRenamed("tidemark_month", "month")
    spec = TableSpec("t", late_ranges="month", month_column="month", month_of="updated_at")
    plans.snapshot_table(spark, whole.filter("id NOT IN (33, 34, 900)"), spec, plans.target_path(folder, "t"), plans.state_path(folder))
    at = state(spark, folder)
    uneven = plans.uneven_ranges_of(spark, whole, spec, at, plans.target_path(folder, "t"), plans.state_path(folder))
    found = {r["range"]: r["n_rows"] for r in uneven.collect()}
    assert found == {"2020-02-01T00": 2, "2022-06-01T00": 1}
    rows = ops.rows_of_ranges(plans.snapshot_rows(whole, plans.table_watermark(whole, spec), at.watermark_value), "updated_at", uneven, "month", "month")
    files, read = scan_metrics(rows)
    assert files == 2 and read == 29 + 30
    late = plans.late_in_ranges(spark, whole, spec, at, plans.target_path(folder, "t"), uneven)
    assert sorted(r["id"] for r in late.collect()) == [33, 34, 900]


def test_many_ranges_are_joined(spark, folder, monkeypatch):
    monkeypatch.setattr(digests, "MAX_RANGE_FILTERS", 3)
    rows = [(i, i * 5 if i % 11 else None, "a") for i in range(300)]
    sync(spark, table(spark, rows[::2]), folder)
    sync(spark, table(spark, rows), folder)
    assert bag(plans.read_synced(spark, folder, "t")) == bag(table(spark, rows))


def test_digests_merge_and_differ(spark):
    """Parts of a table add up to its digests whatever the split; each kind of change shows."""
    df = table(spark, [(i, i % 200 if i % 9 else None, str(i % 4)) for i in range(500)])
    whole = ops.range_digests(df, "updated_at", "month")
    parts = [ops.range_digests(df.filter(F.col("id") % 3 == k), "updated_at", "month") for k in range(3)]
    assert ops.uneven_digests(whole, parts[0].unionByName(parts[1]).unionByName(parts[2])).isEmpty()
    for change in (F.when(F.col("id") != 7, F.col("v")), F.when(F.col("id") == 8, F.lit("9")).otherwise(F.col("v"))):
        other = ops.range_digests(df.withColumn("v", change), "updated_at", "month")
        assert [r["n_rows"] for r in ops.uneven_digests(other, whole).collect()] == [0]
    pair = table(spark, [(1, 1, "x"), (1, 1, "x")])  # the exclusive or of a pair is nothing
    assert ops.uneven_digests(ops.range_digests(pair, "updated_at", "day"), whole.filter("false")).count() == 1


def test_units_fit_their_column(spark):
    df = table(spark, [(1, 1, "x")])
    with pytest.raises(ValueError, match="calendar unit"):
        ops.range_digests(df, "updated_at", 10)
    with pytest.raises(ValueError, match="width"):
        ops.range_digests(df, "id", "month")
