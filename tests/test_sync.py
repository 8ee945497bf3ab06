"""Snapshot and follow-up: nothing lost, nothing twice, whatever happens in between."""

import os
import random
from collections import Counter
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import plans, sources
from tidemark.types import TableSpec, TableState, Watermark

SCHEMA = "id long, updated_at timestamp_ntz, v string"
SPEC = TableSpec("t", sort_key=("id",))


def table(spark, rows):
    """``(id, day or None, v)`` rows."""
    df = spark.createDataFrame(rows, "id long, day int, v string")
    at = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(day)")
    return df.select("id", at.alias("updated_at"), "v")


def bag(df):
    return Counter(tuple(r) for r in df.select("id", "updated_at", "v").collect())


def paths(folder):
    return f"{folder}/t", f"{folder}/state"


def follow(spark, df, state, folder, batch_rows=1000):
    """Poll until nothing is new."""
    while True:
        after = plans.poll_table(spark, df, SPEC, state, *paths(folder), batch_rows=batch_rows)
        if after == state:
            return state
        state = after


def test_snapshot_then_polls_equal_the_source(spark, folder):
    first = [(i, i % 9, "a") for i in range(60)] + [(100 + i, None, "null") for i in range(5)]
    result = plans.snapshot_table(spark, table(spark, first), SPEC, *paths(folder))
    assert (result.status, result.n_rows) == ("ok", 65)
    more = first + [(200 + i, 9 + i % 4, "b") for i in range(40)]
    state = follow(spark, table(spark, more), sources.load_state(spark, paths(folder)[1])["t"], folder, 7)
    assert bag(sources.read_target(spark, paths(folder)[0])) == bag(table(spark, more))
    assert state.synced_rows == 105 and state.watermark_value == "2024-01-13 00:00:00"


def test_one_timestamp_for_everything(spark, folder):
    """The strict cut would lose nine of ten rows here."""
    df = table(spark, [(i, 0, "x") for i in range(100)])
    follow(spark, df, TableState("t"), folder, 10)
    assert sources.read_target(spark, paths(folder)[0]).count() == 100
    strict = ops.strict_batch(df, "updated_at", None, 10, "id")
    assert strict.count() == 10 and ops.newer_than(df, "updated_at", "2024-01-01").count() == 0


def test_rows_that_arrive_during_the_snapshot_come_with_the_first_delta(spark, folder):
    early = table(spark, [(i, i, "a") for i in range(10)])
    bound = ops.read_max(early, "updated_at")
    later = table(spark, [(i, i, "a") for i in range(15)])
    snapshot = plans.snapshot_rows(later, Watermark("datetime", "updated_at"), bound)
    assert snapshot.count() == 10
    state = plans.store(
        spark, snapshot, SPEC, TableState("t", 0, True, "updated_at", bound, 0), *paths(folder)
    )
    follow(spark, later, state, folder)
    assert bag(sources.read_target(spark, paths(folder)[0])) == bag(later)


def test_null_watermarks_are_in_the_snapshot_once(spark, folder):
    df = table(spark, [(1, None, "n"), (2, 3, "a")])
    whole = plans.snapshot_plus_delta(df, Watermark("datetime", "updated_at"), "2024-01-02")
    assert bag(whole) == bag(df)
    only_null = table(spark, [(1, None, "n")])
    plans.snapshot_table(spark, only_null, SPEC, *paths(folder))
    state = sources.load_state(spark, paths(folder)[1])["t"]
    assert state.watermark_value is None
    follow(spark, df, state, folder)
    assert bag(sources.read_target(spark, paths(folder)[0])) == bag(df)


def test_empty_table_then_rows(spark, folder):
    empty = table(spark, [(1, 0, "x")]).filter("false")
    assert plans.snapshot_table(spark, empty, SPEC, *paths(folder)).status == "ok"
    df = table(spark, [(1, 0, "x"), (2, -30, "y")])
    follow(spark, df, sources.load_state(spark, paths(folder)[1])["t"], folder)
    assert bag(sources.read_target(spark, paths(folder)[0])) == bag(df)


def test_negative_integers_move_the_watermark(spark, folder):
    df = spark.createDataFrame([(-5, "a"), (-3, "b"), (-9, "c")], "id long, v string")
    spec = TableSpec("t")
    state = plans.poll_table(spark, df, spec, TableState("t"), *paths(folder), batch_rows=2)
    assert state.watermark_value == "-5"
    state = plans.poll_table(spark, df, spec, state, *paths(folder), batch_rows=2)
    assert (state.watermark_value, state.synced_rows) == ("-3", 3)
    assert plans.poll_table(spark, df, spec, state, *paths(folder)) == state


def test_unsigned_64_bit_watermarks(spark, folder):
    df = spark.sql("SELECT cast(v AS decimal(20,0)) AS version FROM VALUES ('18446744073709551615'), ('1') AS t(v)")
    state = plans.catch_up(spark, df, TableSpec("t"), TableState("t"), *paths(folder))
    assert state.watermark_value == "18446744073709551615"


def test_a_crash_before_the_state_is_saved_loses_and_repeats_nothing(spark, folder):
    target, log = paths(folder)
    df = table(spark, [(i, i, "a") for i in range(30)])
    state = plans.poll_table(spark, df, SPEC, TableState("t"), target, log, batch_rows=10)
    rows, moved = plans.poll_once(df, SPEC, state, 10)
    sources.write_batch(rows, target, moved.batch_seq)  # stored, then the driver dies
    grown = table(spark, [(i, i, "a") for i in range(45)])
    restarted = sources.load_state(spark, log)["t"]
    assert restarted == state
    follow(spark, grown, restarted, folder, 25)
    assert bag(sources.read_target(spark, target)) == bag(grown)


def test_a_drain_that_dies_leaves_nothing_behind(spark, folder):
    """Its batches are stored, the state is not, and the next run cuts other batches."""
    target, log = paths(folder)
    df = table(spark, [(i, i // 3, "a") for i in range(60)])
    state = plans.catch_up(spark, df.filter("id < 12"), SPEC, TableState("t"), target, log)
    plans.drain(spark, df, SPEC, state, target, folder + "/lost", batch_rows=4)
    assert sources.read_target(spark, target, upto=state.batch_seq).count() == 12
    final = plans.drain(spark, df, SPEC, sources.load_state(spark, log)["t"], target, log, batch_rows=30)
    assert final.synced_rows == 60
    moved = df.withColumn("updated_at", F.expr("updated_at + INTERVAL 1 YEAR"))
    plans.drain(spark, moved, SPEC, final, target, folder + "/lost", batch_rows=4)
    plans.catch_up(spark, moved, SPEC, final, target, log)
    df = df.unionByName(moved)
    assert bag(sources.read_target(spark, target)) == bag(df)


def test_a_drained_batch_never_splits_equal_watermarks(spark, folder):
    df = table(spark, [(i, 4 if i % 3 else i, "a") for i in range(90)])
    spec = replace(SPEC, month_of="updated_at")
    plans.drain(spark, df, spec, TableState("t"), *paths(folder), batch_rows=10)
    stored = sources.read_target(spark, paths(folder)[0], keep_layout=True)
    per_value = stored.groupBy("updated_at").agg(F.count_distinct("tidemark_batch").alias("n"))
    assert per_value.filter("n > 1").count() == 0
    assert bag(stored) == bag(df)


def test_an_interrupted_copy_goes_on_where_it_stopped(spark, folder, monkeypatch):
    target, log = paths(folder)
    rows = [(i, i % 20, "a") for i in range(80)] + [(200 + i, None, "n") for i in range(3)]
    df, spec = table(spark, rows), replace(SPEC, parts=4)
    written, real = [], plans.snapshot.write_batch

    def dies_at_part_two(rows, path, seq, *layout):
        if seq == 2 and 2 not in written:
            written.append(2)
            real(rows.limit(1), path, seq, *layout)
            raise RuntimeError("driver lost")
        written.append(seq)
        return real(rows, path, seq, *layout)

    monkeypatch.setattr(plans.snapshot, "write_batch", dies_at_part_two)
    with pytest.raises(RuntimeError, match="driver lost"):
        plans.snapshot_in_parts(spark, df, spec, target, log)
    state = sources.load_state(spark, log)["t"]
    assert (state.initial_sync_complete, state.batch_seq) == (False, 1)
    grown = table(spark, rows + [(300 + i, 25, "b") for i in range(5)])
    result = plans.snapshot_in_parts(spark, grown, spec, target, log)
    assert (result.status, result.n_rows, written) == ("ok", 83, [0, 1, 2, 2, 3])
    state = sources.load_state(spark, log)["t"]
    assert state.initial_sync_complete and state.watermark_value == "2024-01-20 00:00:00"
    follow(spark, grown, state, folder)
    assert bag(sources.read_target(spark, target)) == bag(grown)


def test_parts_that_were_begun_are_finished_in_parts(spark, folder, monkeypatch):
    df, real = table(spark, [(i, i, "a") for i in range(30)]), plans.snapshot.write_batch

    def dies(rows, path, seq, *layout):
        if seq == 2:
            raise RuntimeError("driver lost")
        return real(rows, path, seq, *layout)

    monkeypatch.setattr(plans.snapshot, "write_batch", dies)
    assert plans.copy_tables(spark, lambda _: df, [replace(SPEC, parts=3)], folder)[0].status == "error"
    monkeypatch.setattr(plans.snapshot, "write_batch", real)
    assert plans.copy_tables(spark, lambda _: df, [SPEC], folder)[0].n_rows == 30
    assert bag(sources.read_target(spark, plans.target_path(folder, "t"))) == bag(df)


def test_count_mode_over_an_empty_copy_by_month(spark, folder):
    spec = TableSpec("t", month_of="day", watermark=Watermark("count"))
    df = spark.sql("SELECT date'2024-01-02' AS day, 'x' AS v")
    plans.snapshot_table(spark, df.filter("false"), spec, *paths(folder))
    state = sources.load_state(spark, paths(folder)[1])["t"]
    assert plans.poll_table(spark, df, spec, state, *paths(folder)).synced_rows == 1
    assert sources.read_target(spark, paths(folder)[0]).count() == 1


@pytest.mark.parametrize("rows", [[], [(1, None, "n")], [(1, 3, "a")] * 5])
def test_copy_in_parts_of_odd_tables(spark, folder, rows):
    df = table(spark, rows or [(0, 0, "")]).filter(F.lit(bool(rows)))
    result = plans.snapshot_in_parts(spark, df, replace(SPEC, parts=3), *paths(folder))
    assert (result.status, result.n_rows) == ("ok", len(rows))
    assert sources.load_state(spark, paths(folder)[1])["t"].initial_sync_complete
    grown = table(spark, rows + [(9, 9, "z")])
    follow(spark, grown, sources.load_state(spark, paths(folder)[1])["t"], folder)
    assert bag(sources.read_target(spark, paths(folder)[0])) == bag(grown)


def test_exact_copies_are_kept_as_often_as_they_are(spark, folder):
    df = table(spark, [(1, 2, "x")] * 7 + [(2, 1, "y")] * 3)
    follow(spark, df, TableState("t"), folder, 2)
    assert bag(sources.read_target(spark, paths(folder)[0])) == bag(df)


def test_drain_and_catch_up_store_the_same(spark, folder):
    rnd = random.Random(2)
    df = table(spark, [(i, rnd.choice([3] * 10 + list(range(40))), "a") for i in range(400)]).cache()
    drained = plans.drain(spark, df, SPEC, TableState("t"), *paths(folder + "/a"), batch_rows=50)
    caught = plans.catch_up(spark, df, SPEC, TableState("t"), *paths(folder + "/b"))
    assert drained.synced_rows == caught.synced_rows == 400
    assert drained.batch_seq > caught.batch_seq == 0
    assert bag(sources.read_target(spark, folder + "/a/t")) == bag(df)
    assert bag(sources.read_target(spark, folder + "/b/t")) == bag(df)
    logged = {r["batch_seq"]: r for r in sources.read_state_log(spark, folder + "/a/state").collect()}
    stored = sources.read_target(spark, folder + "/a/t", keep_layout=True)
    assert set(logged) == {r["tidemark_batch"] for r in stored.select("tidemark_batch").distinct().collect()}
    for seq, row in logged.items():
        assert row["synced_rows"] == sources.read_target(spark, folder + "/a/t", upto=seq).count()
        assert row["synced_rows"] == df.count() - ops.newer_than(df, "updated_at", row["watermark_value"]).count()
    assert plans.drain(spark, df, SPEC, drained, *paths(folder + "/a")) == drained
    assert plans.catch_up(spark, df, SPEC, caught, *paths(folder + "/b")) == caught


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    days=st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=40),
    split=st.integers(0, 40),
    batch_rows=st.integers(1, 15),
)
def test_snapshot_and_drain_is_the_source(spark, days, split, batch_rows):
    """Later rows get later days, as a growing table would."""
    from tidemark.session import scratch_path

    folder = scratch_path(spark, "property")
    rows = [(i, d if i < split or d is None else d + 6, "x") for i, d in enumerate(days)]
    rows = [(i, 0 if d is None and i >= split else d, v) for i, d, v in rows]
    first = [r for r in rows if r[0] < split]
    late = [(i, (d or 0) + 7, v) for i, d, v in rows if i >= split]
    if first:
        plans.snapshot_table(spark, table(spark, first), SPEC, *paths(folder))
    state = sources.load_state(spark, paths(folder)[1]).get("t", TableState("t"))
    df = table(spark, first + late)
    if not first and not late:
        return
    final = plans.drain(spark, df, SPEC, state, *paths(folder), batch_rows=batch_rows)
    if final.batch_seq >= 0:
        assert bag(sources.read_target(spark, paths(folder)[0])) == bag(df)


def test_a_changed_watermark_column_is_an_error(spark, folder):
    df = table(spark, [(1, 1, "x")])
    stale = TableState("t", 1, True, "id", "0", 0)
    with pytest.raises(ValueError, match="saved watermark"):
        plans.poll_table(spark, df, SPEC, stale, *paths(folder))


def test_excluded_columns_never_arrive(spark, folder):
    spec = replace(SPEC, excluded=("v",))
    df = table(spark, [(1, 1, "secret")])
    plans.snapshot_table(spark, df, spec, *paths(folder))
    assert sources.read_target(spark, paths(folder)[0]).columns == ["id", "updated_at"]
    with pytest.raises(ValueError, match="excluded"):
        plans.snapshot_table(
            spark, df, replace(spec, month_of="v"), folder + "/other", paths(folder)[1]
        )


def test_count_mode_by_content_and_by_position(spark, folder):
    spec = TableSpec("t", sort_key=("name",))

    def named(*names):
        return spark.createDataFrame([(n,) for n in names], "name string")

    plans.snapshot_table(spark, named("b", "c", "c"), spec, *paths(folder))
    state = sources.load_state(spark, paths(folder)[1])["t"]
    assert (state.watermark_column, state.synced_rows) == (None, 3)
    grown = named("a", "b", "c", "c", "d")
    assert plans.poll_table(spark, named("b", "c", "c"), spec, state, *paths(folder)) == state
    after = plans.poll_table(spark, grown, spec, state, *paths(folder))
    stored = Counter(r[0] for r in sources.read_target(spark, paths(folder)[0]).collect())
    assert stored == Counter("abccd") and after.synced_rows == 5
    last = plans.poll_table(spark, named(*"abccdz"), spec, after, *paths(folder), by_position=True)
    assert last.synced_rows == 6
    assert Counter(r[0] for r in sources.read_target(spark, paths(folder)[0]).collect()) == Counter("abccdz")


def test_updates_fold_and_deletes_show_up(spark, folder):
    df = table(spark, [(1, 0, "old"), (2, 0, "gone")])
    state = follow(spark, df, TableState("t"), folder)
    changed = table(spark, [(1, 5, "new")])
    follow(spark, changed, state, folder)
    stored = sources.read_target(spark, paths(folder)[0], keep_layout=True)
    latest = ops.replacing_merge(stored, ["id"], "updated_at", ["tidemark_batch"]).drop("tidemark_batch")
    assert {(r["id"], r["v"]) for r in latest.collect()} == {(1, "new"), (2, "gone")}
    assert [r["id"] for r in ops.surplus_rows(changed, latest).collect()] == [2]
    n = plans.fold_target(
        spark,
        SPEC,
        paths(folder)[0],
        folder + "/folded",
        upto=1,
        fold=lambda rows: ops.replacing_merge(rows, ["id"], "updated_at", ["tidemark_batch"]),
    )
    assert n == 2 and bag(sources.read_target(spark, folder + "/folded")) == bag(latest)


def test_a_source_by_month_is_pruned(spark, folder):
    source = f"{folder}/source"
    rows = [(i, i * 3, "a") for i in range(60)]
    sources.write_batch(table(spark, rows), source, 0, "updated_at")
    df = sources.read_target(spark, source, keep_layout=True).drop("tidemark_batch")
    spec = replace(SPEC, month_column="tidemark_month")
    bounded = ops.in_range(df, "updated_at", "2024-03-10", "2024-04-05", "tidemark_month")
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert ">= 202403" in plan.split("PartitionFilters")[1] and "<= 202404" in plan.split("PartitionFilters")[1]
    plans.snapshot_table(spark, df.filter("id < 20"), spec, *paths(folder))
    state = sources.load_state(spark, paths(folder)[1])["t"]
    state = plans.poll_table(spark, df, spec, state, *paths(folder), batch_rows=7)
    state = plans.drain(spark, df.filter("id < 50"), spec, state, *paths(folder), batch_rows=10)
    plans.catch_up(spark, df, spec, state, *paths(folder))
    assert bag(sources.read_target(spark, paths(folder)[0])) == bag(table(spark, rows))
    assert sources.read_target(spark, paths(folder)[0], keep_layout=True).columns == [
        "id", "updated_at", "v", "tidemark_batch"
    ]


def test_late_rows_are_found_by_key(spark):
    source = table(spark, [(i, i, "a") for i in range(10)] + [(99, 7, "late"), (98, 1, "too late")])
    target = table(spark, [(i, i, "a") for i in range(10)])
    found = plans.late_rows(source, target, "updated_at", ["id"], "5 DAYS", "2024-01-10")
    assert [r["id"] for r in found.collect()] == [99]


def test_many_tables_one_of_them_broken(spark, folder):
    tables = {name: table(spark, [(i, i, name) for i in range(n)]) for name, n in (("a", 5), ("b", 8))}

    def read(name):
        if name == "bad":
            raise RuntimeError("no such table")
        return tables[name]

    specs = [TableSpec(n) for n in ("a", "bad", "b")]
    results = plans.copy_tables(spark, read, specs, folder)
    assert [(r.table, r.status, r.n_rows) for r in results] == [("a", "ok", 5), ("bad", "error", 0), ("b", "ok", 8)]
    assert "no such table" in results[1].error
    again = plans.copy_tables(spark, read, specs, folder)
    assert [r.status for r in again] == ["skipped", "error", "skipped"]
    tables["a"] = table(spark, [(i, i, "a") for i in range(9)])
    polled = plans.poll_cycle(spark, read, specs, folder)
    assert [(r.status, r.n_rows) for r in polled] == [("ok", 4), ("skipped", 0), ("ok", 0)]
    tables["b"] = table(spark, [(i, i, "b") for i in range(20)])
    final = plans.sync_tables(spark, read, specs, folder, batch_rows=5)
    assert [(r.status, r.n_rows) for r in final] == [("skipped", 0), ("error", 0), ("ok", 12)]
    stored = sources.read_target(spark, plans.target_path(folder, "a"))
    assert ops.reconcile_counts({"a": (tables["a"], stored)}).first()["status"] == "match"


def test_a_table_that_does_not_fit_its_target_fails_alone(spark, folder):
    spark.range(1).write.parquet(f"{folder}/a/tidemark_batch=0")
    results = plans.copy_tables(
        spark, lambda name: table(spark, [(1, 1, "x")]), [TableSpec("a"), TableSpec("b")], folder
    )
    assert [r.status for r in results] == ["error", "ok"]
    assert "differ in columns" in results[0].error


def test_resume_after_compaction_and_a_broken_plan(spark, folder):
    """Dies in the third part, the log is compacted, and the plan of another table is only half written."""
    rows = table(spark, [(i, i, "a") for i in range(40)])
    specs = [replace(SPEC, name="a", parts=4), replace(SPEC, name="b", parts=4)]
    log = plans.state_path(folder)

    def dies(part):
        if part == 2:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        plans.snapshot_in_parts(spark, rows, specs[0], plans.target_path(folder, "a"), log, before_part=dies)
    os.makedirs(f"{log}_plans/b")
    results = plans.sync_tables(spark, lambda _: rows, specs, folder)
    assert [(r.status, r.n_rows) for r in results] == [("ok", 40), ("ok", 40)]
    state = sources.load_state(spark, log)
    assert {s.synced_rows for s in state.values()} == {40} and all(s.initial_sync_complete for s in state.values())
    assert bag(sources.read_target(spark, plans.target_path(folder, "a"))) == bag(rows)


def test_a_changed_source_is_an_error_of_its_table_alone(spark, folder):
    tables = {"a": table(spark, [(i, i, "a") for i in range(5)]), "b": table(spark, [(i, i, "b") for i in range(5)])}
    specs = [replace(SPEC, name=n) for n in tables]
    plans.copy_tables(spark, tables.get, specs, folder)
    longer = {n: table(spark, [(i, i, n) for i in range(9)]) for n in tables}
    for changed in (longer["a"].withColumn("more", F.lit(1)), longer["a"].withColumn("v", F.lit(1)), longer["a"].withColumn("tidemark_batch", F.lit(1))):
        results = plans.sync_tables(spark, ({"a": changed, "b": longer["b"]}).get, specs, folder)
        assert [r.status for r in results][0] == "error"
        assert sources.read_target(spark, plans.target_path(folder, "a")).count() == 5
        assert sources.read_target(spark, plans.target_path(folder, "b")).count() == 9


def test_late_rows_come_with_a_poll(spark, folder):
    target, log = paths(folder)
    all_rows = table(spark, [(i, i, "a") for i in range(30)])
    plans.snapshot_table(spark, all_rows.filter("id % 5 <> 2"), SPEC, target, log)
    state = sources.load_state(spark, log)["t"]
    state = plans.add_late_rows(spark, all_rows, SPEC, state, target, log, ["id"], "1000 days")
    assert bag(sources.read_target(spark, target)) == bag(all_rows)
    again = plans.add_late_rows(spark, all_rows, SPEC, state, target, log, ["id"], "1000 days")
    assert again == state == sources.load_state(spark, log)["t"]


def test_only_recorded_batches_are_read(spark, folder):
    rows = table(spark, [(i, i, "a") for i in range(10)])
    plans.copy_tables(spark, lambda _: rows, [SPEC], folder)
    sources.write_batch(rows, plans.target_path(folder, "t"), 1)  # never recorded
    assert plans.read_synced(spark, folder, "t").count() == 10
    assert plans.read_synced(spark, folder, "t").columns == rows.columns


def test_poll_cycles_keep_the_log_short(spark, folder, monkeypatch):
    monkeypatch.setattr("tidemark.plans.replicate.LOG_FILES", 3)
    plans.copy_tables(spark, lambda _: table(spark, [(0, 0, "a")]), [SPEC], folder)
    for n in range(1, 8):
        plans.poll_cycle(spark, lambda _: table(spark, [(i, i, "a") for i in range(n + 1)]), [SPEC], folder)
    assert len(sources.read_state_log(spark, plans.state_path(folder)).inputFiles()) <= 5
    assert plans.read_synced(spark, folder, "t").count() == 8
