"""

Every query reads the given tables whole. Queries that write (drains, copies,
streams) use new folders below ``spark.checkpoint.dir`` and return what they
stored.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import operators as ops  # noqa: E402
from tidemark import plans, sources, streaming  # noqa: E402
from tidemark.functions import count_redactions, month_number, redact_columns, split_url  # noqa: E402
from tidemark.session import scratch_path  # noqa: E402
from tidemark.types import TableSpec, TableState, Watermark  # noqa: E402

# The subpackage of training-data operators and its pipeline can be taken away whole.
llm = corpus_pipeline = None
try:
    from tidemark.llm import queries as llm  # noqa: E402

    import corpus_pipeline  # noqa: E402
except ImportError:  # without them, or without what they need, the other queries stand alone
    pass

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

LINE_ITEMS = TableSpec("lineitem", sort_key=("l_orderkey", "l_linenumber"))
FULL_POLLS = 12
STREAM_FILES = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entry(spark: SparkSession) -> DataFrame:
    """Snapshot of line items up to a past bound, then the rest drained, then reconciled."""
    sf_dir = "/root/testdata/sf0.001"
    lines = table(spark, sf_dir, "lineitem")
    stored = _snapshot_and_drain(spark, lines, "1999-01-01")
    return ops.reconcile_counts({"lineitem": (lines, stored)})


def _snapshot_and_drain(spark: SparkSession, lines: DataFrame, upto: str) -> DataFrame:
    target, log = scratch_path(spark, "lineitem"), scratch_path(spark, "state")
    first = plans.snapshot_rows(lines, Watermark("datetime", "l_shipdate"), upto)
    saved = TableState("lineitem", 0, True, "l_shipdate", upto, 0)
    saved = plans.store(spark, first, LINE_ITEMS, saved, target, log)
    plans.drain(spark, lines, LINE_ITEMS, saved, target, log, _share_of(lines, FULL_POLLS))
    return sources.read_target(spark, target)


def _share_of(df: DataFrame, polls: int) -> int:
    return -(-df.count() // polls)


# --- deltas -----------------------------------------------------------------


def delta_strict_ts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return ops.strict_batch(events, ops.choose(events.schema).column, "2024-01-15", 1000)


def delta_strict_int(spark, sf_dir):
    return ops.strict_batch(table(spark, sf_dir, "customer"), "c_custkey", 500, 300)


def delta_with_ties(spark, sf_dir):
    return ops.tie_safe_batch(table(spark, sf_dir, "orders"), "o_orderdate", "1998-01-01", 1000)


def delta_with_ties_by_range(spark, sf_dir):
    """The same batch found from key positions, the way of limits beyond one task."""
    orders = table(spark, sf_dir, "orders")
    return ops.tie_safe_batch(orders, "o_orderdate", "1998-01-01", 1000, max_gather=0)


def delta_range(spark, sf_dir):
    return ops.in_range(table(spark, sf_dir, "lineitem"), "l_shipdate", "1998-01-01", "1998-06-30")


def delta_batch_stats(spark, sf_dir):
    return ops.batch_stats(delta_strict_ts(spark, sf_dir), "ts", "2024-01-15")


# --- watermarks ---------------------------------------------------------------


def _chosen(spark, sf_dir) -> dict[str, tuple[DataFrame, str]]:
    frames = {name: table(spark, sf_dir, name) for name in TABLES}
    picked = {name: ops.choose(df.schema).column for name, df in frames.items()}
    return {name: (frames[name], column) for name, column in picked.items() if column}


def max_watermarks(spark, sf_dir):
    return ops.max_watermarks(_chosen(spark, sf_dir)).withColumnRenamed("table", "table_name")


def watermark_choice(spark, sf_dir):
    """The choice for every table, with the row counts it stands for."""
    frames = {name: table(spark, sf_dir, name) for name in TABLES}
    catalog = ops.column_catalog(spark, {name: df.schema for name, df in frames.items()})
    chosen = ops.choose_from_catalog(catalog)
    return (
        chosen.join(ops.row_counts(frames), "table")
        .withColumnRenamed("table", "table_name")
        .withColumnRenamed("column", "column_name")
    )


def watermark_profile(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    profile = ops.watermark_profile(lines, ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey"])
    return profile.withColumnRenamed("column", "column_name")


# --- snapshots ----------------------------------------------------------------


def snapshot_exclude_columns(spark, sf_dir):
    excluded = ops.parse_exclusions(["orders.o_totalprice"])
    return ops.project(table(spark, sf_dir, "orders"), excluded["orders"])


def table_selection_counts(spark, sf_dir):
    names = ops.select_tables(TABLES, include=["orders", "customer", "part"], exclude=["part"])
    counts = ops.row_counts({name: table(spark, sf_dir, name) for name in names})
    return counts.withColumnRenamed("table", "table_name")


def snapshot_plus_delta(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return plans.snapshot_plus_delta(lines, Watermark("datetime", "l_shipdate"), "1999-01-01")


def incremental_drain(spark, sf_dir):
    """All line items drained from nothing in a dozen tie-safe polls."""
    lines = table(spark, sf_dir, "lineitem")
    target, log = scratch_path(spark, "drain"), scratch_path(spark, "state")
    plans.drain(
        spark, lines, LINE_ITEMS, TableState("lineitem"), target, log, _share_of(lines, FULL_POLLS)
    )
    return sources.read_target(spark, target)


def catch_up(spark, sf_dir):
    """The same backlog as one bounded range."""
    lines = table(spark, sf_dir, "lineitem")
    target, log = scratch_path(spark, "catch_up"), scratch_path(spark, "state")
    plans.catch_up(spark, lines, LINE_ITEMS, TableState("lineitem"), target, log)
    return sources.read_target(spark, target)


def snapshot_in_parts(spark, sf_dir):
    """A resumable first copy of line items in four watermark ranges."""
    root = scratch_path(spark, "parts")
    spec = TableSpec("lineitem", sort_key=LINE_ITEMS.sort_key, month_of="l_shipdate", parts=4)
    results = plans.copy_tables(spark, sources.file_reader(spark, sf_dir, suffix=".parquet"), [spec], root)
    if results[0].status != "ok":
        raise RuntimeError(f"the copy failed: {results}")
    return sources.read_target(spark, plans.target_path(root, "lineitem"))


def snapshot_then_drain(spark, sf_dir):
    return _snapshot_and_drain(spark, table(spark, sf_dir, "lineitem"), "1999-01-01")


def sync_all_tables(spark, sf_dir):
    """Every table copied and polled until quiet, then compared with its source."""
    root = scratch_path(spark, "sync")
    dated = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    specs = [TableSpec(name, month_of=dated.get(name)) for name in ops.select_tables(TABLES)]
    read = sources.file_reader(spark, sf_dir, suffix=".parquet")

    failed = [r for r in plans.sync_tables(spark, read, specs, root) if r.status != "ok"]
    if failed:
        raise RuntimeError(f"tables failed: {failed}")
    stored = {s.name: sources.read_target(spark, plans.target_path(root, s.name)) for s in specs}
    pairs = {name: (read(name), df) for name, df in stored.items()}
    return ops.reconcile_counts(pairs).withColumnRenamed("table", "table_name")


# --- order and batches ----------------------------------------------------------


def page_ordered(spark, sf_dir):
    return ops.page(table(spark, sf_dir, "orders"), ["o_orderkey"], offset=3000, limit=1000)


def page_by_range(spark, sf_dir):
    """The same kind of page cut out by its keys, the way of deep offsets."""
    return ops.page(table(spark, sf_dir, "orders"), ["o_orderkey"], offset=3000, limit=1000, max_gather=0)


def batch_ledger(spark, sf_dir):
    return ops.batch_ledger(table(spark, sf_dir, "orders"), ["o_orderkey"], 1000)


def batch_ledger_tied(spark, sf_dir):
    """Batches over a key with many equal values."""
    return ops.batch_ledger(table(spark, sf_dir, "lineitem"), ["l_suppkey"], 1000)


def tie_safe_batches(spark, sf_dir):
    return ops.tie_safe_batches(table(spark, sf_dir, "lineitem"), "l_shipdate", 1000)


# --- reconciliation ---------------------------------------------------------------


def _orders_and_short_target(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders, and a target whose pending orders were never copied."""
    orders = table(spark, sf_dir, "orders")
    return orders, orders.filter(F.col("o_orderstatus") != "P")


def tail_by_count(spark, sf_dir):
    return ops.tail_by_count(*_orders_and_short_target(spark, sf_dir), ["o_orderkey"])


def tail_by_count_by_range(spark, sf_dir):
    return ops.tail_by_count(*_orders_and_short_target(spark, sf_dir), ["o_orderkey"], max_gather=0)


def missing_rows(spark, sf_dir):
    return ops.missing_rows(*_orders_and_short_target(spark, sf_dir))


def missing_rows_by_digest(spark, sf_dir):
    return ops.missing_rows(*_orders_and_short_target(spark, sf_dir), by_digest=True)


def _doubled_and_gapped(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders of which some stand twice, and a target that lacks a few."""
    orders = table(spark, sf_dir, "orders")
    return orders.unionByName(orders.filter("o_orderkey % 97 = 0")), orders.filter("o_orderkey % 50 <> 7")


def missing_by_sketch(spark, sf_dir):
    return ops.missing_by_sketch(*_doubled_and_gapped(spark, sf_dir))


def surplus_rows(spark, sf_dir):
    orders, short = _orders_and_short_target(spark, sf_dir)
    return ops.surplus_rows(short, orders)


def reconcile_counts(spark, sf_dir):
    orders, short = _orders_and_short_target(spark, sf_dir)
    customer = table(spark, sf_dir, "customer")
    events = table(spark, sf_dir, "events")
    pairs = {
        "orders": (orders, short),
        "customer": (customer, customer),
        "events": (events.filter(F.col("event_type") != "error"), events),
    }
    return ops.reconcile_counts(pairs).withColumnRenamed("table", "table_name")


def uneven_ranges(spark, sf_dir):
    return ops.uneven_ranges(*_orders_and_short_target(spark, sf_dir), "o_orderkey", 100)


def contiguous_frontier(spark, sf_dir):
    """Per order the first line not delivered, where returned lines were not."""
    lines = table(spark, sf_dir, "lineitem")
    delivered = F.col("l_returnflag") != "R"
    return ops.contiguous_frontier(lines, "l_orderkey", "l_linenumber", 1, 1, delivered)


def _shipped_parts(lines: DataFrame) -> list[DataFrame]:
    """All lines in three parts, the latest first."""
    year = F.coalesce(F.year("l_shipdate"), F.lit(0))
    return [lines.filter(year >= 1997), lines.filter(year < 1995), lines.filter((year >= 1995) & (year < 1997))]


def _orders_done(spark, sf_dir) -> DataFrame:
    """Orders with a line of each return flag, recorded part by part, one part twice, compacted between."""
    path, key = scratch_path(spark, "progress"), "l_returnflag"
    for n, part in enumerate(_shipped_parts(table(spark, sf_dir, "lineitem"))):
        done = ops.done_intervals(part, key, "l_orderkey", 1)
        sources.record_intervals(done, path, n)
        if n == 1:
            sources.compact_intervals(spark, path, key, 1)
            sources.record_intervals(done, path, n)
    return sources.read_intervals(spark, path, key, 1)


def interval_progress(spark, sf_dir):
    """Stretches of successive orders that have a line of the flag."""
    return ops.whole_intervals(_orders_done(spark, sf_dir), "l_returnflag", 1)


def interval_gaps(spark, sf_dir):
    """Stretches of orders between them that have none."""
    return ops.interval_gaps(_orders_done(spark, sf_dir), "l_returnflag", 1)


def interval_frontier(spark, sf_dir):
    """The contiguous frontier of delivered lines from intervals of three parts of the table."""
    key, delivered = "l_orderkey", F.col("l_returnflag") != "R"
    parts = _shipped_parts(table(spark, sf_dir, "lineitem"))
    done = [ops.done_intervals(p, key, "l_linenumber", 1, 1, delivered) for p in parts]
    return ops.interval_frontier(ops.unite_intervals(*done, key=key, start=1), key, 1)


# --- merges --------------------------------------------------------------------------


def replacing_merge(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return ops.replacing_merge(events, ["user_id"], "ts", ["event_id"])


def _sign(negative: Column) -> Column:
    return F.when(negative, -1).otherwise(1)


def collapsing_merge(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "ts", "value", _sign(F.col("event_type") == "error").alias("sign")
    )
    return ops.collapsing_merge(events, ["user_id"], "sign", ["ts"])


def versioned_collapse(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("sign", _sign(F.col("l_returnflag") == "R"))
    return ops.versioned_collapse(lines, ["l_orderkey"], "l_linenumber", "sign")


def summing_merge(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    summed = ops.summing_merge(events, ["user_id", "event_type"], ["value"])
    # doubles are added as such: beyond the ninth digit a sum may depend on the order of the rows
    return summed.withColumn("value", F.round("value", 6))


def late_and_new_rows(spark, sf_dir):
    """Orders whose late tenth arrives below the saved watermark, fetched by a drain that looks back."""
    orders = table(spark, sf_dir, "orders")
    spec = TableSpec("orders", sort_key=("o_orderkey",))
    target, log = scratch_path(spark, "late"), scratch_path(spark, "state")
    early = orders.filter("o_orderkey % 10 <> 0 AND o_orderdate < date'1998-01-01'")
    state = plans.drain(spark, early, spec, TableState("orders"), target, log)
    state = plans.add_late_rows(spark, orders, spec, state, target, log, ["o_orderkey"], "10000 days")
    plans.drain(spark, orders, spec, state, target, log)
    return sources.read_target(spark, target)


def rows_years_late(spark, sf_dir):
    """Orders of which a tenth, of any age, comes after the rest was copied and followed: tables are only synced."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "years")
    spec = TableSpec("orders", sort_key=("o_orderkey",), late_ranges="month")
    for visible in (orders.filter("o_orderkey % 10 <> 0 AND o_orderdate < date'1998-01-01'"), orders.filter("o_orderkey % 10 <> 0"), orders):
        results = plans.sync_tables(spark, lambda _: visible, [spec], root)  # noqa: B023
        if results[0].status not in ("ok", "skipped"):
            raise RuntimeError(f"the copy failed: {results}")
    return plans.read_synced(spark, root, "orders")


def late_per_month(spark, sf_dir):
    """Rows that came late to a copied table, per month, by digests alone."""
    orders = table(spark, sf_dir, "orders")
    target, log = scratch_path(spark, "months_late"), scratch_path(spark, "state")
    spec = TableSpec("orders", late_ranges="month")
    plans.snapshot_table(spark, orders.filter("o_orderkey % 10 <> 0"), spec, target, log)
    state = sources.load_state(spark, log)["orders"]
    uneven = plans.uneven_ranges_of(spark, orders, spec, state, target, log)
    return uneven.select(F.substring("range", 1, 7).alias("month"), F.col("n_rows").alias("n_late"))


def _last_week(orders: DataFrame) -> DataFrame:
    """Orders as they stood before: pending ones not there yet, some prices other, some orders since deleted."""
    changed = F.when(F.col("o_orderkey") % 10 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    gone = orders.filter("o_orderkey % 25 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return orders.filter("o_orderstatus <> 'P'").withColumn("o_totalprice", changed).unionByName(gone)


def change_feed(spark, sf_dir):
    """What happened to each order since, with the price before and after."""
    orders = table(spark, sf_dir, "orders")
    changes = ops.snapshot_changes(_last_week(orders), orders, ["o_orderkey"])
    prices = [F.col(f"{side}.o_totalprice").alias(f"price_{side}") for side in ("before", "after")]
    return changes.select("o_orderkey", "op", *prices)


def mirrored_table(spark, sf_dir):
    """Orders mirrored in three states: updates and deletes reach the target."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "mirror")
    spec = TableSpec("orders", mirror_key=("o_orderkey",), month_of="o_orderdate")
    for seen in (_last_week(orders), orders.filter("o_orderkey % 3 <> 0"), orders):
        results = plans.sync_tables(spark, lambda _: seen, [spec], root)  # noqa: B023
        if results[0].error:
            raise RuntimeError(f"the copy failed: {results}")
    return plans.read_mirrored(spark, root, spec)


def source_with_layout_names(spark, sf_dir):
    """A table that itself has a month and a batch column: both come back whole."""
    month = month_number("o_orderdate").alias("yyyymm")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", month, F.col("o_custkey").alias("batch_seq"))
    root = scratch_path(spark, "names")
    spec = TableSpec("orders", month_of="o_orderdate")
    results = plans.sync_tables(spark, lambda _: orders, [spec], root)
    if results[0].status != "ok":
        raise RuntimeError(f"the copy failed: {results}")
    return sources.read_target(spark, plans.target_path(root, "orders"))


def resumed_copy(spark, sf_dir):
    """A copy in parts that dies after two of them, whose log is compacted, and that goes on."""
    root = scratch_path(spark, "resume")
    spec = TableSpec("lineitem", sort_key=LINE_ITEMS.sort_key, parts=5)
    read = sources.file_reader(spark, sf_dir, suffix=".parquet")
    log, target = plans.state_path(root), plans.target_path(root, "lineitem")

    class Died(Exception):
        pass

    def dies(part: int) -> None:
        if part == 2:
            raise Died

    try:
        plans.snapshot_in_parts(spark, read("lineitem"), spec, target, log, before_part=dies)
    except Died:
        pass
    for _ in range(2):
        results = plans.sync_tables(spark, read, [spec], root)  # compacts the log first
    state = sources.load_state(spark, log)["lineitem"]
    stored = sources.read_target(spark, target).agg(F.count("*").alias("n_rows"), F.countDistinct("l_orderkey").alias("n_orders"))
    return stored.select("n_rows", "n_orders", F.lit(state.synced_rows).alias("synced_rows"), F.lit(results[0].status).alias("status"))


def appended_versions(spark, sf_dir):
    """Events appended to a target in monthly versions per user and type, then folded to the latest."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")
    target, folded = scratch_path(spark, "versions"), scratch_path(spark, "folded")
    spec = TableSpec("events")
    for number, part in enumerate(("user_id % 3 = 0", "user_id % 3 <> 0", "true")):  # the last repeats all
        sources.write_batch(events.filter(part), target, number)
    keys = ["user_id", "event_type"]
    latest = lambda rows: ops.replacing_merge(rows, keys, "ts", ["tidemark_batch"])
    plans.fold_target(spark, spec, target, folded, 2, latest)
    return sources.read_target(spark, folded)


def stream_of_many_files(spark, sf_dir):
    """Orders laid out in six files, two per trigger, so a stream of three micro-batches and one failing view."""
    files, target = scratch_path(spark, "files"), scratch_path(spark, "stream")
    orders = table(spark, sf_dir, "orders")
    orders.repartition(6, "o_orderkey").write.parquet(files)
    stream = streaming.read_stream(spark, files, orders.schema, max_files=2)

    def fails(batch: DataFrame, number: int) -> None:
        raise ValueError("view is broken")

    streaming.follow_in_batches(
        stream, target, scratch_path(spark, "offsets"), once=True, derived={"view": fails}
    ).awaitTermination()
    batches = sources.read_target(spark, target, keep_layout=True).select("tidemark_batch").distinct().count()
    errors = streaming.derived_errors(spark, target).count()
    stored = sources.read_target(spark, target)
    return stored.agg(F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("keys")).select(
        "n_rows", "keys", F.lit(batches).cast("bigint").alias("n_batches"), F.lit(errors).cast("bigint").alias("n_errors")
    )


def stream_without_repeats(spark, sf_dir):
    """Events laid out twice in a folder and followed with repeats dropped within a delay."""
    files, target = scratch_path(spark, "files"), scratch_path(spark, "stream")
    events = table(spark, sf_dir, "events")
    for _ in range(2):
        events.repartition(STREAM_FILES, "event_id").write.mode("append").parquet(files)
    stream = streaming.read_stream(spark, files, events.schema, max_files=STREAM_FILES)
    once = streaming.drop_repeats(stream, ["event_id"], "ts", "3650 days")
    streaming.follow(once, target, scratch_path(spark, "offsets"), once=True).awaitTermination()
    return spark.read.parquet(target)


def latest_as_stream(spark, sf_dir):
    """Events in four files, out of order, followed into a change log of each user's latest, then folded."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    files, target = scratch_path(spark, "files"), scratch_path(spark, "log")
    events.repartition(4, F.col("event_id") % 101).write.parquet(files)
    stream = streaming.read_stream(spark, files, events.schema, max_files=1)
    log = streaming.latest_versions(stream, ["user_id"], ["ts", "event_id"])
    streaming.follow(log, target, scratch_path(spark, "offsets"), once=True).awaitTermination()
    return ops.replacing_merge(spark.read.parquet(target).drop(streaming.OP_COLUMN), ["user_id"], "ts", ["event_id"])


def jsonl_trailing(spark, sf_dir):
    """Event properties with something after them on every third line: those are bad, as a whole."""
    events = table(spark, sf_dir, "events")
    tail = F.when(F.col("event_id") % 3 == 0, F.element_at(F.array(*map(F.lit, (" junk", "{}", "]", "}", ",1", "  "))), (F.col("event_id") % 6 + F.lit(1)).cast("int")))
    lines = events.select("event_type", F.concat("props", F.coalesce(tail, F.lit(""))).alias("props"))
    return ops.profile_lines(lines, "props", "k", by=["event_type"])


def state_fold(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return sources.latest_per_key(turns, ["conv_id"], "turn")


# --- files, text, streams ----------------------------------------------------------------


def month_layout(spark, sf_dir):
    target = scratch_path(spark, "months")
    sources.write_batch(
        table(spark, sf_dir, "lineitem"), target, 0, "l_shipdate", ["l_orderkey", "l_linenumber"]
    )
    stored = sources.read_target(spark, target, keep_layout=True)
    return stored.groupBy(F.col("tidemark_month").alias("yyyymm")).agg(
        F.count("*").alias("n"), F.count_if(F.col("tidemark_month") != month_number("l_shipdate")).alias("misplaced")
    )


def delta_from_months(spark, sf_dir):
    """A range read from the month layout, where older months are never opened."""
    target = scratch_path(spark, "months")
    sources.write_batch(table(spark, sf_dir, "lineitem"), target, 0, "l_shipdate", ["l_orderkey"])
    stored = sources.read_target(spark, target, keep_layout=True)
    rows = ops.in_range(stored, "l_shipdate", "1998-01-01", "1998-06-30", "tidemark_month")
    return rows.drop("tidemark_batch", "tidemark_month")


def jsonl_profile(spark, sf_dir):
    profile = ops.profile_lines(table(spark, sf_dir, "events"), "props", "k", "integer", ["event_type"])
    return profile.withColumn("max_value", F.col("max_value").cast("bigint"))


def jsonl_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "jsonl")
    sources.write_json_lines(events, path)
    return sources.read_json_lines(spark, path, events.schema)


def jsonl_bad_lines(spark, sf_dir):
    """Document texts and event properties as lines: only the latter are JSON."""
    lines = table(spark, sf_dir, "documents").select(F.col("text").alias("line"), F.lit("documents").alias("origin"))
    props = table(spark, sf_dir, "events").select(F.col("props").alias("line"), F.lit("events").alias("origin"))
    profile = ops.profile_lines(lines.unionByName(props), "line", "k", "integer", ["origin"])
    return profile.withColumn("max_value", F.col("max_value").cast("bigint"))


def redact_text(spark, sf_dir):
    """Pages with credentials put into url and text, then masked."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_replace("url", "://", "://user:pw@").alias("url"),
        F.concat(F.col("html"), F.lit(" GET /?password="), F.col("page_id"), F.lit("&x=1")).alias("html"),
    )
    return redact_columns(pages, ["url", "html"])


def redactions_per_source(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    n = count_redactions("text", ["password", "token", "key", "id"])
    return documents.groupBy("source").agg(F.sum(n).alias("n_redacted"), F.count("*").alias("n_docs"))


def url_split(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", split_url("url").alias("p")).select("page_id", "p.*")


def cdc_stream(spark, sf_dir):
    """Orders followed from their files into a table by a stream that ends when caught up."""
    schema = table(spark, sf_dir, "orders").schema
    stream = streaming.read_stream(spark, f"{sf_dir}/orders.parquet*", schema)
    target = scratch_path(spark, "stream")
    streaming.follow(stream, target, scratch_path(spark, "offsets"), once=True).awaitTermination()
    return spark.read.parquet(target)


def cdc_stream_batches(spark, sf_dir):
    """The same into replayable batches by month, with revenue per status fed from each batch."""
    schema = table(spark, sf_dir, "orders").schema
    stream = streaming.read_stream(spark, f"{sf_dir}/orders.parquet*", schema)
    target, revenue = scratch_path(spark, "stream"), scratch_path(spark, "revenue")

    def add_revenue(batch: DataFrame, batch_seq: int) -> None:
        price = F.col("o_totalprice").cast("decimal(18,2)")
        per_status = batch.groupBy("o_orderstatus").agg(F.sum(price).alias("p"), F.count("*").alias("n"))
        per_status.write.mode("overwrite").parquet(f"{revenue}/batch_seq={batch_seq}")

    streaming.follow_in_batches(
        stream,
        target,
        scratch_path(spark, "offsets"),
        once=True,
        month_of="o_orderdate",
        sort_key=["o_orderkey"],
        derived={"revenue": add_revenue},
    ).awaitTermination()
    stored = sources.read_target(spark, target).groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"))
    sums = spark.read.parquet(revenue).groupBy("o_orderstatus").agg(F.sum("p").cast("double").alias("revenue"))
    return stored.join(sums, "o_orderstatus")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = [
        delta_strict_ts,
        delta_strict_int,
        delta_with_ties,
        delta_with_ties_by_range,
        delta_range,
        delta_batch_stats,
        max_watermarks,
        watermark_choice,
        watermark_profile,
        snapshot_exclude_columns,
        table_selection_counts,
        snapshot_plus_delta,
        incremental_drain,
        catch_up,
        snapshot_in_parts,
        snapshot_then_drain,
        sync_all_tables,
        page_ordered,
        page_by_range,
        batch_ledger,
        batch_ledger_tied,
        tie_safe_batches,
        tail_by_count,
        tail_by_count_by_range,
        missing_rows,
        missing_rows_by_digest,
        missing_by_sketch,
        surplus_rows,
        reconcile_counts,
        uneven_ranges,
        contiguous_frontier,
        interval_progress,
        interval_gaps,
        interval_frontier,
        replacing_merge,
        collapsing_merge,
        versioned_collapse,
        summing_merge,
        state_fold,
        month_layout,
        delta_from_months,
        jsonl_profile,
        jsonl_roundtrip,
        jsonl_bad_lines,
        redact_text,
        redactions_per_source,
        url_split,
        cdc_stream,
        cdc_stream_batches,
        late_and_new_rows,
        rows_years_late,
        late_per_month,
        change_feed,
        mirrored_table,
        source_with_layout_names,
        resumed_copy,
        appended_versions,
        stream_of_many_files,
        stream_without_repeats,
        latest_as_stream,
        jsonl_trailing,
    ]
    found = {query.__name__: query for query in registered}
    if llm:
        found |= llm.queries()
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


# --- the same in SQL ----------------------------------------------------------------------

_STRICT_TS = "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15' ORDER BY ts LIMIT 1000"
_TIES = (
    "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01' "
    "QUALIFY rank() OVER (ORDER BY o_orderdate) <= 1000"
)
_RANGE = (
    "SELECT * FROM lineitem WHERE l_shipdate > TIMESTAMP '1998-01-01' "
    "AND l_shipdate <= TIMESTAMP '1998-06-30'"
)
_PAGE = "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000 OFFSET 3000"
_TAIL = (
    "SELECT * FROM orders ORDER BY o_orderkey "
    "LIMIT (SELECT count(*) FILTER (o_orderstatus = 'P') FROM orders) "
    "OFFSET (SELECT count(*) FILTER (o_orderstatus <> 'P') FROM orders)"
)
_MISSING = "SELECT * FROM orders EXCEPT ALL SELECT * FROM orders WHERE o_orderstatus <> 'P'"
_URL_USER_INFO = r"""(://[^/?#@:\s"''<>]*:)[^/?#\s"''<>]*@"""

# expected choice of the watermark column, by table
_WATERMARK_COLUMNS = {
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderdate",
    "lineitem": "l_shipdate",
    "events": "ts",
    "documents": "doc_id",
    "embeddings": "vec_id",
    "pages": "page_id",
    "benchmark": "item_id",
    "labels": "doc_id",
    "conversations": "conv_id",
}


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _names() -> str:
    return ", ".join(f"'{name}'" for name in TABLES)


def oracle_sql() -> dict[str, str]:
    ledger = (
        "SELECT CAST(rn // 1000 AS BIGINT) AS batch_no, count(*) AS n_rows, min({key}) AS lo, max({key}) AS hi "
        "FROM (SELECT {key}, row_number() OVER (ORDER BY {key}) - 1 AS rn FROM {table}) GROUP BY 1"
    )
    lines_profile = (
        "SELECT {group} AS {name}, count(*) FILTER (trim({line}) <> '') AS n_lines, "
        "count(*) FILTER (trim({line}) <> '' AND NOT json_valid({line})) AS n_bad, "
        "max(CASE WHEN json_valid({line}) "
        "THEN TRY_CAST(json_extract_string({line}, '$.k') AS BIGINT) END) AS max_value "
        "FROM {table} GROUP BY 1"
    )
    status = (
        "CASE WHEN src > dst THEN 'target_short' WHEN src < dst THEN 'target_extra' ELSE 'match' END AS status"
    )
    frontier = """
            WITH done AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'R'),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS rn FROM done),
            ends AS (SELECT l_orderkey, max(CASE WHEN l_linenumber = rn THEN rn END) AS run, count(*) AS n
                     FROM ranked GROUP BY 1)
            SELECT l_orderkey, CAST(coalesce(run, 0) + 1 AS BIGINT) AS frontier,
              CAST(coalesce(n, 0) - coalesce(run, 0) AS BIGINT) AS n_ahead
            FROM (SELECT DISTINCT l_orderkey FROM lineitem) LEFT JOIN ends USING (l_orderkey)"""
    islands = """
            done AS (SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem WHERE l_orderkey >= 1),
            ranked AS (SELECT *, l_orderkey - row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey) AS island
                       FROM done),
            islands AS (SELECT l_returnflag, CAST(min(l_orderkey) AS BIGINT) AS "first",
                          CAST(max(l_orderkey) AS BIGINT) AS "last"
                        FROM ranked GROUP BY l_returnflag, island)"""
    latest = """
            SELECT user_id, ts, event_id, event_type, value FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
    extra = llm.oracle_sql() if llm else {}
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        extra["pipeline"] = corpus_pipeline.ORACLE_SQL
    return extra | {
        "delta_strict_ts": _STRICT_TS,
        "delta_strict_int": "SELECT * FROM customer WHERE c_custkey > 500 ORDER BY c_custkey LIMIT 300",
        "delta_with_ties": _TIES,
        "delta_with_ties_by_range": _TIES,
        "delta_range": _RANGE,
        "delta_batch_stats": f"SELECT count(*) AS n_rows, max(ts) AS new_watermark FROM ({_STRICT_TS})",
        "max_watermarks": _union(
            f"SELECT '{name}' AS table_name, CAST(max({column}) AS VARCHAR) AS watermark FROM {name}"
            for name, column in _WATERMARK_COLUMNS.items()
        ),
        "watermark_choice": f"""
            WITH tiers AS (
              SELECT table_name, column_name, ordinal_position,
                CASE WHEN dated AND lower(column_name) IN
                          ('updated_at', 'modified_at', 'event_time', 'created_at', 'timestamp') THEN 1
                     WHEN dated THEN 2
                     WHEN whole AND lower(column_name) IN ('_version', 'version', 'id') THEN 3
                     WHEN whole THEN 4 END AS tier
              FROM (SELECT *, data_type LIKE 'TIMESTAMP%' OR data_type = 'DATE' AS dated,
                           data_type = 'BIGINT' AS whole
                    FROM information_schema.columns WHERE table_name IN ({_names()}))),
            best AS (
              SELECT * FROM tiers QUALIFY row_number() OVER (
                PARTITION BY table_name ORDER BY tier NULLS LAST, ordinal_position) = 1),
            counts AS ({_union(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in TABLES)})
            SELECT table_name,
              CASE WHEN tier <= 2 THEN 'datetime' WHEN tier <= 4 THEN 'integer' ELSE 'count' END AS kind,
              CASE WHEN tier IS NOT NULL THEN column_name END AS column_name, n_rows
            FROM best JOIN counts USING (table_name)""",
        "watermark_profile": _union(
            f"SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS n_rows, "
            f"CAST(coalesce(sum(n) FILTER (v IS NULL), 0) AS BIGINT) AS n_null, count(v) AS n_distinct, "
            f"CAST(min(v) AS VARCHAR) AS min_value, CAST(max(v) AS VARCHAR) AS max_value, "
            f"max(n) FILTER (v IS NOT NULL) AS largest_tie "
            f"FROM (SELECT {c} AS v, count(*) AS n FROM lineitem GROUP BY 1)"
            for c in ("l_shipdate", "l_orderkey", "l_partkey", "l_suppkey")
        ),
        "snapshot_exclude_columns": "SELECT * EXCLUDE (o_totalprice) FROM orders",
        "table_selection_counts": _union(
            f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in ("customer", "orders")
        ),
        "snapshot_plus_delta": "SELECT * FROM lineitem",
        "incremental_drain": "SELECT * FROM lineitem",
        "catch_up": "SELECT * FROM lineitem",
        "snapshot_in_parts": "SELECT * FROM lineitem",
        "snapshot_then_drain": "SELECT * FROM lineitem",
        "sync_all_tables": _union(
            f"SELECT '{name}' AS table_name, count(*) AS src, count(*) AS dst, CAST(0 AS BIGINT) AS diff, "
            f"'match' AS status FROM {name}"
            for name in TABLES
        ),
        "page_ordered": _PAGE,
        "page_by_range": _PAGE,
        "batch_ledger": ledger.format(key="o_orderkey", table="orders"),
        "batch_ledger_tied": ledger.format(key="l_suppkey", table="lineitem"),
        "tie_safe_batches": """
            SELECT CAST(start // 1000 AS BIGINT) AS batch_no, CAST(sum(n) AS BIGINT) AS n_rows,
              min(l_shipdate) AS lo, max(l_shipdate) AS hi
            FROM (SELECT l_shipdate, n, sum(n) OVER (ORDER BY l_shipdate) - n AS start
                  FROM (SELECT l_shipdate, count(*) AS n FROM lineitem GROUP BY 1))
            GROUP BY 1""",
        "tail_by_count": _TAIL,
        "tail_by_count_by_range": _TAIL,
        "missing_rows": _MISSING,
        "missing_rows_by_digest": _MISSING,
        "missing_by_sketch": """
            SELECT * FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 97 = 0)
            EXCEPT ALL SELECT * FROM orders WHERE o_orderkey % 50 <> 7""",
        "surplus_rows": _MISSING,
        "reconcile_counts": f"""
            SELECT table_name, src, dst, src - dst AS diff, {status} FROM (
              SELECT 'orders' AS table_name, count(*) AS src,
                count(*) FILTER (o_orderstatus <> 'P') AS dst FROM orders
              UNION ALL SELECT 'customer', count(*), count(*) FROM customer
              UNION ALL SELECT 'events', count(*) FILTER (event_type <> 'error'), count(*) FROM events)""",
        "uneven_ranges": """
            SELECT CAST(o_orderkey // 100 * 100 AS BIGINT) AS range_start, count(*) AS src,
              count(*) FILTER (o_orderstatus <> 'P') AS dst
            FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'P') > 0""",
        "contiguous_frontier": frontier,
        "interval_frontier": frontier,
        "interval_progress": f"""
            WITH {islands}
            SELECT l_returnflag, "first", "last" FROM islands""",
        "interval_gaps": f"""
            WITH {islands},
            beside AS (SELECT l_returnflag, coalesce(lag("last") OVER w, 0) + 1 AS "first", "first" - 1 AS "last"
                       FROM islands WINDOW w AS (PARTITION BY l_returnflag ORDER BY "first"))
            SELECT * FROM beside WHERE "first" <= "last" """,
        "replacing_merge": latest,
        "latest_as_stream": latest,
        "collapsing_merge": """
            WITH signed AS (SELECT *, CASE WHEN event_type = 'error' THEN -1 ELSE 1 END AS sign FROM events),
            folded AS (
              SELECT user_id, sum(sign) AS net, arg_max(event_id, ts) FILTER (sign > 0) AS up,
                arg_min(event_id, ts) FILTER (sign < 0) AS down
              FROM signed GROUP BY 1 HAVING sum(sign) <> 0)
            SELECT s.user_id, s.event_id, s.ts, s.value, s.sign
            FROM folded f JOIN signed s ON s.event_id = CASE WHEN f.net > 0 THEN f.up ELSE f.down END""",
        "versioned_collapse": """
            SELECT l_orderkey, l_linenumber,
              CAST(sum(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) AS BIGINT) AS net
            FROM lineitem GROUP BY 1, 2 HAVING net <> 0""",
        "summing_merge": """
            SELECT user_id, event_type, round(sum(value), 6) AS value, count(*) AS n_rows
            FROM events GROUP BY 1, 2 HAVING sum(value) <> 0""",
        "late_and_new_rows": "SELECT * FROM orders",
        "rows_years_late": "SELECT * FROM orders",
        "mirrored_table": "SELECT * FROM orders",
        "change_feed": """
            WITH before AS (
              SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS price
              FROM orders WHERE o_orderstatus <> 'P'
              UNION ALL SELECT -o_orderkey - 1, o_totalprice FROM orders WHERE o_orderkey % 25 = 0)
            SELECT o_orderkey, CASE WHEN b.price IS NULL THEN 'insert' WHEN o.o_totalprice IS NULL THEN 'delete' ELSE 'update' END AS op,
              b.price AS price_before, o.o_totalprice AS price_after
            FROM before b FULL JOIN orders o USING (o_orderkey) WHERE b.price IS DISTINCT FROM o.o_totalprice""",
        "late_per_month": """
            SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_late FROM orders
            WHERE o_orderkey % 10 = 0
              AND o_orderdate <= (SELECT max(o_orderdate) FROM orders WHERE o_orderkey % 10 <> 0) GROUP BY 1""",
        "source_with_layout_names": """
            SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS yyyymm,
              o_custkey AS batch_seq FROM orders""",
        "resumed_copy": """
            SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders, count(*) AS synced_rows,
              'skipped' AS status FROM lineitem""",
        "appended_versions": """
            SELECT user_id, event_type, ts, value FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1""",
        "stream_of_many_files": """
            SELECT count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, CAST(3 AS BIGINT) AS n_batches,
              CAST(3 AS BIGINT) AS n_errors FROM orders""",
        "stream_without_repeats": "SELECT * FROM events",
        "jsonl_trailing": lines_profile.format(
            group="event_type", name="event_type", line="props",
            table="(SELECT event_type, props || CASE WHEN event_id % 3 = 0 THEN "
            "[' junk', '{}', ']', '}', ',1', '  '][CAST(event_id % 6 + 1 AS INTEGER)] ELSE '' END AS props FROM events)",
        ),
        "state_fold": """
            SELECT conv_id, turn, role FROM conversations
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
        "month_layout": """
            SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS yyyymm, count(*) AS n,
              CAST(0 AS BIGINT) AS misplaced
            FROM lineitem GROUP BY 1""",
        "delta_from_months": _RANGE,
        "jsonl_profile": lines_profile.format(group="event_type", name="event_type", line="props", table="events"),
        "jsonl_roundtrip": "SELECT * FROM events",
        "jsonl_bad_lines": _union(
            lines_profile.format(group=f"'{table_name}'", name="origin", line=line, table=table_name)
            for table_name, line in (("documents", "text"), ("events", "props"))
        ),
        "redact_text": rf"""
            WITH spiked AS (
              SELECT page_id, replace(url, '://', '://user:pw@') AS url,
                html || ' GET /?password=' || page_id || '&x=1' AS html FROM pages),
            masked AS (
              SELECT page_id, regexp_replace(url, '{_URL_USER_INFO}', '\1*****@', 'g') AS url,
                regexp_replace(html, '{_URL_USER_INFO}', '\1*****@', 'g') AS html,
                len(regexp_extract_all(url, '{_URL_USER_INFO}'))
                  + len(regexp_extract_all(html, '{_URL_USER_INFO}')) AS n FROM spiked)
            SELECT page_id, regexp_replace(url, '(password=)[^&) ]*', '\1***', 'g') AS url,
              regexp_replace(html, '(password=)[^&) ]*', '\1***', 'g') AS html,
              CAST(n + len(regexp_extract_all(url, '(password=)[^&) ]*'))
                + len(regexp_extract_all(html, '(password=)[^&) ]*')) AS INTEGER) AS n_redacted
            FROM masked""",
        "redactions_per_source": rf"""
            SELECT source, CAST(sum(len(regexp_extract_all(text, '{_URL_USER_INFO}'))
              + len(regexp_extract_all(regexp_replace(text, '{_URL_USER_INFO}', '\1*****@', 'g'),
                    '((?:password|token|key|id)=)[^&) ]*'))) AS BIGINT) AS n_redacted, count(*) AS n_docs
            FROM documents GROUP BY 1""",
        "url_split": r"""
            WITH cut AS (
              SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme,
                regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1) AS authority,
                regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1) AS path,
                regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query FROM pages),
            parts AS (
              SELECT page_id, nullif(lower(scheme), '') AS scheme,
                nullif(regexp_extract(authority, '^([^:@]*)(:[^@]*)?@', 1), '') AS user,
                nullif(regexp_extract(authority, '^[^:@]*:(.*)@', 1), '') AS password,
                nullif(regexp_extract(authority, '([^@:]*)(:[0-9]*)?$', 1), '') AS host,
                TRY_CAST(regexp_extract(authority, ':([0-9]+)$', 1) AS INTEGER) AS port,
                nullif(path, '') AS path, nullif(query, '') AS query FROM cut)
            SELECT *, CASE WHEN scheme IS NULL THEN 'invalid_url' WHEN host IS NULL THEN 'missing_host'
                WHEN port IS NULL THEN 'missing_port' WHEN "user" IS NULL THEN 'missing_user'
                WHEN password IS NULL THEN 'missing_password'
                WHEN ltrim(coalesce(path, ''), '/') = '' THEN 'missing_path' END AS error
            FROM parts""",
        "cdc_stream": "SELECT * FROM orders",
        "cdc_stream_batches": """
            SELECT o_orderstatus, count(*) AS n_rows,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
            FROM orders GROUP BY 1""",
    }
