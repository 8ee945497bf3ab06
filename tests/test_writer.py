"""Two writers of one target: the older one is refused before it writes anything."""

import pytest
from pyspark.sql import functions as F

from tidemark import TableSpec, plans, sources
from tidemark.session import list_files

SPEC = TableSpec("orders", sort_key=("id",))


def orders(spark, n):
    return spark.range(n).select("id", F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("updated_at"))


def sync(session, folder, n):
    return plans.sync_tables(session, lambda _: orders(session, n), [SPEC], folder)


def stored_files(spark, folder):
    return sorted(f for f in list_files(spark, folder) if f.endswith(".parquet"))


def test_the_older_writer_fails_before_it_writes(spark, folder):
    old, new = spark.newSession(), spark.newSession()
    plans.claim_tables(old, [SPEC], folder)
    sync(old, folder, 10)
    assert plans.read_synced(spark, folder, "orders").count() == 10
    plans.claim_tables(new, [SPEC], folder)
    before = stored_files(spark, folder)
    target, log = plans.target_path(folder, "orders"), plans.state_path(folder)
    saved = sources.load_state(spark, log)["orders"]
    for write in (
        lambda: plans.poll_table(old, orders(old, 20), SPEC, saved, target, log),
        lambda: plans.drain(old, orders(old, 20), SPEC, saved, target, log),
        lambda: plans.catch_up(old, orders(old, 20), SPEC, saved, target, log),
        lambda: plans.recover(old, orders(old, 20), SPEC, saved, target),
        lambda: plans.snapshot_table(old, orders(old, 20), SPEC, target, log),
        lambda: sources.append_state(old, log, [saved]),
        lambda: sources.write_batch(orders(old, 20), target, 7),
        lambda: sources.append_state(spark, log, [saved]),  # a session without any claim
    ):
        with pytest.raises(sources.StaleWriterError, match="newer writer"):
            write()
    assert stored_files(spark, folder) == before
    sync(new, folder, 20)
    assert plans.read_synced(spark, folder, "orders").count() == 20


def test_a_writer_replaced_while_it_writes_cannot_record(spark, folder):
    """Data it has written stay unrecorded: the new writer drops them and stores its own."""
    old, new = spark.newSession(), spark.newSession()
    plans.claim_tables(old, [SPEC], folder)
    sync(old, folder, 10)
    target, log = plans.target_path(folder, "orders"), plans.state_path(folder)
    saved = sources.load_state(spark, log)["orders"]
    sources.write_batch(orders(old, 15).filter("id >= 10"), target, saved.batch_seq + 1)
    plans.claim_tables(new, [SPEC], folder)
    with pytest.raises(sources.StaleWriterError):
        sources.append_state(old, log, [saved])
    sync(new, folder, 20)
    got = sorted(r["id"] for r in plans.read_synced(spark, folder, "orders").collect())
    assert got == list(range(20))


def test_unclaimed_folders_are_open_and_a_claimed_log_is_empty(spark, folder):
    one, other = spark.newSession(), spark.newSession()
    sources.write_batch(orders(one, 3), f"{folder}/free", 0)
    sources.write_batch(orders(other, 4), f"{folder}/free", 1)
    assert sources.read_target(spark, f"{folder}/free").count() == 7
    sources.claim_writer(one, f"{folder}/log")
    assert sources.load_state(one, f"{folder}/log") == {}
    sources.claim_writer(one, f"{folder}/log")  # again, after a restart
    sources.check_writer(one, f"{folder}/log/")


def test_a_claim_taken_meanwhile_is_an_error(spark, folder, monkeypatch):
    session = spark.newSession()
    sources.claim_writer(session, folder)
    monkeypatch.setattr("tidemark.sources.writer.newest_claim", lambda *_: 0)  # read before the other's file
    with pytest.raises(sources.StaleWriterError, match="same time"):
        sources.claim_writer(spark.newSession(), folder)
