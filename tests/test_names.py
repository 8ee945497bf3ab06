"""Column names with dots, as nested sources have them after flattening, through whole plans."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import plans
from tidemark.types import TableSpec

AT, ID = "meta.updated_at", "row.id"


def table(spark, ids):
    df = spark.createDataFrame([(i, i % 40 if i % 13 else None) for i in ids], "i long, day int")
    at = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(day)")
    return df.select(F.col("i").alias(ID), at.alias(AT), F.lit("x").alias("a.b.c"))


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize(
    "spec",
    [
        TableSpec("t", sort_key=(ID,)),
        TableSpec("t", late_ranges="day"),
        TableSpec("t", parts=3, month_of=AT),
        TableSpec("t", excluded=(AT,), sort_key=(ID,)),
        TableSpec("t", mirror_key=(ID,), sort_key=(ID,)),
    ],
    ids=["plain", "late", "parts", "by content", "mirror"],
)
def test_through_sync(spark, folder, spec):
    first, grown = table(spark, range(0, 60, 2)), table(spark, range(60)).unionByName(table(spark, [1000 + 41 * 13]))
    if spec.late_ranges is None and not spec.mirror_key and not spec.excluded:  # only what is above the watermark comes
        grown = first.unionByName(table(spark, [79, 119, 159]))
    for df in (first, grown):
        result = plans.sync_tables(spark, lambda _: df, [spec], folder, batch_rows=7)[0]  # noqa: B023
        assert result.error is None, result.error
    stored = plans.read_mirrored(spark, folder, spec) if spec.mirror_key else plans.read_synced(spark, folder, "t")
    want = grown.drop(*spec.excluded) if spec.excluded else grown
    assert bag(stored.select(*(f"`{c}`" for c in want.columns))) == bag(want)


def test_operators(spark):
    df = table(spark, range(1, 13))
    assert ops.read_max(df, AT) == "2024-01-13 00:00:00"
    assert ops.max_watermark(df, ID).first()[0] == 12
    assert ops.batch_stats(df, AT).first()["n_rows"] == 12
    assert ops.batch_ledger(df, [ID], 5).count() == 3
    assert ops.tie_safe_batches(df, AT, 5).count() == 3
    assert [r[0] for r in ops.page(df, [ID], 3, 4).collect()] == [4, 5, 6, 7]
    assert [r[0] for r in ops.strict_batch(df, AT, "2024-01-05", 3).collect()] == [5, 6, 7]
    assert plans.late_rows(df, df.filter(f"`{ID}` <> 9"), AT, [ID], "30 days", "2024-01-12").count() == 1
