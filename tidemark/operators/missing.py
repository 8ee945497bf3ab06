"""Rows the target lacks: by position and by content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.ordering import last_rows
from tidemark.session import scratch_path
from tidemark.types import MAX_BROADCAST_ROWS, MAX_GATHER_ROWS, TIMESTAMP_OPTIONS

# How many copies of one row a task writes out at a time.
COPIES_PER_PIECE = 10_000
DIGEST = ["_hash_1", "_hash_2"]


def tail_by_count(
    source: DataFrame, target: DataFrame, keys: Sequence[str], max_gather: int = MAX_GATHER_ROWS
) -> DataFrame:
    """Source rows placed after the target's row count, in key order.

    Only right if new rows sort last; :func:`missing_rows` has no such
    condition. The end of the tail is looked up from the far end, so its cost
    follows the number of new rows and not the offset. A tail that would cut a
    group of equal keys is an error.
    """
    if not keys:
        raise ValueError("a tail needs an order key")
    sides = source.select(F.lit(True).alias("src")).unionByName(target.select(F.lit(False).alias("src")))
    n = sides.agg(F.count_if("src").alias("src"), F.count_if(~F.col("src")).alias("dst")).first()
    new = n["src"] - n["dst"]
    if new <= 0:
        return source.filter(F.lit(False))
    return last_rows(source, keys, n["src"], new, max_gather)


def missing_rows(source: DataFrame, target: DataFrame, by_digest: bool = False) -> DataFrame:
    """Source rows that the target lacks, as a multiset.

    Equal rows are counted before the shuffle, so copies of one row cost
    nothing. ``by_digest`` shuffles two 64-bit hashes per distinct row instead of
    the row and compares whole rows only where those differ in count: the way for
    wide tables that agree on most rows. It can overlook a row only if a different
    row has both hashes in common.
    """
    target = target.select(*(f"`{c}`" for c in source.columns))
    if not by_digest:
        return except_all(source, target)
    spark, path = source.sparkSession, scratch_path(source.sparkSession, "suspects")
    _uneven_digests(source, target).write.parquet(path)
    suspects = spark.read.parquet(path)
    n_suspects = suspects.count()
    if n_suspects == 0:
        return source.filter(F.lit(False))
    if n_suspects <= MAX_BROADCAST_ROWS:  # 16 bytes each: whole rows that agree are never shuffled
        suspects = F.broadcast(suspects)

    def suspected(df: DataFrame) -> DataFrame:
        digested = df.withColumns(dict(zip(DIGEST, row_digest(df))))
        return digested.join(suspects, DIGEST, "left_semi").drop(*DIGEST)

    return except_all(suspected(source), suspected(target))


def surplus_rows(source: DataFrame, target: DataFrame, by_digest: bool = False) -> DataFrame:
    """Target rows the source no longer has: deletes, which no watermark shows."""
    return missing_rows(target, source, by_digest)


def same_rows(source: DataFrame, target: DataFrame) -> bool:
    """Whether both sides hold the same multiset of rows, by their number and the sums of two hashes of each row.

    Every task sends one row, so asking costs a scan of each side and no
    shuffle. Different tables pass for equal only if both 64-bit sums agree.
    """

    def measure(df: DataFrame) -> tuple:
        sums = [F.sum(h.cast("decimal(20,0)")) for h in row_digest(df)]
        return tuple(df.agg(F.count("*"), *sums).first())

    return measure(source) == measure(target.select(*(f"`{c}`" for c in source.columns)))


def _uneven_digests(source: DataFrame, target: DataFrame) -> DataFrame:
    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*(h.alias(n) for n, h in zip(DIGEST, row_digest(df))), F.lit(sign).alias("_net"))

    both = side(source, 1).unionByName(side(target, -1))
    return both.groupBy(*DIGEST).agg(F.sum("_net").alias("_net")).filter("_net <> 0").drop("_net")


def row_digest(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of the row with different starts.

    The hash skips NULLs and runs through nested values without their bounds, so
    the places of NULLs are hashed too, and nested values as JSON text.
    """
    flat, nulls = [], []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        nulls.append(F.when(value.isNull(), "n").otherwise("v"))
        if isinstance(field.dataType, T.MapType):
            value = F.array_sort(F.map_entries(value))
        if isinstance(field.dataType, (T.MapType, T.ArrayType, T.StructType)):
            value = F.to_json(value, {"ignoreNullFields": "false", **TIMESTAMP_OPTIONS})
        flat.append(value)
    row = [*flat, F.concat(*nulls)]
    return [F.xxhash64(*row), F.xxhash64(F.lit(1), *row)]


def _is_map(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.MapType)


def _comparable(df: DataFrame) -> list[Column]:
    """Maps cannot be compared, their sorted entries can."""
    return [
        F.array_sort(F.map_entries(f.name)).alias(f.name) if _is_map(f) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]


def except_all(source: DataFrame, target: DataFrame) -> DataFrame:
    """The multiset difference, with many copies of one row spread over tasks.

    Like the built-in operator this counts every distinct row up on one side and
    down on the other. The rows left are cut into pieces of limited copies and
    shuffled as such before the copies are written out, so that no task has to
    produce all copies of a row.
    """
    names = source.columns
    sides = source.select(*_comparable(source), F.lit(1).alias("_net")).unionByName(
        target.select(*_comparable(target), F.lit(-1).alias("_net"))
    )
    columns = [f"`{name}`" for name in names]
    net = sides.groupBy(*columns).agg(F.sum("_net").alias("_net")).filter("_net > 0")
    pieces = net.withColumn("_piece", F.explode(F.expr(f"sequence(0L, (_net - 1) div {COPIES_PER_PIECE})")))
    # a fixed number of tasks: by their bytes, pieces would look worth joining
    tasks = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = pieces.repartition(tasks, "_piece", *columns)
    copies = F.least(F.lit(COPIES_PER_PIECE), F.col("_net") - F.col("_piece") * COPIES_PER_PIECE)
    rest = spread.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))))
    back = [
        F.map_from_entries(f.name).alias(f.name) if _is_map(f) else F.col(f"`{f.name}`")
        for f in source.schema.fields
    ]
    return rest.select(*back)
