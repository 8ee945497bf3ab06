"""What changed between two states of a table: inserts, updates and deletes with their images.

One aggregate by key sees both states, so the comparison is one shuffle. As
signed rows, changes can be appended to a target that folds them by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Fixed value: the column in which a change feed keeps +1 for a row that came and -1 for one that went.
SIGN_COLUMN = "tidemark_sign"


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, op, before, after`` for every key whose row differs: op is insert, update or delete.

    ``before`` and ``after`` are whole rows, NULL where there is none. Values are
    compared like in joins that treat NULLs as equal; NULL keys are a key. A key
    that stands twice on one side is an error.
    """
    return _changes(_side(old.select(*_quoted(new.columns)), keys, False), _side(new, keys, True), keys, new.schema)


def pending_changes(stored: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The changes that bring a target of signed rows to the state of ``source``.

    ``stored`` has the source's columns, SIGN_COLUMN and the arrival ``order``.
    Its fold by key and the comparison are the same aggregate.
    """
    before = _side(stored, keys, False, source.columns, F.col(SIGN_COLUMN), F.struct(*_quoted(order)))
    return _changes(before, _side(source, keys, True), keys, source.schema)


def signed_rows(changes: DataFrame) -> DataFrame:
    """Changes as rows with SIGN_COLUMN: the old row with -1, the new one with +1."""
    both = F.array(
        F.struct(F.col("before").alias("row"), F.lit(-1).alias("sign")), F.struct(F.col("after").alias("row"), F.lit(1).alias("sign"))
    )
    rows = changes.select(F.explode(both).alias("c")).filter("c.row IS NOT NULL")
    return rows.select("c.row.*", F.col("c.sign").alias(SIGN_COLUMN))


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _side(
    df: DataFrame, keys: Sequence[str], is_new: bool, columns: Sequence[str] = (), sign: Column | None = None, order: Column | None = None
) -> DataFrame:
    key = F.struct(*_quoted(keys)).alias("key")
    row = F.struct(*_quoted(columns or df.columns)).alias("row")
    return df.select(
        key, row, F.lit(is_new).alias("is_new"), (F.lit(1) if sign is None else sign).cast("int").alias("sign"),
        (F.struct(F.lit(0)) if order is None else order).alias("at"),
    )


def _changes(old: DataFrame, new: DataFrame, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    nothing = F.lit(None).cast(old.schema["at"].dataType)
    both = old.unionByName(new.withColumn("at", nothing))
    stood = ~F.col("is_new") & (F.col("sign") > 0)
    folded = both.groupBy("key").agg(
        F.coalesce(F.sum(F.when(~F.col("is_new"), F.col("sign"))), F.lit(0)).alias("n_old"),
        F.count_if("is_new").alias("n_new"),
        F.max_by(F.when(stood, F.col("row")), F.when(stood, F.col("at"))).alias("last"),
        F.any_value(F.when(F.col("is_new"), F.col("row")), True).alias("after"),
    )
    twice = F.raise_error(F.concat(F.lit("the key is not unique: "), F.to_json("key")))
    before = F.when(F.col("n_old") > 0, F.col("last"))
    op = (
        F.when((F.col("n_old") > 1) | (F.col("n_new") > 1), twice.cast("string"))
        .when((F.col("n_old") <= 0) & (F.col("n_new") > 0), "insert")
        .when((F.col("n_old") > 0) & (F.col("n_new") == 0), "delete")
        .when((F.col("n_old") > 0) & ~_same_rows("last", "after", schema), "update")
    )
    found = folded.select("key", op.alias("op"), before.alias("before"), "after").filter("op IS NOT NULL")
    return found.select(*(F.col("key").getField(k).alias(k) for k in keys), "op", "before", "after")


def _same_rows(one: str, other: str, schema: T.StructType) -> Column:
    same = F.lit(True)
    for field in schema.fields:
        a, b = (F.col(side).getField(field.name) for side in (one, other))
        if isinstance(field.dataType, T.MapType):
            a, b = (F.array_sort(F.map_entries(v)) for v in (a, b))
        same = same & a.eqNullSafe(b)
    return same
