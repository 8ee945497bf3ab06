"""Column exclusion and table selection."""

import pytest
from pyspark.sql import types as T

from tidemark import operators as ops


def fields(*columns):
    return T.StructType(
        [T.StructField(n, T.LongType(), True, {"default_kind": k} if k else {}) for n, k in columns]
    )


@pytest.mark.parametrize(
    "columns, excluded, kept",
    [
        ([("id", ""), ("name", ""), ("_version", "MATERIALIZED")], [], ["id", "name"]),
        ([("id", ""), ("secret", ""), ("name", "")], ["secret"], ["id", "name"]),
        ([("id", ""), ("computed", "MATERIALIZED"), ("alias_col", "ALIAS")], [], ["id"]),
        ([("id", ""), ("x", "EPHEMERAL"), ("y", "DEFAULT")], [], ["id", "y"]),
    ],
)
def test_kept_columns(columns, excluded, kept):
    assert ops.kept_columns(fields(*columns), excluded) == kept


def test_nothing_left_is_an_error():
    with pytest.raises(ValueError):
        ops.kept_columns(fields(("id", "")), ["id"])


def test_projection_prunes_and_keeps_odd_names(spark):
    df = spark.range(2).selectExpr("id", "id AS `a.b`", "id AS secret")
    assert ops.project(df, ["secret"]).columns == ["id", "a.b"]


def test_parse_exclusions():
    parsed = ops.parse_exclusions(["orders.secret", "users.password", "orders.internal_id", "a.b.c"])
    assert parsed == {"orders": ["secret", "internal_id"], "users": ["password"], "a": ["b.c"]}


@pytest.mark.parametrize("entry", ["nodot", ".col", "table."])
def test_malformed_exclusions_are_skipped(entry):
    with pytest.warns(UserWarning, match="table.column"):
        assert ops.parse_exclusions([entry]) == {}


@pytest.mark.parametrize(
    "names, include, exclude, chosen",
    [
        ("abc", "", "", "abc"),
        ("abc", "ac", "", "ac"),
        ("abc", "", "b", "ac"),
        ("abcd", "abc", "b", "ac"),
        ("abc", "z", "", ""),
        ("abc", "ab", "a", "b"),
        ("abc", "", "abc", ""),
    ],
)
def test_select_tables(names, include, exclude, chosen):
    assert ops.select_tables(list(names), list(include), list(exclude)) == list(chosen)


def test_selection_is_case_sensitive():
    assert ops.select_tables(["Events", "events"], ["events"]) == ["events"]
