"""Scalar column functions; all are built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def month_number(column: str | Column) -> Column:
    """``2024-03-09`` -> ``202403``."""
    return F.year(column) * 100 + F.month(column)


def name_in(column: str | Column, names: Iterable[str]) -> Column:
    """Case-insensitive membership."""
    return F.lower(column).isin([name.lower() for name in names])


def is_blank(line: str | Column) -> Column:
    """True for a line of white space only."""
    return F.regexp_like(line, F.lit(r"^\s*$"))


def json_is_bad(line: str | Column) -> Column:
    """True for a non-blank line that is not one JSON value and nothing else."""
    line = F.col(line) if isinstance(line, str) else line
    return ~is_blank(line) & json_value(line).isNull()


def json_value(line: str | Column) -> Column:
    """The line as a variant; NULL unless the whole line is one JSON value.

    The parser stops after the first value and ignores the rest. So the line is
    parsed as the element of an array and as the field of an object: what
    follows a value may close the one or go on in it, but never in both.
    """
    line = F.col(line) if isinstance(line, str) else line
    in_array = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), line, F.lit("}")))
    return F.when(in_array.isNotNull(), F.try_variant_get(in_object, "$.v", "variant"))


def json_field(line: str | Column, field: str, type_name: str = "string") -> Column:
    """A top-level scalar field; NULL where missing, malformed or of another type.

    Booleans, nulls, arrays and objects are never values, even for strings.
    """
    return field_of(json_value(line), field, type_name)


def field_of(parsed: Column, field: str, type_name: str = "string") -> Column:
    """The same of a line that :func:`json_value` has parsed."""
    path = f'$["{field}"]'
    kind = F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
    scalar = F.regexp_like(kind, F.lit(r"^(STRING|BIGINT|DECIMAL|DOUBLE|FLOAT)"))
    return F.when(scalar, F.try_variant_get(parsed, path, "string")).try_cast(type_name)
