"""Which columns and which tables take part."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, types as T

# Kinds of columns that are computed and never stored.
VIRTUAL_KINDS = ("MATERIALIZED", "ALIAS", "EPHEMERAL")


def default_kind(field: T.StructField) -> str:
    return field.metadata.get("default_kind", "")


def kept_columns(schema: T.StructType, excluded: Sequence[str] = ()) -> list[str]:
    """Stored columns in source order without the excluded ones.

    Nothing left is an error: falling back to all columns would send exactly
    what was to be withheld.
    """
    kept = [f.name for f in schema.fields if default_kind(f) not in VIRTUAL_KINDS and f.name not in excluded]
    if not kept:
        raise ValueError("no column is left after exclusion")
    return kept


def project(df: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """The table without excluded and virtual columns; prunes the scan."""
    return df.select(*(f"`{name}`" for name in kept_columns(df.schema, excluded)))


def parse_exclusions(entries: Iterable[str]) -> dict[str, list[str]]:
    """``["orders.secret", ...]`` -> ``{"orders": ["secret"], ...}``, malformed entries warned about."""
    by_table: dict[str, list[str]] = {}
    for entry in entries:
        table, _, column = entry.partition(".")
        if table and column:
            by_table.setdefault(table, []).append(column)
        else:
            warnings.warn(f"ignoring {entry!r}: expected table.column", stacklevel=2)
    return by_table


def select_tables(
    names: Iterable[str], include: Sequence[str] = (), exclude: Sequence[str] = ()
) -> list[str]:
    """Names to copy, sorted; matching is exact and an exclusion always wins."""
    chosen = set(include) & set(names) if include else set(names)
    return sorted(chosen - set(exclude))
