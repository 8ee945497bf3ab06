"""Where tables come from: a catalog database or a folder of files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the stored tables of a database, sorted; views hold no rows of their own."""
    found = spark.catalog.listTables(database)
    return sorted(t.name for t in found if not t.isTemporary and t.tableType != "VIEW")


def table_reader(spark: SparkSession, database: str) -> Callable[[str], DataFrame]:
    return lambda name: spark.table(f"`{database}`.`{name}`")


def file_reader(
    spark: SparkSession, root: str, file_format: str = "parquet", suffix: str = ""
) -> Callable[[str], DataFrame]:
    """Tables as files or folders below one root, such as ``root/orders.parquet``."""
    return lambda name: spark.read.format(file_format).load(f"{root}/{name}{suffix}")
