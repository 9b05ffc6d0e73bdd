"""Catalog tables and external databases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from commerce_lake.operators.days import of_days


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether a table or view exists; a catalog error is raised, not taken for "no"."""
    return spark.catalog.tableExists(name)


def target_keys(
    spark: SparkSession,
    table: str,
    key: str,
    date_column: str | None = None,
    dates: Sequence | DataFrame | None = None,
) -> DataFrame:
    """The key column of a table, read alone; with `dates` (a list, or a table with a column `day`),
    from those date partitions only."""
    df = spark.table(table)
    return (df if dates is None else of_days(df, dates, date_column)).select(key)


def read_query(
    spark: SparkSession, source: str, options: Mapping[str, str], query: str
) -> DataFrame:
    """Result of a query that an external database runs itself (any source with `query`)."""
    return spark.read.format(source).options(**options).option("query", query).load()
