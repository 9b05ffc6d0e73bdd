"""Publishing to warehouse tables in the catalog: refreshed dimensions, appended facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from commerce_lake.operators.days import of_days
from commerce_lake.operators.dedup import dedup_by_key
from commerce_lake.operators.quality import fail_on_orphans
from commerce_lake.schemas import schema_differences
from commerce_lake.shared import materialize
from commerce_lake.sinks.key_filter import KeyFilter
from commerce_lake.sinks.versions import current_version, write_version
from commerce_lake.sources.tables import table_exists, target_keys


@dataclass(frozen=True)
class Reference:
    """A fact column whose values must be keys of a dimension; null refers to nothing."""

    column: str
    dimension: str
    key: str


@dataclass(frozen=True)
class Fact:
    """How a fact table is published; `key_implies_date` states that no key ever changes its day.

    Rows to be published must hold to `references`: one that does not makes publishing fail, and
    the fact table stays as it was.
    """

    name: str
    key: str
    date_column: str
    key_implies_date: bool = False
    references: tuple[Reference, ...] = ()


def table_name(database: str, name: str) -> str:
    """Warehouse tables have upper-case names."""
    return f"{database}.{name.upper()}"


def publish_dimension(
    df: DataFrame, database: str, name: str, *, skip_if_exists: bool = False, keep: int = 2
) -> int | None:
    """Replace a warehouse dimension. Returns its rows, or None if it was left as it was."""
    target = table_name(database, name)
    if skip_if_exists and table_exists(df.sparkSession, target):
        return None
    return write_version(df, target, keep=keep) or None


def new_rows(df: DataFrame, key: str, existing: DataFrame | None) -> DataFrame:
    """One row per key that `existing` does not have; rows without a key are left out."""
    # Rows that are there already go first, so that no more are sorted than are new.
    return dedup_by_key(df if existing is None else df.join(existing, key, "left_anti"), [key])


def _checked(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows that make the write fail where they have no key: they could not be compared."""
    message = F.raise_error(F.lit(f"null {key} in a batch for {table}")).cast(df.schema[key].dataType)
    return df.withColumn(key, F.when(F.col(key).isNotNull(), F.col(key)).otherwise(message))


def append_fact(
    df: DataFrame,
    table: str,
    key: str,
    *,
    date_column: str | None = None,
    key_implies_date: bool = False,
    key_filter: KeyFilter | None = None,
) -> int:
    """Append the rows whose key the table does not hold yet. Returns how many were appended.

    Running it again appends nothing. Rows without a key cannot be compared and make it fail,
    before anything is written. With `key_implies_date` (a key never moves to another day), only
    the target partitions of the days in the batch are read. With `key_filter` (and a
    `date_column`), only those that may hold one of the batch's keys, on whatever day; the filter is
    built when it is first used, and `df` is read several times.
    """
    spark = df.sparkSession
    existing = None
    if table_exists(spark, table) and key_filter and date_column and not key_implies_date:
        if not key_filter.exists(spark):
            key_filter.build(spark.table(table), key, date_column)
        dates = materialize(key_filter.days_of(df, key), "days_of_keys")
        existing = target_keys(spark, table, key, date_column, dates)
        key_filter.add(df, key, date_column)
    elif table_exists(spark, table):
        by_day = key_implies_date and date_column
        dates = df.select(F.col(date_column).alias("day")).distinct() if by_day else None
        existing = target_keys(spark, table, key, date_column, dates)
    result = new_rows(_checked(df, table, key), key, existing)
    if existing is not None:
        result = result.select(*spark.table(table).columns)
    if date_column:
        result = result.hint("rebalance", F.col(date_column))
    # Observed last: an empty shuffle further up would be planned away together with the count.
    appended = Observation()
    result = result.observe(appended, F.count("*").alias("rows"))
    writer = result.write.format("parquet").mode("append")
    if date_column:
        writer = writer.partitionBy(date_column)
    writer.saveAsTable(table)
    return appended.get["rows"]


def _referring(df: DataFrame, fact: Fact, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that make the write fail where they refer to nothing."""
    for reference in fact.references:
        if reference.dimension not in dimensions:
            raise ValueError(f"{fact.name} refers to {reference.dimension}, which is not published")
        df = fail_on_orphans(df, reference.column, dimensions[reference.dimension], reference.key)
    return df


def publish_fact(
    df: DataFrame,
    database: str,
    fact: Fact,
    dates: DataFrame | Sequence | None = None,
    dimensions: Mapping[str, DataFrame] | None = None,
    filters: str | None = None,
) -> int:
    """Append new fact rows, with `dates` those of these days only. Returns how many.

    Readers use a view; the rows are in a version of the table behind it. A fact that was never
    published, or whose columns have changed, is filled from all days into a version of its own,
    which the view shows once it is complete: a refill that fails, or finds no rows, leaves the
    table as it was, with its old columns. The fact's references are looked up in `dimensions`
    (by name) as its rows are written, all rows of `dates` where rows are appended. In the folder
    `filters`, each version of the table has a filter of its keys (see `append_fact`).
    """
    spark, name = df.sparkSession, table_name(database, fact.name)
    # A plain table, as earlier releases wrote it, is appended to until its columns change.
    shown = current_version(spark, name) or (name if table_exists(spark, name) else None)
    if shown is None or schema_differences(spark.table(shown).schema, df.schema):
        df = _checked(_referring(df, fact, dimensions or {}), name, fact.key)
        rows = new_rows(df, fact.key, None)
        return write_version(rows, name, by=[fact.date_column], allow_empty=shown is None)
    if dates is not None:
        df = of_days(df, dates, fact.date_column)
    df = _referring(df, fact, dimensions or {})
    return append_fact(
        df,
        shown,
        fact.key,
        date_column=fact.date_column,
        key_implies_date=fact.key_implies_date,
        key_filter=KeyFilter(f"{filters}/{shown}") if filters else None,
    )


def publish_all(
    dimensions: Mapping[str, DataFrame],
    facts: Sequence[tuple[Fact, DataFrame]],
    database: str,
    dates: DataFrame | Sequence | None = None,
    filters: str | None = None,
) -> dict[str, int | None]:
    """Publish dimensions, then facts; the first failure stops the run.

    With `dates`, only the fact rows of these days are looked at (see `publish_fact`). Facts are held
    against the dimensions published with them.
    """
    done: dict[str, int | None] = {}
    for name, df in dimensions.items():
        done[name] = publish_dimension(df, database, name)
    for fact, df in facts:
        done[fact.name] = publish_fact(df, database, fact, dates, dimensions, filters)
    return done
