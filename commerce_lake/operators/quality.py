"""Checks over tables: those that return the offending rows or counts as a DataFrame, and gates,
which return the table itself and make whatever writes it fail, before anything is committed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.operators.joins import BROADCAST_ROWS, find_hot_keys, lookup_where
from commerce_lake.operators.merge import union_all


def table_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, 0 for empty ones. On parquet tables this reads the file footers only."""
    counted = []
    for name, df in tables.items():
        none = df.sparkSession.range(0, 1, 1, 1)  # so that a table without rows has its line too
        for rows, each in ((df, 1), (none, 0)):
            weight = F.lit(each).cast("bigint").alias("row_count")
            counted.append(rows.select(F.lit(name).alias("table_name"), weight))
    total = F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")
    return union_all(counted).groupBy("table_name").agg(total)


def count_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, in value order."""
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy(column)


def orphan_keys(
    fact: DataFrame, fact_key: str, dimension: DataFrame, dimension_key: str
) -> DataFrame:
    """Non-null fact keys without a dimension row, with the number of fact rows using them."""
    used = (
        fact.where(F.col(fact_key).isNotNull())
        .groupBy(F.col(fact_key).alias("orphan_key"))
        .agg(F.count("*").alias("fact_rows"))
    )
    known = dimension.select(F.col(dimension_key).alias("orphan_key"))
    return used.join(known, "orphan_key", "left_anti")


def key_collisions(dimension: DataFrame, key: str, natural: str) -> DataFrame:
    """Surrogate keys that stand for more than one natural key."""
    return (
        dimension.select(key, natural)
        .distinct()
        .groupBy(key)
        .agg(F.count("*").alias("natural_keys"))
        .where("natural_keys > 1")
    )


def _unless(good: Column, column: str, df: DataFrame, message: str) -> Column:
    """`column` where `good`, else an error that names the value."""
    text = F.concat(F.lit(f"{message}: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
    failure = F.raise_error(text).cast(df.schema[column].dataType)
    return F.when(good, F.col(column)).otherwise(failure)


def fail_on_collisions(dimension: DataFrame, key: str, natural: str) -> DataFrame:
    """The dimension, which fails when it is evaluated if a surrogate key stands for more than one
    natural key (null is one of them). Repeated rows of one natural key are no collision."""
    same = Window.partitionBy(key)
    fingerprint = F.struct(F.col(natural).isNull(), natural)
    one = F.min(fingerprint).over(same).eqNullSafe(F.max(fingerprint).over(same))
    return dimension.withColumn(key, _unless(one, key, dimension, f"{key} of several {natural}"))


def fail_on_orphans(
    fact: DataFrame, fact_key: str, dimension: DataFrame, dimension_key: str
) -> DataFrame:
    """The fact, which fails when it is evaluated if a key has no dimension row; null keys pass.

    The dimension is counted (on parquet from the footers) and sent to all executors if it is
    small; otherwise both are shuffled, with the rows of hot keys spread. Whether a key is there
    more than once in the dimension does not matter.
    """
    known = dimension.select(F.col(dimension_key).alias("_known")).distinct()
    if dimension.count() <= BROADCAST_ROWS:
        known, hot = F.broadcast(known), []
    else:
        hot = find_hot_keys(fact, fact_key)
    on = (F.col(fact_key), F.col("_known"))
    found = lookup_where(fact, known, on[0] == on[1], on=on, hot=hot)
    good = F.col(fact_key).isNull() | F.col("_known").isNotNull()
    checked = found.withColumn(fact_key, _unless(good, fact_key, fact, f"{fact_key} without a row"))
    return checked.select(*fact.columns)
