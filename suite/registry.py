"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suite.entities import Tables, with_entities

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so that two engines can be compared value by value."""
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    text = {f.name: F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, times)}
    return df.withColumns(text) if text else df


def query(name: str, sql: str, *entities: str):
    """Register a function of Tables under `name`; `entities` are the views its SQL uses."""

    def register(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(function(Tables(spark, folder)))

        QUERIES[name] = run
        SQL[name] = with_entities(sql, *entities)
        return function

    return register
