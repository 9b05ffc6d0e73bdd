"""Rows of given days, the days being a table of any length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Stands for no day; the days of data lie before it and after FIRST.
_NONE = "9999-12-31"
_FIRST = "0001-01-01"


def of_days(rows: DataFrame, days: DataFrame | Sequence, column: str) -> DataFrame:
    """Rows whose `column` is one of `days`: a list, or a table with a column `day`. Null is a day too.

    Partitions of other days are not read, if the table is partitioned by `column`. A calendar of
    dates has fewer than four million days, so a table of days is sent to all tasks.
    """
    if not isinstance(days, DataFrame):
        wanted = F.col(column).isin([d for d in days if d is not None])
        return rows.where(wanted | F.col(column).isNull() if None in days else wanted)
    none, first = (F.lit(d).cast("date") for d in (_NONE, _FIRST))
    # The comparison lets Spark choose partitions by what the table of days holds when it runs.
    wanted = days.select(F.coalesce("day", none).alias("_day")).distinct().where(F.col("_day") >= first)
    return rows.join(F.broadcast(wanted), F.coalesce(F.col(column), none) == F.col("_day"), "left_semi")
