"""Calendar attributes and the rotating day choice."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_attributes(day: str) -> list[Column]:
    """The columns of the date dimension, derived from the date column `day`."""
    weekday = F.dayofweek(day)
    return [
        F.col(day).alias("date_id"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        weekday.isin(1, 7).alias("is_weekend"),
    ]


def time_range(df: DataFrame, column: str) -> DataFrame:
    """One row: first and last value of a time column."""
    return df.agg(F.min(column).alias("min_time"), F.max(column).alias("max_time"))


def rotating_day_frame(df: DataFrame, column: str, today: dt.date) -> DataFrame:
    """One row: the day of the data that `today` points at.

    Walks through the covered days as the day of the year advances and starts over at the end.
    """
    offset = F.lit(today.timetuple().tm_yday) % (F.col("full_days") + 1)
    return (
        time_range(df, column)
        .withColumn("full_days", F.timestamp_diff("DAY", F.col("min_time"), F.col("max_time")))
        .select(
            F.col("min_time").cast("date").alias("first_day"),
            F.date_add(F.col("min_time").cast("date"), offset.cast("int")).alias("target_day"),
        )
    )


def rotating_day(df: DataFrame, column: str, today: dt.date) -> dt.date | None:
    """The same day as a value, so that a later filter on it is a plain literal."""
    return rotating_day_frame(df, column, today).first()["target_day"]


def on_day(column: str, day: dt.date) -> Column:
    """Half-open range over one calendar day; reaches the scan, unlike a test on a cast column."""
    start, end = (
        F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")
        for d in (day, day + dt.timedelta(days=1))
    )
    return (F.col(column) >= start) & (F.col(column) < end)
