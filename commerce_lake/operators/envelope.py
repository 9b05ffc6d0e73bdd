"""Tagged envelopes: build, flatten, order, cut into batches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake import schemas
from commerce_lake.functions.cleaning import literal_lookup
from commerce_lake.functions.calendar import on_day
from commerce_lake.operators.merge import union_all
from commerce_lake.operators.numbering import number_rows


def build_envelope(df: DataFrame, stream_type: str) -> DataFrame:
    """Table rows as `{stream_type, event_time, data{...}}`; rows without a time are left out.

    `data` always has the fields of all stream types, so envelopes of different types can be
    put together; fields a type does not use are null.
    """
    own = schemas.VARIANT_FIELDS[stream_type]
    schemas.require_columns(df, "event_time", *[f for f in own if f != "review_text"])
    fields = [
        (F.col(f.name) if f.name in own and f.name in df.columns else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in schemas.DATA_FIELDS
    ]
    return df.where(F.col("event_time").isNotNull()).select(
        F.lit(stream_type).alias("stream_type"), "event_time", F.struct(*fields).alias("data")
    )


def unify(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One envelope frame from a mapping of stream type to table."""
    return union_all([build_envelope(df, name) for name, df in tables.items()])


def flatten_envelope(df: DataFrame) -> DataFrame:
    """Lift the fields of `data` to the top level."""
    outer = [c for c in df.columns if c != "data"]
    return df.select(*outer, *[F.col(f"data.{n}").alias(n) for n in schemas.DATA_FIELDS.names])


def explode_records(df: DataFrame, array: str) -> DataFrame:
    """One row per element of an array of structs, the struct's fields as columns."""
    return df.select(F.explode(array).alias("record")).select("record.*")


def priority(stream_type: str = "stream_type") -> Column:
    return literal_lookup(
        F.col(stream_type), schemas.STREAM_PRIORITY, schemas.UNKNOWN_PRIORITY
    )


def record_id() -> Column:
    """The id of an envelope's record, whichever stream type it is."""
    chosen = F.lit(None).cast("string")
    for name, column in schemas.RECORD_ID.items():
        chosen = F.when(F.col("stream_type") == name, F.col(f"data.{column}")).otherwise(chosen)
    return chosen


def stream_order() -> list[Column]:
    """Parents before children at equal time; the id makes the order complete."""
    return [F.col("event_time"), priority(), record_id()]


def order_by_priority(df: DataFrame) -> DataFrame:
    return df.orderBy(*stream_order())


def assign_batches(
    df: DataFrame, size: int, order_by: Sequence[Column] | None = None, within: Sequence[str] = ()
) -> DataFrame:
    """Number consecutive runs of `size` rows in stream order as `batch_id`, from 0."""
    numbered = number_rows(df, order_by or stream_order(), "_row", within)
    return numbered.withColumn("batch_id", F.floor(F.col("_row") / size)).drop("_row")


def batch_type_counts(df: DataFrame) -> DataFrame:
    """Rows of each stream type per batch."""
    return df.groupBy("batch_id").agg(
        *[
            F.count_if(F.col("stream_type") == name).alias(f"{name}_count")
            for name in schemas.STREAM_TYPES
        ]
    )


def day_slice(df: DataFrame, column: str, day: dt.date) -> DataFrame:
    """Rows of one calendar day."""
    return df.where(on_day(column, day))
