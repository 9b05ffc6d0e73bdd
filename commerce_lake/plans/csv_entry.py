"""Source tables in CSV files: to the batched event stream, and to the landing folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake import schemas
from commerce_lake.functions.cleaning import parse_timestamp
from commerce_lake.plans.event_stream import build_event_stream, landing_records
from commerce_lake.sinks.files import write_json
from commerce_lake.sources.files import read_csv_by_name

# The column with the time of a record. Order items have the time of their order.
TIME_COLUMNS = {"events": "event_timestamp", "orders": "order_date", "reviews": "review_date"}
# Fields that a file may lack.
OPTIONAL = ("review_text",)
STATIC = {"users": schemas.USERS, "products": schemas.PRODUCTS}


def csv_schema(stream_type: str) -> T.StructType:
    """The columns of a source table: its fields in the envelope, and its time as text."""
    own = schemas.VARIANT_FIELDS[stream_type]
    fields = [f for f in schemas.DATA_FIELDS if f.name in own]
    time = TIME_COLUMNS.get(stream_type)
    return T.StructType([*fields, *([T.StructField(time, T.StringType())] if time else [])])


def derive_event_time(df: DataFrame, stream_type: str) -> DataFrame:
    """Replace a table's own time column by `event_time`; null where the text is no time."""
    time = TIME_COLUMNS.get(stream_type)
    if time is None:
        return df
    return df.withColumn("event_time", parse_timestamp(time).cast("timestamp_ntz")).drop(time)


def read_source_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """One table per stream type from `folder/<type>.csv` (a file or a folder of files); a missing
    one is empty."""
    found = {}
    for name in schemas.STREAM_TYPES:
        path, schema = f"{folder}/{name}.csv", csv_schema(name)
        df = read_csv_by_name(spark, path, schema, optional=OPTIONAL, missing_ok=True)
        found[name] = derive_event_time(df, name)
    return found


def csv_event_stream(
    spark: SparkSession, folder: str, batch_size: int, *, day: dt.date | None = None
) -> DataFrame:
    """Envelopes with a `batch_id` from the CSV files of a folder (see `build_event_stream`)."""
    return build_event_stream(read_source_tables(spark, folder), batch_size, day=day)


def land_csv(
    spark: SparkSession, folder: str, landing: str, stream: DataFrame, ingested_at: Column | None = None
) -> None:
    """Put a stream and the reference tables of `folder` into the landing folder of a lake.

    All are written with one record per line (`multi_line=False` and `static_multi_line=False`).
    A reference table that is missing or empty is not written.
    """
    write_json(landing_records(stream, ingested_at), f"{landing}/stream", "append")
    for name, schema in STATIC.items():
        df = read_csv_by_name(spark, f"{folder}/{name}.csv", schema, missing_ok=True)
        if not df.isEmpty():
            write_json(df, f"{landing}/static/{name}.json")
