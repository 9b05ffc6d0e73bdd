"""Landing files to Bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake.functions.cleaning import parse_date
from commerce_lake.operators.quality import count_by
from commerce_lake.sinks.files import write_parquet, write_partitioned
from commerce_lake.sources.files import (
    EVENT_DATE,
    REJECTED,
    bronze_schema,
    read_envelopes,
    read_json_table,
)

#: Packing of the Bronze stream table: ids as text are most of it, and zstd takes less than snappy.
COMPRESSION = "zstd"


def bronze_rows(flat: DataFrame, by_date: bool = False) -> DataFrame:
    """Records of no known type go to a partition of their own instead of being lost."""
    rows = flat.withColumn("stream_type", F.coalesce("stream_type", F.lit(REJECTED)))
    return rows.withColumn(EVENT_DATE, parse_date("event_time")) if by_date else rows


def bronze_partitions(by_date: bool) -> list[str]:
    return ["stream_type", EVENT_DATE] if by_date else ["stream_type"]


def ingest_stream_bronze(
    spark: SparkSession,
    landing: str,
    bronze: str,
    *,
    multi_line: bool = True,
    by_date: bool = False,
) -> DataFrame | None:
    """Rebuild the Bronze stream table from all landing files; the files are parsed once.

    Returns the rows per stream type, counted from the written file footers. A landing folder
    without a single record leaves Bronze as it is and returns None. `by_date` adds the event
    day as a second partition level, which lets later runs read single days.
    """
    flat = read_envelopes(spark, landing, multi_line=multi_line)
    if flat.isEmpty():
        return None
    rows = bronze_rows(flat, by_date)
    if by_date:
        write_partitioned(
            rows, bronze, bronze_partitions(True), replace="static", allow_null=True
        )
    else:
        # Four folders: every task writes its own files, nothing is shuffled.
        writer = rows.write.mode("overwrite").partitionBy("stream_type")
        writer.parquet(bronze, compression=COMPRESSION)
    written = spark.read.schema(bronze_schema(by_date)).parquet(bronze)
    return count_by(written, "stream_type")


def ingest_static_bronze(
    spark: SparkSession, path: str, schema: T.StructType, bronze: str, *, multi_line: bool = True
) -> int:
    """Replace a Bronze reference table by a JSON file. Returns its rows; 0 leaves it as it is."""
    df = read_json_table(spark, path, schema, multi_line=multi_line)
    if df.isEmpty():
        return 0
    write_parquet(df, bronze)
    return spark.read.schema(schema).parquet(bronze).count()
