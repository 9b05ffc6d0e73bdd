"""The landing folder as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from commerce_lake.functions.cleaning import format_timestamp, parse_timestamp
from commerce_lake.plans.bronze import bronze_partitions, bronze_rows
from commerce_lake.sources.files import envelope_columns, envelope_file_schema


def read_landing(
    spark: SparkSession,
    landing: str,
    *,
    multi_line: bool = True,
    max_files: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New landing files as a stream of flat rows, at most `max_files` per micro-batch.

    With `archive` (a folder outside of `landing`) files are moved there once a later batch has
    been committed. Records without an ingestion time get the current one.
    """
    reader = spark.readStream.schema(envelope_file_schema()).option("multiLine", multi_line)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    arrival = F.coalesce("ingestion_time", format_timestamp(F.current_timestamp()))
    return envelope_columns(reader.json(landing)).withColumn("ingestion_time", arrival)


def start_bronze(
    stream: DataFrame, bronze: str, checkpoint: str, *, by_date: bool = False
) -> StreamingQuery:
    """Append everything that has arrived to Bronze, exactly once, and stop."""
    return (
        bronze_rows(stream, by_date)
        .writeStream.format("parquet")
        .partitionBy(*bronze_partitions(by_date))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(bronze)
    )


def drop_repeats(stream: DataFrame, key: str, delay: str) -> DataFrame:
    """Drop records whose key was seen up to `delay` ago in event time.

    Keeps bounded state. Repeats that arrive later pass and are caught by the keyed append.
    """
    timed = stream.withColumn("_event_timestamp", parse_timestamp("event_time"))
    return (
        timed.withWatermark("_event_timestamp", delay)
        .dropDuplicatesWithinWatermark([key])
        .drop("_event_timestamp")
    )
