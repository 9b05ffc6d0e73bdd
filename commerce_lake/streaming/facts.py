"""Fact tables kept up to date from a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from commerce_lake import schemas
from commerce_lake.plans.bronze import bronze_partitions, bronze_rows
from commerce_lake.shared import INTERMEDIATE, new_folder
from commerce_lake.sinks import folders
from commerce_lake.sinks.files import write_partitioned
from commerce_lake.sinks.publish import append_fact
from commerce_lake.sources.files import EVENT_DATE, REJECTED
from commerce_lake.streaming.pending import PendingLog

_DAYS = schemas.columns("day date")


def start_append(
    stream: DataFrame,
    table: str,
    key: str,
    checkpoint: str,
    *,
    date_column: str | None = None,
    key_implies_date: bool = False,
) -> StreamingQuery:
    """Append rows with new keys to a catalog table; a replayed micro-batch appends nothing."""

    def append(batch: DataFrame, batch_id: int) -> None:
        append_fact(
            batch, table, key, date_column=date_column, key_implies_date=key_implies_date
        )

    return _start(stream, append, checkpoint)


def start_landing(
    stream: DataFrame, bronze: str, checkpoint: str, note: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Land each micro-batch in Bronze (by day), after `note` has seen its rows and number.

    The rows are written once, so files are parsed once whatever the size of the batch, and lost
    executors cost no second parsing. Rejected records are not shown to `note`. A replayed
    micro-batch lands its rows again; the builders drop such repeats.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        spark, place = batch.sparkSession, new_folder(batch.sparkSession, "landed")
        rows = bronze_rows(batch, by_date=True)
        try:
            rows.write.parquet(place, compression=INTERMEDIATE)
            written = spark.read.schema(rows.schema).parquet(place)
            note(written.where(F.col("stream_type") != REJECTED), batch_id)
            write_partitioned(
                written, bronze, bronze_partitions(True), replace="append", allow_null=True
            )
        finally:
            folders.remove(spark, place)

    return _start(stream, land, checkpoint)


def rebuild_late_days(
    stream: DataFrame,
    bronze: str,
    checkpoint: str,
    log: PendingLog,
    rebuild: Callable[[DataFrame], None],
) -> None:
    """Land all micro-batches that are there, then rebuild the days that they touched, once.

    `rebuild` gets the days as a table (`day`; null for records without a readable time). It must
    read *all* Bronze rows of these days, so that a late row never replaces a full day by a partial
    one. Days are logged before they are landed and forgotten after the rebuild: a run that fails in
    between is made up for by the next.
    """

    def note(rows: DataFrame, batch_id: int) -> None:
        log.add(f"batch-{batch_id}", rows.select(F.col(EVENT_DATE).alias("day")).distinct())

    start_landing(stream, bronze, checkpoint, note).awaitTermination()
    spark = stream.sparkSession
    names = log.names(spark)
    days = log.read(spark, names, _DAYS).distinct()
    if not days.isEmpty():
        rebuild(days)
    log.clear(spark, names)


def _start(
    stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
