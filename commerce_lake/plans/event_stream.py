"""Source tables to a time-ordered, batched stream of envelopes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.cleaning import format_timestamp, scrub_non_finite
from commerce_lake.operators.envelope import assign_batches, day_slice, stream_order, unify
from commerce_lake.operators.joins import HotKey, inherit_event_time, rows_of
from commerce_lake.schemas import STREAM_TYPES


def timed_tables(
    tables: Mapping[str, DataFrame], hot_orders: Sequence[HotKey] = ()
) -> dict[str, DataFrame]:
    """Give order items the event time of their order; the other tables have their own."""
    items = inherit_event_time(tables["order_items"], tables["orders"], "order_id", hot_orders)
    return {**tables, "order_items": items}


def tables_of_day(
    tables: Mapping[str, DataFrame], day: dt.date, hot_orders: Sequence[HotKey] = ()
) -> dict[str, DataFrame]:
    """Rows of one day; order items follow their orders."""
    kept = {
        name: day_slice(tables[name], "event_time", day)
        for name in STREAM_TYPES
        if name != "order_items"
    }
    items = rows_of(tables["order_items"], kept["orders"], "order_id", hot_orders)
    return timed_tables({**kept, "order_items": items}, hot_orders)


def build_event_stream(
    tables: Mapping[str, DataFrame],
    batch_size: int,
    *,
    day: dt.date | None = None,
    within: Sequence[str] = (),
    hot_orders: Sequence[HotKey] = (),
) -> DataFrame:
    """Envelopes with a `batch_id`, in time order, parents before children at equal time.

    Takes one table per stream type; all but `order_items` have a timestamp `event_time`. With
    `day` only that day is streamed. `within` restarts the batch numbers per value of a column.
    """
    timed = tables_of_day(tables, day, hot_orders) if day else timed_tables(tables, hot_orders)
    return assign_batches(scrub_non_finite(unify(timed)), batch_size, within=within)


def landing_records(
    stream: DataFrame,
    ingested_at: Column | None = None,
    pattern: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Envelopes as they are written to the landing folder: times as text.

    Fractions of a second are kept unless `pattern` says otherwise. `keep` names further columns.
    """
    time = F.col("event_time")
    text = time.cast("string") if pattern is None else format_timestamp(time, pattern)
    arrival = F.current_timestamp() if ingested_at is None else ingested_at
    return stream.select(
        "stream_type",
        text.alias("event_time"),
        format_timestamp(arrival).alias("ingestion_time"),
        "data",
        *keep,
    )


def write_batch_files(
    stream: DataFrame,
    path: str,
    ingested_at: Column | None = None,
    *,
    compression: str = "none",
) -> None:
    """One JSON array file per batch of a batched stream, its records in stream order.

    A batch is a single value while it is written; its length is the batch size of the stream.
    With `compression` (gzip, say) files take a tenth of the disk; Spark reads them all the same.
    """
    order = [c.alias(f"_order{n}") for n, c in enumerate(stream_order())]
    names = [f"_order{n}" for n in range(len(order))]
    placed = landing_records(stream.select("*", *order), ingested_at, keep=("batch_id", *names))
    record = F.struct("stream_type", "event_time", "ingestion_time", "data").alias("record")
    ordered = F.array_sort(F.collect_list(F.struct(*names, record)))
    arrays = placed.groupBy("batch_id").agg(
        F.to_json(F.transform(ordered, lambda r: r["record"]), {"ignoreNullFields": "false"})
    )
    writer = arrays.toDF("batch_id", "value").write.partitionBy("batch_id")
    writer.text(path, compression=compression)
