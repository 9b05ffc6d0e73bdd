"""The batched event stream, Structured Streaming and the daily run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake import schemas
from commerce_lake.operators.envelope import assign_batches, batch_type_counts
from commerce_lake.operators.envelope import record_id as id_of
from commerce_lake.operators.quality import table_summary
from commerce_lake.plans import gold
from commerce_lake.plans.csv_entry import TIME_COLUMNS, csv_event_stream
from commerce_lake.plans.event_stream import (
    build_event_stream,
    landing_records,
    write_batch_files,
)
from commerce_lake.sinks.files import packed, write_json, write_partitioned
from commerce_lake.sources.files import read_bronze, read_envelopes, split_bronze
from commerce_lake.streaming.facts import rebuild_late_days, start_append
from commerce_lake.streaming.landing import read_landing, start_bronze
from commerce_lake.streaming.pending import PendingLog
from suite.entities import FLAT, LOADED_AT, Tables, as_text
from suite.registry import query
from suite.scans import FLAT_COLUMNS
from suite.star import FACT_EVENTS_SQL, FIRST_DAY, LAST_DAY, loaded_at

BATCH = 200
_ORDER = "ORDER BY event_time, priority, record_id"
_IN_STREAM = f"CAST((row_number() OVER ({_ORDER}) - 1) // {BATCH} AS BIGINT)"


@query(
    "event_stream_batched",
    f"""
    SELECT {_IN_STREAM} AS batch_id, {FLAT}, record_id FROM stream
    """,
    "stream",
)
def event_stream_batched(t: Tables) -> DataFrame:
    stream = build_event_stream(t.source_tables(), BATCH)
    return stream.select("batch_id", "stream_type", "event_time", "data.*", id_of().alias("record_id"))


@query("csv_to_event_stream", f"SELECT {_IN_STREAM} AS batch_id, {FLAT} FROM stream", "stream")
def csv_to_event_stream(t: Tables) -> DataFrame:
    """The source tables as CSV files, each with its own time column, orders under two headers."""
    folder = t.new_path("csv_source")
    for name, table in t.source_tables().items():
        time = TIME_COLUMNS.get(name)
        named = table if time is None else as_text(table).withColumnRenamed("event_time", time)
        halves = [named]
        if name == "orders":
            even = F.col("order_id").cast("bigint") % 2 == 0
            halves = [named.where(even), named.where(~even).select(*reversed(named.columns))]
        for k, half in enumerate(halves):
            packed(half.write).csv(f"{folder}/{name}.csv/{k}", header=True)
    return csv_event_stream(t.spark, folder, BATCH).select("batch_id", "stream_type", "event_time", "data.*")


@query(
    "assign_batches",
    f"""
    SELECT strftime(event_time, '%Y-%m-%d') AS day, record_id,
           CAST((row_number() OVER (PARTITION BY CAST(event_time AS DATE) {_ORDER}) - 1)
                // {BATCH} AS BIGINT) AS batch_id
    FROM stream
    """,
    "stream",
)
def assign_batches_per_day(t: Tables) -> DataFrame:
    daily = t.envelopes().withColumn("day", F.col("event_time").cast("date"))
    return assign_batches(daily, BATCH, within=["day"]).select(
        "day", id_of().alias("record_id"), "batch_id"
    )


@query(
    "batch_type_counts",
    f"""
    SELECT batch_id, {', '.join(
        f"count(*) FILTER (stream_type = '{n}') AS {n}_count" for n in schemas.STREAM_TYPES)}
    FROM (SELECT {_IN_STREAM} AS batch_id, stream_type FROM stream) GROUP BY batch_id
    """,
    "stream",
)
def counts_per_batch(t: Tables) -> DataFrame:
    return batch_type_counts(build_event_stream(t.source_tables(), BATCH))


@query("sink_json_batches", f"SELECT {FLAT} FROM stream", "stream")
def sink_json_batches(t: Tables) -> DataFrame:
    """Array files of one batch each, read back as multi-line JSON."""
    path = t.new_path("batches")
    stream = build_event_stream(t.source_tables(), BATCH)
    write_batch_files(stream, path, compression="gzip")
    return read_envelopes(t.spark, path).select(*FLAT_COLUMNS)


@query("stream_ingest_envelope", f"SELECT {FLAT} FROM stream", "stream")
def stream_ingest_envelope(t: Tables) -> DataFrame:
    bronze = t.new_path("streamed_bronze")
    arrivals = read_landing(t.spark, t.landing(), multi_line=False, max_files=4)
    start_bronze(arrivals, bronze, t.new_path("state")).awaitTermination()
    return read_bronze(t.spark, bronze).select(*FLAT_COLUMNS)


def _deliver(t: Tables, rows: DataFrame, landing: str) -> None:
    """Add envelope files to a landing folder."""
    write_json(landing_records(rows, F.lit(LOADED_AT).cast("timestamp_ntz")), landing, "append")


@query(
    "stream_dedup_append",
    "SELECT event_id, user_id, product_id, event_type FROM shop_events",
    "shop_events",
)
def stream_dedup_append(t: Tables) -> DataFrame:
    """Every event arrives twice, and the second delivery is a stream of its own."""
    table = f"{t.new_database('streamed')}.fact_events"
    landing, state = t.new_path("landing_twice"), t.new_path("state")
    events = t.envelopes().where("stream_type = 'events'")
    for _ in range(2):
        _deliver(t, events, landing)
        arrivals = read_landing(t.spark, landing, multi_line=False)
        rows = arrivals.select(*schemas.VARIANT_FIELDS["events"])
        start_append(rows, table, "event_id", state).awaitTermination()
    return t.spark.table(table)


@query("stream_late_partition_rebuild", FACT_EVENTS_SQL, "shop_events")
def stream_late_partition_rebuild(t: Tables) -> DataFrame:
    """Sign-ups arrive after the days they belong to were written."""
    landing, bronze = t.new_path("landing_late"), t.new_path("bronze_by_day")
    fact, state = t.new_path("fact_events"), t.new_path("state")
    log = PendingLog(t.new_path("late_days"))

    def rebuild(days) -> None:
        rows = read_bronze(t.spark, bronze, "events", by_date=True, dates=days)
        built = gold.build_fact_events(rows, loaded_at=loaded_at())
        write_partitioned(built, fact, ["event_date_id"])

    events = t.envelopes().where("stream_type = 'events'")
    late = F.col("data.event_type") == "signup"
    for part in (events.where(~late), events.where(late)):
        _deliver(t, part, landing)
        arrivals = read_landing(t.spark, landing, multi_line=False)
        rebuild_late_days(arrivals, bronze, state, log, rebuild)
    written = t.spark.read.schema(schemas.FACT_EVENTS).parquet(fact)
    return written.select(*schemas.FACT_EVENTS.names)


@query(
    "gold_summary",
    f"""
    SELECT 'dim_users' AS table_name, count(*) AS row_count FROM users
    UNION ALL SELECT 'dim_products', count(*) FROM products
    UNION ALL SELECT 'dim_date', count(DISTINCT CAST(event_time AS DATE)) FROM stream
        WHERE event_time >= TIMESTAMP '{FIRST_DAY}' AND event_time < TIMESTAMP '2025-01-01'
    UNION ALL SELECT 'dim_order_status', count(DISTINCT order_status) FROM shop_orders
    UNION ALL SELECT 'dim_event_type', count(DISTINCT event_type) FROM shop_events
    UNION ALL SELECT 'fact_orders', count(DISTINCT order_item_id) FROM items
    UNION ALL SELECT 'fact_events', count(*) FROM shop_events
    """,
    "users",
    "products",
    "stream",
)
def gold_summary(t: Tables) -> DataFrame:
    """Row counts of the Gold tables built from Bronze."""
    bronze = split_bronze(t.spark, t.bronze())
    products = gold.build_dim_products(t.products(), bronze["reviews"])
    days = gold.event_days(*bronze.values())
    return table_summary(
        {
            "dim_users": gold.build_dim_users(t.users()),
            "dim_products": products,
            "dim_date": gold.build_dim_date(days, FIRST_DAY, LAST_DAY),
            "dim_order_status": gold.build_dim_order_status(bronze["orders"]),
            "dim_event_type": gold.build_dim_event_type(bronze["events"]),
            "fact_orders": gold.build_fact_orders(
                bronze["order_items"], bronze["orders"], products
            ),
            "fact_events": gold.build_fact_events(bronze["events"]),
        }
    )
