"""Writing files and tables, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.plans import gold
from commerce_lake.plans.event_stream import landing_records
from commerce_lake.schemas import DIM_USERS
from commerce_lake.sinks import files
from commerce_lake.sinks.key_filter import KeyFilter
from commerce_lake.sinks.pointer import read_current, write_current
from commerce_lake.sinks.publish import Fact, append_fact, publish_dimension, publish_fact
from commerce_lake.sources.files import read_bronze, read_envelopes
from suite.entities import FLAT, Tables, as_text, day_text
from suite.registry import query
from suite.scans import FLAT_COLUMNS
from suite.star import DATE_SQL, PRODUCTS_SQL, dim_date_of, dim_products_of

CORRECTED_FROM = "2024-01-15"


@query("sink_parquet_roundtrip", "SELECT user_id, name, email, gender, city FROM users", "users")
def sink_parquet_roundtrip(t: Tables) -> DataFrame:
    path = t.new_path("dim_users")
    files.write_parquet(gold.build_dim_users(t.users()), path)
    return t.spark.read.parquet(path)


@query(
    "sink_partitioned_by_type",
    """
    SELECT stream_type, count(*) AS row_count, count(user_id) AS with_user,
           sum(quantity)::BIGINT AS quantity
    FROM stream GROUP BY stream_type
    """,
    "stream",
)
def sink_partitioned_by_type(t: Tables) -> DataFrame:
    return (
        read_bronze(t.spark, t.bronze())
        .groupBy("stream_type")
        .agg(
            F.count("*").alias("row_count"),
            F.count("user_id").alias("with_user"),
            F.sum("quantity").alias("quantity"),
        )
    )


def _rewritten(t: Tables, replace: str) -> DataFrame:
    """All events by day, then the days from CORRECTED_FROM on written again with other values."""
    events = t.raw("events").select(
        "event_id", "event_type", "value", F.col("ts").cast("date").alias("day")
    )
    path = t.new_path("events_by_day")
    files.write_partitioned(events, path, ["day"])
    corrected = events.where(F.col("day") >= F.lit(CORRECTED_FROM).cast("date"))
    files.write_partitioned(
        corrected.withColumn("value", F.col("value") * 2), path, ["day"], replace=replace
    )
    return t.spark.read.schema(events.schema).parquet(path)


@query(
    "sink_dynamic_partition_overwrite",
    f"""
    SELECT event_id, event_type, {day_text('ts')} AS day,
           CASE WHEN ts >= TIMESTAMP '{CORRECTED_FROM}' THEN value * 2 ELSE value END AS value
    FROM events
    """,
)
def sink_dynamic_partition_overwrite(t: Tables) -> DataFrame:
    return _rewritten(t, "dynamic")


@query(
    "sink_static_partition_overwrite",
    f"""
    SELECT event_id, event_type, {day_text('ts')} AS day, value * 2 AS value
    FROM events WHERE ts >= TIMESTAMP '{CORRECTED_FROM}'
    """,
)
def sink_static_partition_overwrite(t: Tables) -> DataFrame:
    return _rewritten(t, "static")


@query("dim_date_sorted", f"{DATE_SQL} ORDER BY 1", "stream")
def dim_date_sorted(t: Tables) -> DataFrame:
    path = t.new_path("dim_date")
    files.write_sorted(dim_date_of(t), path, "date_id")
    return t.spark.read.parquet(path)


@query("sink_json_envelope", f"SELECT {FLAT} FROM stream", "stream")
def sink_json_envelope(t: Tables) -> DataFrame:
    """All four stream types, written and read back."""
    path = t.new_path("json")
    files.write_json(landing_records(t.envelopes()), path)
    return read_envelopes(t.spark, path, multi_line=False).select(*FLAT_COLUMNS)


@query("publish_dimension", PRODUCTS_SQL, "products", "reviews")
def publish_dimension_twice(t: Tables) -> DataFrame:
    """A first version without ratings, replaced by the full one."""
    database = t.new_database("warehouse")
    full = dim_products_of(t)
    publish_dimension(full.withColumn("review_count", F.lit(0)), database, "dim_products")
    publish_dimension(full, database, "dim_products")
    return t.spark.table(f"{database}.dim_products")


@query("fact_incremental_append", "SELECT event_id, user_id, event_type FROM shop_events", "shop_events")
def fact_incremental_append(t: Tables) -> DataFrame:
    """Some of the events are loaded before all of them are, and then all of them again."""
    table = f"{t.new_database('facts')}.fact_events"
    rows = as_text(t.events()).select("event_id", "user_id", "event_type")
    append_fact(rows.where("event_type IN ('view', 'click')"), table, "event_id")
    append_fact(rows, table, "event_id")
    append_fact(rows, table, "event_id")
    return t.spark.table(table)


@query(
    "append_by_key_filter",
    f"SELECT event_id, event_type, {day_text('event_time')} AS day FROM shop_events",
    "shop_events",
)
def append_by_key_filter(t: Tables) -> DataFrame:
    """Events of two types, then all of them under the next day, then all of them: keys are found on
    whatever day they were published under."""
    table, kept = f"{t.new_database('filtered')}.fact_events", KeyFilter(t.new_path("key_filter"))
    rows = t.events().withColumn("day", F.col("event_time").cast("date")).select("event_id", "event_type", "day")
    options = {"date_column": "day", "key_filter": kept}
    early = rows.where("event_type IN ('view', 'click')")
    append_fact(early, table, "event_id", **options)
    append_fact(early.withColumn("day", F.date_add("day", 1)), table, "event_id", **options)
    append_fact(rows, table, "event_id", **options)
    return t.spark.table(table)


@query("sink_guarded_replacement", "SELECT user_id, name, email, gender, city FROM users", "users")
def sink_guarded_replacement(t: Tables) -> DataFrame:
    """A dimension at a path: half of it, then all, then an empty and a failing replacement."""
    users, path = gold.build_dim_users(t.users()), t.new_path("dim_users")
    write_current(users.where("CAST(user_id AS BIGINT) % 2 = 0"), path)
    write_current(users, path)
    write_current(users.where("false"), path)
    try:
        write_current(users.withColumn("name", F.raise_error(F.lit("broken")).cast("string")), path)
    except Exception as error:
        if "broken" not in str(error):
            raise
    return read_current(t.spark, path, DIM_USERS)


@query(
    "append_after_schema_change",
    f"""
    SELECT event_id, user_id, event_type, product_id, {day_text('event_time')} AS day
    FROM shop_events
    """,
    "shop_events",
)
def append_after_schema_change(t: Tables) -> DataFrame:
    """A fact without products is published, then one with products fails half-way, is filled from
    all days, and gets the rest day by day."""
    database, fact = t.new_database("changed"), Fact("fact_events", "event_id", "day")
    rows = t.events().withColumn("day", F.col("event_time").cast("date"))
    wide = rows.select("event_id", "user_id", "event_type", "product_id", "day")
    early = wide.where("event_type IN ('view', 'click')")
    publish_fact(early.drop("product_id"), database, fact)
    broken = F.when(F.col("event_type") == "click", F.raise_error(F.lit("broken")).cast("string"))
    try:
        publish_fact(early.withColumn("product_id", broken), database, fact)
    except Exception as error:
        if "broken" not in str(error):
            raise
    publish_fact(early, database, fact)
    publish_fact(wide, database, fact, wide.where("event_type = 'signup'").select("day").distinct())
    publish_fact(wide, database, fact)
    return t.spark.table(f"{database}.FACT_EVENTS")
