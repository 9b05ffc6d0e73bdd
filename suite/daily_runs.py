"""Whole daily runs: three deliveries, of which the later ones correct the earlier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.plans import daily
from commerce_lake.plans.day_index import DayIndex, arrivals
from commerce_lake.plans.event_stream import landing_records
from commerce_lake.plans.ratings import RatingState
from commerce_lake.shared import materialize
from commerce_lake.sinks.files import write_json
from commerce_lake.operators.envelope import flatten_envelope
from suite.entities import RETURNED, Tables, day_text, time_text
from suite.registry import query
from suite.star import EVENT_TYPE_ID, FIRST_DAY, LAST_DAY, STATUS_ID, id_case

# Records lie on the first day of their year here, so that the tables have few, large partitions.
_YEARLY = "CAST(date_trunc('year', CAST(event_time AS TIMESTAMP)) AS TIMESTAMP)"
_lakes: dict[tuple[str, str], daily.Lake] = {}


def _yearly(t: Tables) -> DataFrame:
    return t.envelopes().withColumn("event_time", F.date_trunc("year", "event_time").cast("timestamp_ntz"))


def _number(field: str):
    return F.col(f"data.{field}").cast("bigint")


def _is_wrong() -> Column:
    """Of each envelope, whether it is sent wrong at first; a record's id decides, or its order's."""
    kind = F.col("stream_type")
    wrong = (
        ((kind == "orders") & (_number("order_id") % 5 == 0))
        | ((kind == "events") & (_number("event_id") % 4 == 0))
        | ((kind == "order_items") & (_number("order_id") % 7 == 0))
    )
    return F.coalesce(wrong, F.lit(False))


def _mistaken(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that are sent wrong at first, and how: in a later year, with another status or type,
    items under another order."""
    kind = F.col("stream_type")
    moved = (F.col("event_time") + F.expr("INTERVAL 1 YEAR")).cast("timestamp_ntz")
    data = (
        F.col("data")
        .withField("order_status", F.when(kind == "orders", F.lit("P")))
        .withField("event_type", F.when(kind == "events", F.lit("view")))
        .withField("order_id", F.when(kind == "order_items", F.lit("1")).otherwise(F.col("data.order_id")))
    )
    right = envelopes.where(_is_wrong())
    return right, right.withColumns({"event_time": moved, "data": data})


def lake_after_three_runs(t: Tables) -> daily.Lake:
    """Delivered: everything, with mistakes and old prices; the right records; the right prices."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key in _lakes:
        return _lakes[key]
    root = t.new_path("lake")
    name = root.rpartition("/")[2].replace("-", "_")
    lake = daily.Lake(
        f"{root}/landing", root, f"gold_{name}", f"house_{name}", archive=f"{root}/archived",
        multi_line=False, static_multi_line=False, first_day=FIRST_DAY, last_day=LAST_DAY,
        returned_label=RETURNED, index_buckets=16,
    )
    envelopes = _yearly(t)
    right, mistaken = _mistaken(envelopes)
    first = envelopes.where(~_is_wrong()).unionByName(mistaken)
    old = t.products().withColumn("price", F.when(F.col("product_id").cast("bigint") % 3 == 0, F.col("price") * 2).otherwise(F.col("price")))

    def deliver(rows: DataFrame | None, day: str, **static: DataFrame) -> None:
        if rows is not None:
            arrived = F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
            write_json(landing_records(rows, arrived), lake.stream_landing, "append")
        for table, df in static.items():
            write_json(df, lake.static_landing(table))
        daily.run_daily(t.spark, lake)

    deliver(first, "2024-02-01", users=t.users(), products=old)
    deliver(right, "2024-02-02")
    deliver(None, "2024-02-03", products=t.products())
    _lakes[key] = lake
    return lake


@query(
    "daily_equals_full_orders",
    f"""
    WITH shop AS (SELECT * REPLACE ({_YEARLY} AS event_time) FROM shop_orders)
    SELECT i.order_item_id, order_id, o.user_id, product_id,
           {day_text('o.event_time')} AS order_date_id,
           {id_case('o.order_status', STATUS_ID)} AS status_id,
           {time_text('o.event_time')} AS order_timestamp,
           i.quantity, i.item_price, p.price AS list_price,
           round(i.item_price * i.quantity, 2) AS line_total, o.total_amount,
           CAST(o.order_status = '{RETURNED}' AS INTEGER) AS is_returned
    FROM (SELECT * FROM items QUALIFY row_number() OVER (
              PARTITION BY order_item_id ORDER BY product_id, quantity, item_price) = 1) i
    JOIN shop o USING (order_id) LEFT JOIN products p USING (product_id)
    """,
    "items",
    "shop_orders",
    "products",
)
def daily_equals_full_orders(t: Tables) -> DataFrame:
    """After moved orders and items and changed prices, the facts are those of a full build."""
    return daily.gold_tables(t.spark, lake_after_three_runs(t))["fact_orders"].drop("gold_created_at")


@query(
    "daily_equals_full_events",
    f"""
    SELECT event_id, user_id, product_id, {day_text(_YEARLY)} AS event_date_id,
           {id_case('event_type', EVENT_TYPE_ID)} AS event_type_id,
           {id_case('event_type', EVENT_TYPE_ID)} AS funnel_step,
           {time_text(_YEARLY)} AS event_timestamp
    FROM shop_events
    WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL
    """,
    "shop_events",
)
def daily_equals_full_events(t: Tables) -> DataFrame:
    return daily.gold_tables(t.spark, lake_after_three_runs(t))["fact_events"].drop("gold_created_at")


@query(
    "daily_warehouse",
    """
    SELECT 'DIM_USERS' AS table_name, count(*) AS row_count FROM users
    UNION ALL SELECT 'DIM_PRODUCTS', count(*) FROM products
    UNION ALL SELECT 'DIM_ORDER_STATUS', count(DISTINCT order_status) FROM shop_orders
    UNION ALL SELECT 'DIM_EVENT_TYPE', count(DISTINCT event_type) FROM shop_events
    UNION ALL SELECT 'FACT_ORDERS', count(DISTINCT order_item_id) FROM items JOIN shop_orders USING (order_id)
    UNION ALL SELECT 'FACT_EVENTS', count(*) FROM shop_events
        WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL
    """,
    "users",
    "products",
    "shop_orders",
    "shop_events",
    "items",
)
def daily_warehouse(t: Tables) -> DataFrame:
    """Rows of the published tables: each key once, however often its record came."""
    lake = lake_after_three_runs(t)
    names = ("DIM_USERS", "DIM_PRODUCTS", "DIM_ORDER_STATUS", "DIM_EVENT_TYPE", "FACT_ORDERS", "FACT_EVENTS")
    return daily.table_summary({n: t.spark.table(f"{lake.warehouse_database}.{n}") for n in names})


@query(
    "daily_ratings",
    """
    SELECT product_id, round(avg(rating), 2) AS avg_rating, count(review_id) AS review_count
    FROM (SELECT * FROM reviews QUALIFY row_number() OVER (
              PARTITION BY review_id ORDER BY product_id, rating) = 1)
    WHERE rating IS NOT NULL GROUP BY product_id
    """,
    "reviews",
)
def daily_ratings(t: Tables) -> DataFrame:
    """Ratings by signed changes: some reviews came first with another rating, for another product."""
    state = RatingState(t.new_path("ratings"), 16)
    rows = t.envelopes().where("stream_type = 'reviews'")
    data, product = F.col("data"), _number("product_id")
    wrong = rows.where(product % 3 == 0).withColumn(
        "data", data.withField("rating", F.col("data.rating") - 1).withField("product_id", (product + 1).cast("string"))
    )
    deliveries = [wrong, rows.where(product % 3 != 0), rows.where(product % 3 == 0)]
    for number, delivery in enumerate(deliveries):
        arrived = F.lit(f"2024-02-0{number + 1} 00:00:00").cast("timestamp_ntz")
        state.add(materialize(flatten_envelope(landing_records(delivery, arrived)), "reviews"), number)
    return state.ratings(t.spark)


@query(
    "day_index_links",
    f"""
    WITH m AS (SELECT DISTINCT CAST({_YEARLY} AS DATE) AS day FROM shop_orders
               WHERE CAST(order_id AS BIGINT) % 5 = 0),
    p AS (SELECT day, CAST(day + INTERVAL 1 YEAR AS DATE) AS other FROM m)
    SELECT {day_text('day')} AS day, {day_text('other')} AS other FROM p
    UNION SELECT {day_text('other')}, {day_text('day')} FROM p
    """,
    "shop_orders",
)
def day_index_links(t: Tables) -> DataFrame:
    """Days that orders were moved between, from two additions to an index."""
    index = DayIndex(t.new_path("day_index"), 16)
    right, mistaken = _mistaken(_yearly(t).where("stream_type = 'orders'"))
    for rows in (mistaken, right):
        flat = flatten_envelope(rows.withColumn("event_time", F.col("event_time").cast("string")))
        index.add(materialize(arrivals(flat), "arrived"))
    return index.links(t.spark, "orders").distinct()
