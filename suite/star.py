"""The Gold star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake import schemas
from commerce_lake.operators.joins import find_hot_keys, plan_lookup
from commerce_lake.operators.quality import (
    fail_on_collisions, fail_on_orphans, key_collisions, orphan_keys,
)
from commerce_lake.plans import gold
from commerce_lake.plans.bronze import ingest_static_bronze
from commerce_lake.plans.event_stream import timed_tables
from commerce_lake.sinks.files import write_json
from commerce_lake.sinks.versions import write_version
from commerce_lake.sources.files import read_bronze, split_bronze
from suite.entities import FLAT, LOADED_AT, RETURNED, Tables, as_text, day_text, time_text
from suite.registry import query
from suite.scans import FLAT_COLUMNS

FIRST_DAY = dt.date(1995, 1, 1)
LAST_DAY = dt.date(2024, 12, 31)

# Spark's 32-bit hash of these texts, made non-negative.
STATUS_ID = {"F": 530981620, "O": 231167322, "P": 957036563}
EVENT_TYPE_ID = {
    "click": 220218281,
    "error": 619812333,
    "purchase": 1482606664,
    "signup": 1255794960,
    "view": 1617517293,
}


def id_case(column: str, ids: dict[str, int]) -> str:
    branches = " ".join(f"WHEN '{k}' THEN {v}" for k, v in ids.items())
    return f"CAST(CASE {column} {branches} END AS INTEGER)"


DATE_COLUMNS = f"""
    {day_text('d')} AS date_id, CAST(year(d) AS INTEGER) AS year,
    CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
    dayname(d) AS day_name, monthname(d) AS month_name, dayofweek(d) IN (0, 6) AS is_weekend
"""
DATE_SQL = f"""
    SELECT {DATE_COLUMNS}
    FROM (SELECT DISTINCT CAST(event_time AS DATE) AS d FROM stream)
    WHERE d BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'
"""
PRODUCTS_SQL = """
    SELECT product_id, product_name, category, price AS list_price, brand,
           coalesce(avg_rating, 0.0) AS avg_rating, coalesce(review_count, 0) AS review_count
    FROM products LEFT JOIN (
        SELECT product_id, round(avg(rating), 2) AS avg_rating, count(review_id) AS review_count
        FROM (SELECT * FROM reviews QUALIFY row_number() OVER (
                  PARTITION BY review_id ORDER BY product_id, rating) = 1)
        WHERE rating IS NOT NULL GROUP BY product_id
    ) USING (product_id)
"""
FACT_ORDERS_SQL = f"""
    SELECT i.order_item_id, order_id, o.user_id, product_id,
           {day_text('o.event_time')} AS order_date_id,
           {id_case('o.order_status', STATUS_ID)} AS status_id,
           {time_text('o.event_time')} AS order_timestamp,
           i.quantity, i.item_price, p.price AS list_price,
           round(i.item_price * i.quantity, 2) AS line_total, o.total_amount,
           CAST(o.order_status = '{RETURNED}' AS INTEGER) AS is_returned,
           '{LOADED_AT}' AS gold_created_at
    FROM (SELECT * FROM items QUALIFY row_number() OVER (
              PARTITION BY order_item_id ORDER BY product_id, quantity, item_price) = 1) i
    JOIN shop_orders o USING (order_id) LEFT JOIN products p USING (product_id)
"""
FACT_EVENTS_SQL = f"""
    SELECT event_id, user_id, product_id, {day_text('event_time')} AS event_date_id,
           {id_case('event_type', EVENT_TYPE_ID)} AS event_type_id,
           {id_case('event_type', EVENT_TYPE_ID)} AS funnel_step,
           {time_text('event_time')} AS event_timestamp,
           '{LOADED_AT}' AS gold_created_at
    FROM shop_events
    WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL
"""


def loaded_at():
    return F.lit(LOADED_AT).cast("timestamp")


def dim_date_of(t: Tables) -> DataFrame:
    tables = timed_tables(t.source_tables())
    days = gold.event_days(*[as_text(df) for df in tables.values()])
    return gold.build_dim_date(days, FIRST_DAY, LAST_DAY)


def dim_products_of(t: Tables) -> DataFrame:
    return gold.build_dim_products(t.products(), as_text(t.reviews()))


def fact_orders_from(t: Tables, items: DataFrame, orders: DataFrame) -> DataFrame:
    products, rows = t.products(), items.count()
    prices, hot_products = plan_lookup(
        items, rows, gold.list_prices(products), products.count(), "product_id"
    )
    return gold.build_fact_orders(
        items,
        orders,
        prices,
        returned_label=RETURNED,
        hot_orders=find_hot_keys(items, "order_id", rows=rows),
        hot_products=hot_products,
        loaded_at=loaded_at(),
    )


def fact_orders_of(t: Tables) -> DataFrame:
    return fact_orders_from(t, t.items(), as_text(t.orders()))


@query("fact_orders", FACT_ORDERS_SQL, "items", "shop_orders", "products")
def fact_orders(t: Tables) -> DataFrame:
    return schemas.require_schema(fact_orders_of(t), schemas.FACT_ORDERS)


@query("fact_events", FACT_EVENTS_SQL, "shop_events")
def fact_events(t: Tables) -> DataFrame:
    built = gold.build_fact_events(as_text(t.events()), loaded_at=loaded_at())
    return schemas.require_schema(built, schemas.FACT_EVENTS)


@query("fact_events_gated", FACT_EVENTS_SQL, "shop_events")
def fact_events_gated(t: Tables) -> DataFrame:
    """The same facts, held against the event types and days of all events as they are read."""
    events = as_text(t.events())
    types = gold.build_dim_event_type(events)
    types = fail_on_collisions(types, "event_type_id", "event_type_name")
    days = gold.build_dim_date(gold.event_days(events))
    facts = gold.build_fact_events(events, loaded_at=loaded_at())
    facts = fail_on_orphans(facts, "event_type_id", types, "event_type_id")
    return fail_on_orphans(facts, "event_date_id", days, "date_id")


@query("fact_orders_from_bronze", FACT_ORDERS_SQL, "items", "shop_orders", "products")
def fact_orders_from_bronze(t: Tables) -> DataFrame:
    """The same facts after a round trip through landing files and Bronze."""
    bronze = split_bronze(t.spark, t.bronze())
    return fact_orders_from(t, bronze["order_items"], bronze["orders"])


@query("fact_events_from_bronze", FACT_EVENTS_SQL, "shop_events")
def fact_events_from_bronze(t: Tables) -> DataFrame:
    events = split_bronze(t.spark, t.bronze())["events"]
    return gold.build_fact_events(events, loaded_at=loaded_at())


@query("dim_users", "SELECT user_id, name, email, gender, city FROM users", "users")
def dim_users(t: Tables) -> DataFrame:
    return schemas.require_schema(gold.build_dim_users(t.users()), schemas.DIM_USERS)


@query("dim_products", PRODUCTS_SQL, "products", "reviews")
def dim_products(t: Tables) -> DataFrame:
    return schemas.require_schema(dim_products_of(t), schemas.DIM_PRODUCTS)


@query("dim_date", DATE_SQL, "stream")
def dim_date(t: Tables) -> DataFrame:
    return schemas.require_schema(dim_date_of(t), schemas.DIM_DATE)


@query(
    "dim_date_merged",
    f"""
    SELECT {DATE_COLUMNS}
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
          UNION SELECT CAST(ts AS DATE) FROM events)
    """,
)
def dim_date_merged(t: Tables) -> DataFrame:
    """The days of the orders are stored first; those of the events are merged in."""
    name = f"{t.new_database('dates')}.dim_date"
    for days in (t.orders(), t.events()):
        new = gold.build_dim_date(gold.event_days(as_text(days)), FIRST_DAY, LAST_DAY)
        if t.spark.catalog.tableExists(name):
            new = gold.merge_dim_date(t.spark.table(name), new)
        write_version(new.orderBy("date_id"), name)
    return t.spark.table(name)


@query(
    "dim_order_status",
    f"""
    SELECT DISTINCT {id_case('order_status', STATUS_ID)} AS status_id, order_status
    FROM shop_orders
    """,
    "shop_orders",
)
def dim_order_status(t: Tables) -> DataFrame:
    return gold.build_dim_order_status(t.orders())


@query(
    "dim_event_type",
    f"""
    SELECT DISTINCT {id_case('event_type', EVENT_TYPE_ID)} AS event_type_id,
           event_type AS event_type_name
    FROM shop_events
    """,
    "shop_events",
)
def dim_event_type(t: Tables) -> DataFrame:
    return gold.build_dim_event_type(t.events())


@query("bronze_stream", f"SELECT {FLAT} FROM stream", "stream")
def bronze_stream(t: Tables) -> DataFrame:
    return read_bronze(t.spark, t.bronze()).select(*FLAT_COLUMNS)


@query("bronze_static", "SELECT * FROM users", "users")
def bronze_static(t: Tables) -> DataFrame:
    landing, bronze = t.new_path("users_json"), t.new_path("users")
    write_json(t.users(), landing)
    ingest_static_bronze(t.spark, landing, schemas.USERS, bronze, multi_line=False)
    return t.spark.read.schema(schemas.USERS).parquet(bronze)


@query(
    "agg_product_ratings",
    """
    SELECT product_id, round(avg(rating), 2) AS avg_rating, count(review_id) AS review_count
    FROM reviews WHERE rating IS NOT NULL GROUP BY product_id
    """,
    "reviews",
)
def agg_product_ratings(t: Tables) -> DataFrame:
    return gold.product_ratings(t.reviews())


@query(
    "fk_orphans",
    f"""
    SELECT {day_text('event_time')} AS orphan_key, count(DISTINCT order_item_id) AS fact_rows
    FROM items WHERE event_time >= TIMESTAMP '2000-01-01' GROUP BY 1
    """,
    "items",
)
def fk_orphans(t: Tables) -> DataFrame:
    """Order days outside of a calendar that ends too early."""
    calendar = gold.build_dim_date(
        gold.event_days(as_text(t.orders())), FIRST_DAY, dt.date(1999, 12, 31)
    )
    return orphan_keys(fact_orders_of(t), "order_date_id", calendar, "date_id")


@query(
    "key_collisions",
    """
    SELECT p_size, count(DISTINCT p_type) AS natural_keys
    FROM part GROUP BY p_size HAVING count(DISTINCT p_type) > 1
    """,
)
def colliding_keys(t: Tables) -> DataFrame:
    return key_collisions(t.raw("part"), "p_size", "p_type")
