"""Filters, expressions, joins, aggregates, set operations, keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions import calendar, cleaning
from commerce_lake.functions.keys import add_surrogate_key, hash_key
from commerce_lake.operators import envelope, joins, merge, quality
from commerce_lake.operators.dedup import dedup_by_key
from commerce_lake.plans import gold
from commerce_lake.plans.event_stream import timed_tables
from suite.entities import FLAT, RETURNED, Tables, as_text, day_text, time_text
from suite.registry import query
from suite.scans import FLAT_COLUMNS
from suite.star import EVENT_TYPE_ID, STATUS_ID, id_case

# --- filters and expressions


@query("flatten_envelope", f"SELECT {FLAT} FROM stream", "stream")
def flatten_envelope(t: Tables) -> DataFrame:
    return envelope.flatten_envelope(as_text(t.envelopes())).select(*FLAT_COLUMNS)


@query(
    "build_envelope",
    f"SELECT {FLAT}, record_id FROM stream WHERE event_time IS NOT NULL",
    "stream",
)
def build_envelope(t: Tables) -> DataFrame:
    return t.envelopes().select(
        "stream_type", "event_time", "data.*", envelope.record_id().alias("record_id")
    )


@query(
    "filter_required_keys",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE nullif(l_returnflag, 'N') IS NOT NULL AND nullif(l_linestatus, 'O') IS NOT NULL
    """,
)
def filter_required_keys(t: Tables) -> DataFrame:
    lines = t.raw("lineitem").withColumns(
        {
            "flag": F.nullif(F.col("l_returnflag"), F.lit("N")),
            "status": F.nullif(F.col("l_linestatus"), F.lit("O")),
        }
    )
    return cleaning.require_not_null(lines, "flag", "status").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query(
    "filter_date_between",
    f"""
    SELECT o_orderkey, {day_text('o_orderdate')} AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'
    """,
)
def filter_date_between(t: Tables) -> DataFrame:
    days = t.raw("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    first, last = dt.date(1996, 1, 1), dt.date(1997, 12, 31)
    return days.where(F.col("day").between(F.lit(first), F.lit(last)))


@query(
    "derive_is_returned",
    f"SELECT order_id, CAST(order_status = '{RETURNED}' AS INTEGER) AS is_returned FROM shop_orders",
    "shop_orders",
)
def derive_is_returned(t: Tables) -> DataFrame:
    return t.orders().select(
        "order_id", gold.is_returned(F.col("order_status"), RETURNED).alias("is_returned")
    )


@query(
    "derive_line_total",
    "SELECT order_item_id, round(item_price * quantity, 2) AS line_total FROM items",
    "items",
)
def derive_line_total(t: Tables) -> DataFrame:
    return t.items().select(
        "order_item_id",
        gold.line_total(F.col("item_price"), F.col("quantity")).alias("line_total"),
    )


@query(
    "cast_clean",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(l_quantity AS INTEGER) AS quantity,
           CASE WHEN l_discount > 0.05 THEN NULL ELSE l_extendedprice END AS price
    FROM lineitem
    """,
)
def cast_clean(t: Tables) -> DataFrame:
    texts = t.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("string").alias("quantity"),
        F.when(F.col("l_discount") > 0.05, "n/a")
        .otherwise(F.col("l_extendedprice").cast("string"))
        .alias("price"),
    )
    return cleaning.cast_columns(texts, {"quantity": "int", "price": "double"})


@query(
    "parse_event_time",
    f"""
    SELECT event_id,
           CASE WHEN event_type = 'error' THEN NULL ELSE {day_text('ts')} END AS event_date,
           CASE WHEN event_type = 'error' THEN NULL ELSE {time_text('ts')} END AS event_timestamp
    FROM events
    """,
)
def parse_event_time(t: Tables) -> DataFrame:
    """The times of error events are made unreadable."""
    text = F.when(F.col("event_type") == "error", "junk").otherwise(F.col("ts").cast("string"))
    return t.raw("events").select(
        "event_id",
        cleaning.parse_date(text).alias("event_date"),
        cleaning.parse_timestamp(text).alias("event_timestamp"),
    )


@query(
    "format_event_time",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time FROM events",
)
def format_event_time(t: Tables) -> DataFrame:
    return t.raw("events").select("event_id", cleaning.format_timestamp("ts").alias("event_time"))


@query(
    "scrub_non_finite",
    """
    SELECT c_custkey, c_acctbal,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE sqrt(c_acctbal) END AS root,
           CASE WHEN abs(c_acctbal) > 1.5 THEN NULL ELSE c_acctbal * 1e308 END AS huge
    FROM customer
    """,
)
def scrub_non_finite(t: Tables) -> DataFrame:
    """Roots of negative balances are NaN, multiples beyond the range of double infinite."""
    balances = t.raw("customer").select(
        "c_custkey",
        "c_acctbal",
        F.sqrt("c_acctbal").alias("root"),
        (F.col("c_acctbal") * F.lit(1e308)).alias("huge"),
    )
    return cleaning.scrub_non_finite(balances)


DAY = dt.date(2024, 1, 15)
ORDER_DAY = dt.date(1998, 10, 3)


@query(
    "day_slice",
    f"""
    SELECT event_id, event_type, {time_text('ts')} AS ts FROM events
    WHERE CAST(ts AS DATE) = DATE '{DAY}'
    """,
)
def day_slice(t: Tables) -> DataFrame:
    return envelope.day_slice(t.raw("events"), "ts", DAY).select("event_id", "event_type", "ts")


@query(
    "rotating_day",
    f"""
    SELECT {day_text('first_time')} AS first_day,
           {day_text('CAST(first_time AS DATE) + CAST(138 % (days + 1) AS INTEGER)')} AS target_day
    FROM (SELECT min(ts) AS first_time, datesub('day', min(ts), max(ts)) AS days FROM events)
    """,
)
def rotating_day(t: Tables) -> DataFrame:
    """17 May 2024 is the 138th day of its year."""
    return calendar.rotating_day_frame(t.raw("events"), "ts", dt.date(2024, 5, 17))


# --- joins


@query(
    "join_items_orders",
    """
    SELECT order_item_id, order_id, user_id, order_status, quantity
    FROM items JOIN shop_orders USING (order_id)
    """,
    "items",
    "shop_orders",
)
def join_items_orders(t: Tables) -> DataFrame:
    items = t.items()
    hot = joins.find_hot_keys(items, "order_id", rows=items.count())
    return joins.join_on_key(items, t.orders(), "order_id", hot=hot).select(
        "order_item_id", "order_id", "user_id", "order_status", "quantity"
    )


@query(
    "join_left_lookup",
    """
    SELECT i.order_item_id, i.product_id, r.review_count
    FROM items i LEFT JOIN (
        SELECT product_id, count(*) AS review_count FROM reviews GROUP BY product_id
    ) r ON i.product_id = r.product_id
    """,
    "items",
    "reviews",
)
def join_left_lookup(t: Tables) -> DataFrame:
    items = t.items().select("order_item_id", "product_id")
    counts = t.reviews().groupBy("product_id").agg(F.count("*").alias("review_count"))
    hot = joins.find_hot_keys(items, "product_id", rows=items.count())
    return joins.lookup(items, counts, "product_id", ["review_count"], hot).select(
        "order_item_id", "product_id", "review_count"
    )


@query(
    "join_left_expr",
    f"SELECT event_id, {id_case('event_type', EVENT_TYPE_ID)} AS event_type_id FROM shop_events",
    "shop_events",
)
def join_left_expr(t: Tables) -> DataFrame:
    events, types = t.events(), gold.build_dim_event_type(t.events())
    same = events["event_type"] == types["event_type_name"]
    return joins.lookup_where(events, types, same).select("event_id", "event_type_id")


@query(
    "join_left_expr_spread",
    f"SELECT event_id, {id_case('event_type', EVENT_TYPE_ID)} AS event_type_id FROM shop_events",
    "shop_events",
)
def join_left_expr_spread(t: Tables) -> DataFrame:
    """The same with the rows of frequent types spread, though the table may be small."""
    events, types = t.events(), gold.build_dim_event_type(t.events())
    on = (events["event_type"], types["event_type_name"])
    hot = joins.find_hot_keys(events, "event_type", fraction=0.01, min_rows=1)
    joined = joins.lookup_where(events, types, on[0] == on[1], on=on, hot=hot)
    return joined.select("event_id", "event_type_id")


@query(
    "semi_items_of_day_orders",
    f"""
    SELECT order_item_id, order_id, product_id FROM items
    WHERE order_id IN (SELECT order_id FROM shop_orders
                       WHERE CAST(event_time AS DATE) = DATE '{ORDER_DAY}')
    """,
    "items",
    "shop_orders",
)
def semi_items_of_day_orders(t: Tables) -> DataFrame:
    items = t.items()
    orders = envelope.day_slice(t.orders(), "event_time", ORDER_DAY)
    hot = joins.find_hot_keys(items, "order_id", rows=items.count())
    return joins.rows_of(items, orders, "order_id", hot).select(
        "order_item_id", "order_id", "product_id"
    )


@query(
    "enrich_item_event_time",
    f"SELECT order_item_id, {time_text('event_time')} AS event_time FROM items",
    "items",
)
def enrich_item_event_time(t: Tables) -> DataFrame:
    items = t.items()
    hot = joins.find_hot_keys(items, "order_id", rows=items.count())
    return joins.inherit_event_time(items, t.orders(), "order_id", hot).select(
        "order_item_id", "event_time"
    )


@query(
    "merge_by_key",
    """
    SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal
    FROM customer
    """,
)
def merge_by_key(t: Tables) -> DataFrame:
    """Customers in debt get a new row with a zero balance."""
    existing = t.raw("customer").select("c_custkey", "c_name", "c_acctbal")
    new = existing.where("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0))
    return merge.merge_by_key(existing, new, ["c_custkey"])


# --- aggregates, distinct, order, set operations


@query(
    "count_by_type",
    "SELECT stream_type, count(*) AS count FROM stream GROUP BY stream_type ORDER BY 1",
    "stream",
)
def count_by_type(t: Tables) -> DataFrame:
    return quality.count_by(t.envelopes(), "stream_type")


@query(
    "dedup_by_key",
    f"""
    SELECT o_custkey, o_orderkey, o_totalprice, {time_text('o_orderdate')} AS o_orderdate
    FROM (SELECT *, row_number() OVER (
              PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders)
    WHERE r = 1
    """,
)
def latest_order(t: Tables) -> DataFrame:
    """The last order of each customer."""
    orders = t.raw("orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return dedup_by_key(orders, ["o_custkey"], ["o_orderdate"])


@query(
    "time_range",
    f"SELECT {time_text('min(ts)')} AS min_time, {time_text('max(ts)')} AS max_time FROM events",
)
def time_range(t: Tables) -> DataFrame:
    return calendar.time_range(t.raw("events"), "ts")


@query(
    "order_by_priority",
    f"""
    SELECT stream_type, {time_text('event_time')} AS event_time, priority, record_id
    FROM stream ORDER BY 2, 3, 4
    """,
    "stream",
)
def order_by_priority(t: Tables) -> DataFrame:
    return envelope.order_by_priority(t.envelopes()).select(
        "stream_type",
        "event_time",
        envelope.priority().alias("priority"),
        envelope.record_id().alias("record_id"),
    )


@query(
    "preview_limit",
    """
    SELECT order_id, user_id, total_amount FROM shop_orders
    ORDER BY total_amount DESC, order_id LIMIT 5
    """,
    "shop_orders",
)
def preview_limit(t: Tables) -> DataFrame:
    columns = t.orders().select("order_id", "user_id", "total_amount")
    return columns.orderBy(F.desc("total_amount"), "order_id").limit(5)


_DAYS_SQL = " UNION ALL ".join(
    f"SELECT CAST(event_time AS DATE) AS d FROM {name}"
    for name in ("shop_events", "shop_orders", "items", "reviews")
)


def _days(t: Tables) -> list[DataFrame]:
    tables = timed_tables(t.source_tables()).values()
    return [df.select(F.col("event_time").cast("date").alias("day")) for df in tables]


@query(
    "union_dates",
    f"SELECT {day_text('d')} AS day, count(*) AS count FROM ({_DAYS_SQL}) GROUP BY 1",
    "stream",
)
def union_dates(t: Tables) -> DataFrame:
    return quality.count_by(merge.union_all(_days(t)), "day")


@query(
    "union_distinct_dates", f"SELECT DISTINCT {day_text('d')} AS day FROM ({_DAYS_SQL})", "stream"
)
def union_distinct_dates(t: Tables) -> DataFrame:
    return merge.union_distinct(_days(t))


# --- surrogate keys


@query(
    "surrogate_key_hash",
    f"SELECT order_id, {id_case('order_status', STATUS_ID)} AS status_id FROM shop_orders",
    "shop_orders",
)
def surrogate_key_hash(t: Tables) -> DataFrame:
    return t.orders().select("order_id", hash_key("order_status").alias("status_id"))


@query(
    "surrogate_key_dense",
    """
    SELECT name, row_number() OVER (ORDER BY name) AS name_id
    FROM (SELECT DISTINCT name FROM users)
    """,
    "users",
)
def surrogate_key_dense(t: Tables) -> DataFrame:
    return add_surrogate_key(t.users().select("name").distinct(), "name", "name_id", "dense")


@query(
    "surrogate_key_monotonic",
    """
    SELECT count(*) AS keys, count(*) AS distinct_ids, true AS none_negative
    FROM (SELECT DISTINCT name FROM users)
    """,
    "users",
)
def surrogate_key_monotonic(t: Tables) -> DataFrame:
    """The ids differ between runs; checked is that they are unique and not negative."""
    names = t.users().select("name").distinct()
    return add_surrogate_key(names, "name", "id", "monotonic").agg(
        F.count("*").alias("keys"),
        F.count_distinct("id").alias("distinct_ids"),
        (F.min("id") >= 0).alias("none_negative"),
    )
