"""Builders of the Gold star schema. They read nothing and write nothing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.calendar import date_attributes
from commerce_lake.functions.cleaning import (
    literal_lookup,
    parse_date,
    parse_timestamp,
    require_not_null,
)
from commerce_lake.functions.keys import add_surrogate_key, hash_key
from commerce_lake.operators.days import of_days
from commerce_lake.operators.dedup import dedup_by_key
from commerce_lake.operators.joins import HotKey, join_on_key, lookup, lookup_where
from commerce_lake.operators.merge import merge_by_key, union_distinct

ARRIVAL = "ingestion_time"
FIRST_DAY = dt.date(2023, 1, 1)
LAST_DAY = dt.date(2026, 12, 31)


def _latest(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], null_keys: str = "drop"
) -> DataFrame:
    """One row per key, the one that arrived last where arrival times are known.

    Only `columns` are read and shuffled, and only they break ties.
    """
    known = [ARRIVAL] if ARRIVAL in df.columns else []
    unique = dedup_by_key(df.select(*columns, *known), keys, known, null_keys=null_keys)
    return unique.select(*columns)


def with_content(df: DataFrame, key: str) -> DataFrame:
    """Add `_content`, a digest of the whole record but its ingestion time, for rows without `key`.

    Such rows repeat each other only if all their columns agree, also those no plan uses.
    """
    whole = F.struct(*[F.col(c) for c in df.columns if c != "ingestion_time"])
    digest = F.sha2(F.to_json(whole, {"ignoreNullFields": "false"}), 256)
    return df.withColumn("_content", F.when(F.col(key).isNull(), digest))


def build_dim_users(users: DataFrame) -> DataFrame:
    return _latest(users, ["user_id"], ["user_id", "name", "email", "gender", "city"])


def product_ratings(reviews: DataFrame) -> DataFrame:
    """Mean rating and number of reviews per product, from rated reviews only."""
    rated = reviews.where(F.col("rating").isNotNull())
    return rated.groupBy("product_id").agg(
        F.round(F.avg("rating"), 2).alias("avg_rating"),
        F.count("review_id").alias("review_count"),
    )


def list_prices(products: DataFrame) -> DataFrame:
    """Every product once, with the columns that do not depend on reviews."""
    columns = ["product_id", "product_name", "category", "price", "brand"]
    return _latest(products, ["product_id"], columns).withColumnRenamed("price", "list_price")


def with_ratings(products: DataFrame, ratings: DataFrame) -> DataFrame:
    """Products with their ratings; 0.0 and 0 where there are none."""
    return lookup(
        list_prices(products), ratings, "product_id", ["avg_rating", "review_count"]
    ).withColumns(
        {
            "avg_rating": F.coalesce("avg_rating", F.lit(0.0)),
            "review_count": F.coalesce("review_count", F.lit(0)),
        }
    )


def build_dim_products(
    products: DataFrame, reviews: DataFrame, *, resent: bool = True
) -> DataFrame:
    """Products with the ratings that all reviews give them.

    `resent=False` states that no review occurs twice and saves the check.
    """
    if resent:
        columns = ["review_id", "product_id", "rating", "_content"]
        reviews = with_content(reviews, "review_id")
        reviews = _latest(reviews, ["review_id"], columns, null_keys="content")
    return with_ratings(products, product_ratings(reviews))


def event_days(*tables: DataFrame) -> DataFrame:
    """Each day on which any of the tables has a record, as `day`."""
    return union_distinct([t.select(parse_date("event_time").alias("day")) for t in tables])


def build_dim_date(
    days: DataFrame, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY
) -> DataFrame:
    """Calendar attributes of the given days within [first, last]."""
    known = days.where(F.col("day").between(F.lit(first), F.lit(last)))
    return known.select(*date_attributes("day"))


def merge_dim_date(existing: DataFrame, new: DataFrame) -> DataFrame:
    return merge_by_key(existing, new, ["date_id"])


def build_lookup_dim(
    rows: DataFrame, natural: str, key: str, label: str | None = None, strategy: str = "hash"
) -> DataFrame:
    """Every value of a column once, with a surrogate key."""
    label = label or natural
    values = rows.where(F.col(natural).isNotNull()).select(F.col(natural).alias(label)).distinct()
    return add_surrogate_key(values, label, key, strategy).select(key, label)


def build_dim_order_status(orders: DataFrame, strategy: str = "hash") -> DataFrame:
    return build_lookup_dim(orders, "order_status", "status_id", strategy=strategy)


def build_dim_event_type(events: DataFrame, strategy: str = "hash") -> DataFrame:
    return build_lookup_dim(
        events, "event_type", "event_type_id", "event_type_name", strategy=strategy
    )


def order_lines(items: DataFrame, *, resent: bool = True) -> DataFrame:
    """Order items that have an order and a product, each once."""
    columns = ["order_item_id", "order_id", "product_id", "quantity", "item_price", "_content"]
    usable = require_not_null(items, "order_id", "product_id")
    if resent:
        usable = with_content(usable, "order_item_id")
        usable = _latest(usable, ["order_item_id"], columns, null_keys="content")
    return usable.select(
        "order_item_id",
        "order_id",
        "product_id",
        F.col("quantity").try_cast("int").alias("quantity"),
        F.col("item_price").try_cast("double").alias("item_price"),
    )


def order_heads(
    orders: DataFrame, *, resent: bool = True, dates: Sequence[dt.date] | DataFrame | None = None
) -> DataFrame:
    """Orders with parsed times, each once; with `dates`, those of these days."""
    columns = ["order_id", "user_id", "event_time", "total_amount", "order_status"]
    usable = require_not_null(orders, "order_id")
    if resent:
        usable = _latest(usable, ["order_id"], columns)
    heads = usable.select(
        "order_id",
        "user_id",
        parse_timestamp("event_time").alias("order_timestamp"),
        parse_date("event_time").alias("order_date_id"),
        F.col("total_amount").try_cast("double").alias("total_amount"),
        "order_status",
    )
    return heads if dates is None else of_days(heads, dates, "order_date_id")


def line_total(price: Column, quantity: Column) -> Column:
    return F.round(price * quantity, 2)


def is_returned(status: Column, label: str = "Returned") -> Column:
    """1 for returned orders, 0 for all others and for an unknown status."""
    return F.when(status == label, 1).otherwise(0)


def build_fact_orders(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    statuses: DataFrame | None = None,
    *,
    returned_label: str = "Returned",
    strategy: str = "hash",
    resent: bool = True,
    dates: Sequence[dt.date] | DataFrame | None = None,
    hot_orders: Sequence[HotKey] = (),
    hot_products: Sequence[HotKey] = (),
    loaded_at: Column | None = None,
) -> DataFrame:
    """One row per order item with the data of its order and the product's list price.

    Hash keys are computed in place; `statuses` is needed (and joined) only for other key
    strategies. `resent=False` states that no item or order occurs twice and saves the check.
    """
    rows = join_on_key(
        order_lines(items, resent=resent),
        order_heads(orders, resent=resent, dates=dates),
        "order_id",
        hot=hot_orders,
    )
    rows = lookup(rows, products, "product_id", ["list_price"], hot_products)
    if statuses is None:
        rows = rows.withColumn("status_id", hash_key("order_status", strategy))
    else:
        rows = lookup(rows, statuses, "order_status", ["status_id"])
    return rows.select(
        "order_item_id",
        "order_id",
        "user_id",
        "product_id",
        "order_date_id",
        "status_id",
        "order_timestamp",
        "quantity",
        "item_price",
        "list_price",
        line_total(F.col("item_price"), F.col("quantity")).alias("line_total"),
        "total_amount",
        is_returned(F.col("order_status"), returned_label).alias("is_returned"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("gold_created_at"),
    )


def build_fact_events(
    events: DataFrame,
    event_types: DataFrame | None = None,
    *,
    strategy: str = "hash",
    resent: bool = True,
    dates: Sequence[dt.date] | DataFrame | None = None,
    funnel_order: Sequence[str] | None = None,
    hot_types: Sequence[HotKey] = (),
    loaded_at: Column | None = None,
) -> DataFrame:
    """One row per event that has an id, a user and a product.

    `funnel_step` repeats the event type's id; with `funnel_order` it is the position (from 1)
    of the event type in that list, 0 for others.
    """
    rows = require_not_null(events, "event_id", "user_id", "product_id")
    if resent:
        columns = ["event_id", "user_id", "product_id", "event_type", "event_time"]
        rows = _latest(rows, ["event_id"], columns)
    if dates is not None:  # last, as an event may have been sent again under another day
        rows = of_days(rows.withColumn("_of", parse_date("event_time")), dates, "_of").drop("_of")
    if event_types is None:
        rows = rows.withColumn("event_type_id", hash_key("event_type", strategy))
    else:
        on = (rows["event_type"], event_types["event_type_name"])
        rows = lookup_where(rows, event_types, on[0] == on[1], on=on, hot=hot_types)
    step = F.col("event_type_id")
    if funnel_order is not None:
        steps = {name: number for number, name in enumerate(funnel_order, start=1)}
        step = literal_lookup(F.col("event_type"), steps, 0)
    return rows.select(
        "event_id",
        "user_id",
        "product_id",
        parse_date("event_time").alias("event_date_id"),
        "event_type_id",
        step.alias("funnel_step"),
        parse_timestamp("event_time").alias("event_timestamp"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("gold_created_at"),
    )


def undated(rows: DataFrame) -> DataFrame:
    """Bronze records whose event time cannot be read, and which therefore reach no fact table."""
    return rows.where(parse_timestamp("event_time").isNull())
