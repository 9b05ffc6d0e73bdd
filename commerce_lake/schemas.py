"""Input schemas and output contracts.

The column names and types below are fixed values: files and tables must carry exactly these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STREAM_TYPES = ("events", "orders", "order_items", "reviews")

# At equal event time parents come before children; unknown types go last.
STREAM_PRIORITY = {"events": 0, "orders": 1, "order_items": 2, "reviews": 3}
UNKNOWN_PRIORITY = 99

# Fields each stream type fills inside the envelope's `data` struct.
VARIANT_FIELDS = {
    "events": ("event_id", "user_id", "product_id", "event_type"),
    "orders": ("order_id", "user_id", "total_amount", "order_status"),
    "order_items": ("order_item_id", "order_id", "product_id", "quantity", "item_price"),
    "reviews": ("review_id", "product_id", "user_id", "rating", "review_text"),
}

# The column that identifies a record of each stream type.
RECORD_ID = {
    "events": "event_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "reviews": "review_id",
}

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def columns(text: str) -> T.StructType:
    """Schema from `name type, name type, ...`; unlike `fromDDL` it needs no session."""
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


DATA_FIELDS = columns(
    "event_id string, user_id string, product_id string, event_type string, "
    "order_id string, total_amount double, order_status string, "
    "order_item_id string, quantity int, item_price double, "
    "review_id string, rating double, review_text string"
)
_ENVELOPE_HEAD = columns("stream_type string, event_time string, ingestion_time string")
ENVELOPE = T.StructType([*_ENVELOPE_HEAD, T.StructField("data", DATA_FIELDS)])
BRONZE_STREAM = T.StructType([*_ENVELOPE_HEAD, *DATA_FIELDS])
USERS = columns("user_id string, name string, email string, city string, gender string")
PRODUCTS = columns(
    "product_id string, product_name string, category string, price double, brand string"
)

DIM_USERS = columns("user_id string, name string, email string, gender string, city string")
DIM_PRODUCTS = columns(
    "product_id string, product_name string, category string, list_price double, "
    "brand string, avg_rating double, review_count bigint"
)
DIM_DATE = columns(
    "date_id date, year int, month int, day int, quarter int, day_of_week int, "
    "day_name string, month_name string, is_weekend boolean"
)
DIM_ORDER_STATUS = columns("status_id int, order_status string")
DIM_EVENT_TYPE = columns("event_type_id int, event_type_name string")
FACT_ORDERS = columns(
    "order_item_id string, order_id string, user_id string, product_id string, "
    "order_date_id date, status_id int, order_timestamp timestamp, quantity int, "
    "item_price double, list_price double, line_total double, total_amount double, "
    "is_returned int, gold_created_at timestamp"
)
FACT_EVENTS = columns(
    "event_id string, user_id string, product_id string, event_date_id date, "
    "event_type_id int, funnel_step int, event_timestamp timestamp, gold_created_at timestamp"
)


class SchemaMismatch(ValueError):
    """A DataFrame does not follow its declared contract."""


def schema_differences(actual: T.StructType, expected: T.StructType) -> list[str]:
    """Missing, unexpected and differently typed columns; order and nullability are ignored."""
    have = {f.name: f.dataType for f in actual}
    want = {f.name: f.dataType for f in expected}
    found = [f"missing {n}" for n in want if n not in have]
    found += [f"unexpected {n}" for n in have if n not in want]
    found += [
        f"{n} is {have[n].simpleString()}, not {want[n].simpleString()}"
        for n in want
        if n in have and have[n] != want[n]
    ]
    return found


def require_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Return `df` in contract column order, or raise SchemaMismatch."""
    found = schema_differences(df.schema, expected)
    if found:
        raise SchemaMismatch("; ".join(found))
    return df.select(*expected.names)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Raise SchemaMismatch unless `df` has every column in `names`."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise SchemaMismatch("missing " + ", ".join(missing))
    return df
