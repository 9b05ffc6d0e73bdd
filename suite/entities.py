"""The shared test tables seen as shop entities, in Spark and as SQL views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.plans.bronze import ingest_stream_bronze
from commerce_lake.plans.event_stream import landing_records, timed_tables
from commerce_lake.operators.envelope import unify
from commerce_lake.shared import new_folder
from commerce_lake.sinks.files import write_json

# The order status that stands for a returned order on this data.
RETURNED = "F"
LOADED_AT = "2024-02-01 00:00:00"

# Almost unique: a few lines share all four numbers, so facts and ratings keep one of them.
_LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

# One view per entity; times stay timestamps here.
ENTITY_SQL = {
    "users": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name,
               lower(c_name) || '@example.com' AS email, n_name AS city, c_mktsegment AS gender
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
               p_type AS category, p_retailprice AS price, p_brand AS brand
        FROM part""",
    "shop_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
               o_totalprice AS total_amount, o_orderstatus AS order_status,
               o_orderdate AS event_time
        FROM orders""",
    "items": f"""
        SELECT {_LINE_ID} AS order_item_id, CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
               l_extendedprice AS item_price, o_orderdate AS event_time
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "reviews": f"""
        SELECT {_LINE_ID} AS review_id, CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(o_custkey AS VARCHAR) AS user_id, l_quantity AS rating,
               CAST(NULL AS VARCHAR) AS review_text, l_shipdate AS event_time
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R' AND l_quantity >= 40""",
    "shop_events": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
               json_extract_string(props, '$.k') AS product_id, event_type, ts AS event_time
        FROM events""",
    "stream": """
        SELECT 'events' AS stream_type, event_time, event_id, user_id, product_id, event_type,
               NULL AS order_id, NULL AS total_amount, NULL AS order_status,
               NULL AS order_item_id, NULL AS quantity, NULL AS item_price,
               NULL AS review_id, NULL AS rating, NULL AS review_text,
               event_id AS record_id, 0 AS priority
        FROM shop_events
        UNION ALL
        SELECT 'orders', event_time, NULL, user_id, NULL, NULL, order_id, total_amount,
               order_status, NULL, NULL, NULL, NULL, NULL, NULL, order_id, 1
        FROM shop_orders
        UNION ALL
        SELECT 'order_items', event_time, NULL, NULL, product_id, NULL, order_id, NULL, NULL,
               order_item_id, quantity, item_price, NULL, NULL, NULL, order_item_id, 2
        FROM items
        UNION ALL
        SELECT 'reviews', event_time, NULL, user_id, product_id, NULL, NULL, NULL, NULL, NULL,
               NULL, NULL, review_id, rating, review_text, review_id, 3
        FROM reviews""",
}
_STREAM_PARTS = ("shop_events", "shop_orders", "items", "reviews")

# The flat columns of an envelope, as the `stream` view has them.
FLAT = (
    "stream_type, CAST(event_time AS VARCHAR) AS event_time, event_id, user_id, product_id, "
    "event_type, order_id, total_amount, order_status, order_item_id, quantity, item_price, "
    "review_id, rating, review_text"
)


def day_text(value: str) -> str:
    return f"CAST(CAST({value} AS DATE) AS VARCHAR)"


def time_text(value: str) -> str:
    return f"CAST({value} AS VARCHAR)"


def with_entities(sql: str, *names: str) -> str:
    """Put the views `names` (and those they use) in front of a SELECT."""
    needed: list[str] = []
    for name in names:
        for part in (*(_STREAM_PARTS if name == "stream" else ()), name):
            if part not in needed:
                needed.append(part)
    if not needed:
        return sql.strip()
    views = ", ".join(f"{n} AS ({ENTITY_SQL[n].strip()})" for n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {views}, {body[5:]}"
    return f"WITH {views} {body}"


_written: dict[tuple[str, str, str], str] = {}


class Tables:
    """The test tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def new_path(self, label: str) -> str:
        return new_folder(self.spark, label)

    def new_database(self, label: str) -> str:
        """An empty database in the shared folder that no other run uses."""
        path = new_folder(self.spark, label)
        name = path.rpartition("/")[2].replace("-", "_")
        self.spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
        return name

    # Entities. Times are timestamps; `as_text` turns them into the text that Bronze holds.

    def users(self) -> DataFrame:
        return (
            self.raw("customer")
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").cast("string").alias("user_id"),
                F.col("c_name").alias("name"),
                F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
                F.col("n_name").alias("city"),
                F.col("c_mktsegment").alias("gender"),
            )
        )

    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("price"),
            F.col("p_brand").alias("brand"),
        )

    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("user_id"),
            F.col("o_totalprice").alias("total_amount"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("event_time"),
        )

    def items(self) -> DataFrame:
        """Order items; they have no time of their own."""
        return _items_as_text(self._items())

    def _items(self) -> DataFrame:
        """Order items by the numbers of their table, which take less of a shuffle than their text."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").alias("item_price"),
        )

    def reviews(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .where("l_returnflag = 'R' AND l_quantity >= 40")
            .join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
                    "review_id"
                ),
                F.col("l_partkey").cast("string").alias("product_id"),
                F.col("o_custkey").cast("string").alias("user_id"),
                F.col("l_quantity").alias("rating"),
                F.lit(None).cast("string").alias("review_text"),
                F.col("l_shipdate").alias("event_time"),
            )
        )

    def events(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.get_json_object("props", "$.k").alias("product_id"),
            "event_type",
            F.col("ts").alias("event_time"),
        )

    def source_tables(self) -> dict[str, DataFrame]:
        return {
            "events": self.events(),
            "orders": self.orders(),
            "order_items": self.items(),
            "reviews": self.reviews(),
        }

    def envelopes(self) -> DataFrame:
        """All four tables as one envelope frame, times as timestamps.

        Items meet their orders by number and become text afterwards.
        """
        tables = self.source_tables()
        numbers = self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("event_time")
        )
        timed = timed_tables({"order_items": self._items(), "orders": numbers})["order_items"]
        return unify({**tables, "order_items": _items_as_text(timed)})

    # Files and tables derived from all rows, written once per session.

    def _once(self, label: str, write) -> str:
        key = (self.spark.sparkContext.applicationId, self.folder, label)
        if key not in _written:
            path = self.new_path(label)
            write(path)
            _written[key] = path
        return _written[key]

    def landing(self) -> str:
        """A folder of envelope files, one record per line."""
        loaded = F.lit(LOADED_AT).cast("timestamp_ntz")
        return self._once(
            "landing", lambda path: write_json(landing_records(self.envelopes(), loaded), path)
        )

    def bronze(self) -> str:
        """The Bronze stream table built from the landing files."""
        return self._once(
            "bronze",
            lambda path: ingest_stream_bronze(
                self.spark, self.landing(), path, multi_line=False
            ),
        )


def _items_as_text(items: DataFrame) -> DataFrame:
    """Order items as the shop has them: ids are text. Keeps `event_time` if there is one."""
    return items.select(
        F.concat_ws("-", "order_id", "l_linenumber", "l_partkey", "l_suppkey").alias(
            "order_item_id"
        ),
        F.col("order_id").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        "quantity",
        "item_price",
        *[c for c in items.columns if c == "event_time"],
    )


def as_text(df: DataFrame) -> DataFrame:
    """Event times as text."""
    return df.withColumn("event_time", F.col("event_time").cast("string"))
