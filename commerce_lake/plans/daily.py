"""The daily run: land new files, rebuild the days they touch, refresh dimensions, publish."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake import schemas
from commerce_lake.operators.days import of_days
from commerce_lake.operators.joins import find_hot_keys, plan_lookup
from commerce_lake.operators.merge import merge_by_key, union_all
from commerce_lake.operators.quality import fail_on_collisions, table_summary
from commerce_lake.plans import gold
from commerce_lake.plans.day_index import ARRIVAL, DayIndex, arrivals
from commerce_lake.plans.ratings import RatingState
from commerce_lake.shared import materialize
from commerce_lake.sinks import folders
from commerce_lake.sinks.files import drop_partitions, write_partitioned
from commerce_lake.sinks.pointer import current_path, read_current, write_current
from commerce_lake.sinks.publish import Fact, Reference, publish_all
from commerce_lake.sinks.versions import create_database, write_version
from commerce_lake.sources.files import (
    EVENT_DATE,
    read_json_table,
    read_or_empty,
    split_bronze,
)
from commerce_lake.sources.tables import table_exists
from commerce_lake.streaming.archive import archive_file, archive_stream
from commerce_lake.streaming.facts import start_landing
from commerce_lake.streaming.landing import read_landing
from commerce_lake.streaming.pending import PendingLog

FACTS = {
    "fact_orders": Fact("fact_orders", "order_item_id", "order_date_id"),
    "fact_events": Fact("fact_events", "event_id", "event_date_id"),
}
# What facts refer to in dimensions made of the same records; see Lake.check_references.
REFERENCES_OF = {
    "fact_orders": (
        Reference("order_date_id", "dim_date", "date_id"),
        Reference("status_id", "dim_order_status", "status_id"),
    ),
    "fact_events": (
        Reference("event_date_id", "dim_date", "date_id"),
        Reference("event_type_id", "dim_event_type", "event_type_id"),
    ),
}
# Surrogate and natural key of dimensions that are numbered by a hash.
HASHED = {
    "dim_order_status": ("status_id", "order_status"),
    "dim_event_type": ("event_type_id", "event_type_name"),
}
# Dimensions that grow by merging what a run brings in, with their key.
MERGED_DIMENSIONS = {
    "dim_date": "date_id",
    "dim_order_status": "order_status",
    "dim_event_type": "event_type_name",
}
# Dimensions that are replaced by the reference tables of the run.
REPLACED_DIMENSIONS = ("dim_users", "dim_products")
CONTRACTS = {
    "dim_users": schemas.DIM_USERS,
    "dim_products": schemas.DIM_PRODUCTS,
    "fact_orders": schemas.FACT_ORDERS,
    "fact_events": schemas.FACT_EVENTS,
}
# Reference tables with the column that a usable row has.
REFERENCES = {"users": (schemas.USERS, "user_id"), "products": (schemas.PRODUCTS, "product_id")}
_PRODUCT = schemas.columns("product_id string")


@dataclass(frozen=True)
class Lake:
    """Where a lake lives and how it is read. Paths must be reachable by all executors.

    `multi_line` is for stream files and `static_multi_line` for reference files: whether a file is one
    JSON array, or has a record on each line. Names of stream files must not be used twice.
    `index_buckets` must stay as it is once a lake has been begun. With `check_references`, a fact row
    whose day (outside first_day to last_day), status or event type has no dimension row stops
    publishing. With `key_filters`, new facts are compared with those published days alone that may
    hold them. Dimensions of which one hashed key stands for two values stop a run always.
    """

    landing: str
    root: str
    gold_database: str
    warehouse_database: str
    archive: str | None = None
    multi_line: bool = True
    static_multi_line: bool = True
    max_files: int | None = None
    first_day: dt.date = gold.FIRST_DAY
    last_day: dt.date = gold.LAST_DAY
    returned_label: str = "Returned"
    index_buckets: int = 256
    check_references: bool = False
    key_filters: bool = False

    @property
    def index(self) -> DayIndex:
        return DayIndex(self.state("index"), self.index_buckets)

    @property
    def ratings(self) -> RatingState:
        return RatingState(self.state("ratings"), self.index_buckets)

    @property
    def pending(self) -> PendingLog:
        return PendingLog(self.state("pending"))

    @property
    def stream_landing(self) -> str:
        return f"{self.landing}/stream"

    def static_landing(self, name: str) -> str:
        return f"{self.landing}/static/{name}.json"

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def gold_table(self, name: str) -> str:
        return f"{self.gold_database}.{name}"

    def state(self, name: str) -> str:
        return f"{self.root}/state/{name}"


# --- landing


def land_static(spark: SparkSession, lake: Lake) -> dict[str, str]:
    """Replace the reference tables in Bronze by the files that have come.

    A file that is missing, empty or has no usable row leaves its table as it was. Products with
    another price than before are noted first, since old facts change with them. Returns the stamps
    of the files read, by name.
    """
    stamps = {}
    for name, (schema, key) in REFERENCES.items():
        path = lake.static_landing(name)
        stamp = folders.stamp(spark, path)
        if stamp is None:
            continue
        new = read_json_table(spark, path, schema, multi_line=lake.static_multi_line)
        if new.where(F.col(key).isNotNull()).isEmpty():
            continue
        if name == "products" and current_path(spark, lake.bronze(name)):
            old = read_current(spark, lake.bronze(name), schema)
            changed = changed_prices(old, new)
            if not changed.isEmpty():
                lake.pending.add(f"prices-{uuid.uuid4().hex}", changed)
        write_current(new, lake.bronze(name))
        stamps[name] = stamp
    return stamps


def changed_prices(old: DataFrame, new: DataFrame) -> DataFrame:
    """Products whose list price is not the same in both tables; a missing product has none."""
    before, after = (
        gold.list_prices(t).select("product_id", F.col("list_price").alias(n))
        for t, n in ((old, "before"), (new, "after"))
    )
    differs = ~F.col("before").eqNullSafe(F.col("after"))
    return before.join(after, "product_id", "full").where(differs).select("product_id")


def land_stream(spark: SparkSession, lake: Lake) -> None:
    """Bring all new landing files into Bronze, the index of days and the ratings; note what came.

    However many micro-batches there are, facts are rebuilt once, afterwards (see `run_daily`).
    """
    index, ratings = lake.index, lake.ratings
    if not index.exists(spark):
        bronze = bronze_tables(spark, lake)
        if bronze is None:
            index.complete(spark)
        else:  # a lake that was begun without an index
            folders.remove(spark, ratings.path)
            ratings.add(bronze["reviews"], -1)
            whole = union_all([arrivals(df) for df in bronze.values()])
            index.build(materialize(whole, "index"))
            facts = read_or_empty(spark, lake.gold("fact_orders"), schemas.FACT_ORDERS)
            index.add_products(facts, "order_date_id")

    def note(rows: DataFrame, batch_id: int) -> None:
        index.add(lake.pending.add(f"batch-{batch_id}", arrivals(rows)))
        reviews = rows.where("stream_type = 'reviews'")
        if not reviews.isEmpty():
            ratings.add(reviews, batch_id)

    folders.make(spark, lake.stream_landing)
    stream = read_landing(
        spark, lake.stream_landing, multi_line=lake.multi_line, max_files=lake.max_files
    )
    start_landing(stream, lake.bronze("stream"), lake.state("stream"), note).awaitTermination()


def bronze_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame] | None:
    """Bronze by stream type, with the partition column; None before the first landing."""
    if not folders.exists(spark, lake.bronze("stream")):
        return None
    return dict(split_bronze(spark, lake.bronze("stream"), by_date=True, keep_date=True))


def archive_landing(spark: SparkSession, lake: Lake, stamps: dict[str, str]) -> None:
    """Move the files that this run has read, of the stream and the reference tables."""
    if lake.archive is None:
        return
    archive_stream(spark, lake.stream_landing, lake.state("stream"), f"{lake.archive}/stream")
    for name, stamp in stamps.items():
        archive_file(spark, lake.static_landing(name), f"{lake.archive}/static", stamp)


# --- what a run has to work in


def pending_arrivals(spark: SparkSession, lake: Lake) -> DataFrame:
    return lake.pending.read(spark, lake.pending.names(spark, "batch-"), ARRIVAL)


def pending_days(spark: SparkSession, lake: Lake) -> DataFrame:
    """Days (`day`) whose facts may change by records and prices since the last run that succeeded."""
    prices = lake.pending.read(spark, lake.pending.names(spark, "prices-"), _PRODUCT)
    return lake.index.affected_days(pending_arrivals(spark, lake), prices)


def rebuild_facts(spark: SparkSession, lake: Lake, days: DataFrame | None = None) -> None:
    """Rebuild the fact partitions of `days` (a written table with a column `day`; default: all).

    Each of these days gets the facts that a full build would give it, with today's prices, and a
    day that is left without any loses its partition. Records are read from the Bronze partitions
    of these days and of days linked with them (see DayIndex).
    """
    tables = bronze_tables(spark, lake)
    if tables is None:
        return
    rows = tables["order_items"].count()  # from the file footers, as that of products
    if days is not None:
        tables = lake.index.records_of(tables, days, EVENT_DATE)
    tables = {name: df.drop(EVENT_DATE) for name, df in tables.items()}
    items = tables["order_items"]
    started = F.lit(dt.datetime.now())
    products = read_current(spark, lake.bronze("products"), schemas.PRODUCTS)
    prices, hot_products = plan_lookup(
        items, rows, gold.list_prices(products), products.count(), "product_id"
    )
    built = {
        "fact_orders": gold.build_fact_orders(
            items,
            tables["orders"],
            prices,
            returned_label=lake.returned_label,
            dates=days,
            hot_orders=find_hot_keys(items, "order_id", rows=rows),
            hot_products=hot_products,
            loaded_at=started,
        ),
        "fact_events": gold.build_fact_events(tables["events"], dates=days, loaded_at=started),
    }
    for name, df in built.items():
        day = FACTS[name].date_column
        # Records without a readable time stay in Bronze (see gold.undated).
        mode = "static" if days is None else "dynamic"
        write_partitioned(df.where(F.col(day).isNotNull()), lake.gold(name), [day], replace=mode)
    for name in built if days is not None else ():
        day = FACTS[name].date_column
        kept = of_days(read_or_empty(spark, lake.gold(name), CONTRACTS[name]), days, day)
        old = kept.where(F.col("gold_created_at") != started).select(day).distinct()
        drop_partitions(spark, lake.gold(name), day, [r[0] for r in old.collect()])
    facts = read_or_empty(spark, lake.gold("fact_orders"), schemas.FACT_ORDERS)
    lake.index.add_products(facts if days is None else of_days(facts, days, "order_date_id"), "order_date_id")


# --- dimensions


def rebuild_dimensions(spark: SparkSession, lake: Lake, arrived: DataFrame | None = None) -> None:
    """Refresh the dimensions; without `arrived` (narrow records, see day_index.ARRIVAL), new days,
    statuses and types are looked for in all of Bronze.

    Users and products are replaced by a pointer: without a single row, or when building one fails,
    the dimension stays as it was.
    """
    tables = bronze_tables(spark, lake)
    users = read_current(spark, lake.bronze("users"), schemas.USERS)
    write_current(gold.build_dim_users(users), lake.gold("dim_users"))
    if tables is None:
        return
    products = read_current(spark, lake.bronze("products"), schemas.PRODUCTS)
    ratings = lake.ratings.ratings(spark)
    write_current(gold.with_ratings(products, ratings), lake.gold("dim_products"))
    if arrived is None:
        arrived = union_all([arrivals(df) for df in tables.values()])
    days = arrived.select("day").distinct()
    found = {
        "dim_date": gold.build_dim_date(days, lake.first_day, lake.last_day),
        "dim_order_status": gold.build_dim_order_status(
            arrived.where("stream_type = 'orders'")
        ),
        "dim_event_type": gold.build_dim_event_type(arrived.where("stream_type = 'events'")),
    }
    for name, new in found.items():
        key, table = MERGED_DIMENSIONS[name], lake.gold_table(name)
        if table_exists(spark, table):
            if new.isEmpty():
                continue
            new = merge_by_key(spark.table(table), new, [key])
        if name in HASHED:
            new = fail_on_collisions(new, *HASHED[name])
        write_version(new.orderBy(key), table)


# --- the whole


def gold_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    merged = {
        name: spark.table(lake.gold_table(name))
        for name in MERGED_DIMENSIONS
        if table_exists(spark, lake.gold_table(name))
    }
    read = {n: read_current if n in REPLACED_DIMENSIONS else read_or_empty for n in CONTRACTS}
    return merged | {n: read[n](spark, lake.gold(n), s) for n, s in CONTRACTS.items()}


def publish_gold(
    spark: SparkSession, lake: Lake, days: DataFrame | None = None
) -> dict[str, int | None]:
    """Publish all dimensions and the fact rows of `days`."""
    tables = gold_tables(spark, lake)
    names = [n for n in (*MERGED_DIMENSIONS, *REPLACED_DIMENSIONS) if n in tables]
    held = REFERENCES_OF if lake.check_references else {}
    facts = [(replace(f, references=held.get(n, ())), tables[n]) for n, f in FACTS.items()]
    filters = lake.state("published_keys") if lake.key_filters else None
    return publish_all({n: tables[n] for n in names}, facts, lake.warehouse_database, days, filters)


def run_daily(spark: SparkSession, lake: Lake) -> dict[str, int | None]:
    """One run over everything that has arrived since the last one; any failure stops it.

    Starting again after a failure continues where it stopped, and a run without new files
    changes no fact. Afterwards the facts are those of a full build, also where records moved to
    other days or prices changed; only the days concerned are read and written.
    """
    create_database(spark, lake.gold_database, lake.gold("tables"))
    create_database(spark, lake.warehouse_database, f"{lake.root}/warehouse")
    stamps = land_static(spark, lake)
    land_stream(spark, lake)
    names = lake.pending.names(spark)
    days = materialize(pending_days(spark, lake), "days")
    if not days.isEmpty():
        rebuild_facts(spark, lake, days)
    archive_landing(spark, lake, stamps)
    rebuild_dimensions(spark, lake, pending_arrivals(spark, lake))
    published = publish_gold(spark, lake, days)
    lake.pending.clear(spark, names)
    lake.index.compact(spark)
    lake.ratings.compact(spark)
    return published


def summarize(spark: SparkSession, lake: Lake) -> DataFrame:
    """Row counts of all Gold tables, from the file footers."""
    return table_summary(gold_tables(spark, lake))
