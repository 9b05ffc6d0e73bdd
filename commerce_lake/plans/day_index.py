"""On which days the records of an id lie: an index that grows by what arrives.

Bronze is partitioned by type and day, and a record may come again under another day. The index
answers, without reading Bronze, which days the facts of arrived records belong to, and which other
days hold records that the facts of a day are made of.

Entries (ids and days only) are kept in buckets by a hash of the id. A lookup reads the buckets that
its ids fall in. Each arrival adds its entries, and then links between days: an id with records on
two of them, or an order with records on one and items on the other. Links are pairs of days, so there
are few of them whatever the number of records.

`products` holds the days on which a product has facts; it is filled by those who build facts.

Adding the same entries again changes no answer. `compact` brings each bucket back to one file.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake import schemas
from commerce_lake.functions.cleaning import parse_date
from commerce_lake.operators.days import of_days
from commerce_lake.operators.merge import union_distinct
from commerce_lake.shared import INTERMEDIATE, materialize, new_folder
from commerce_lake.sinks import folders, pointer
from commerce_lake.sources.files import read_or_empty

#: Narrow records, as arrivals are logged and indexed. `day` is null for unreadable times.
ARRIVAL = schemas.columns(
    "stream_type string, order_id string, order_item_id string, event_id string, "
    "product_id string, order_status string, event_type string, day date"
)
# What is looked up (`relation`) by which id (`key`): days of an order, an event, an order's items, an
# item (with its order as `other`), a product's facts.
ENTRY = schemas.columns("relation string, key string, other string, day date")
# Link kinds: records of one order, item or event on two days; items on another day than the order.
LINK = schemas.columns("kind string, day date, other date")
BUCKET = "bucket"


def arrivals(flat: DataFrame) -> DataFrame:
    """The narrow columns of Bronze rows of known types."""
    known = flat.where(F.col("stream_type").isin(*schemas.STREAM_TYPES))
    return known.select(*[c for c in ARRIVAL.names if c != "day"], parse_date("event_time").alias("day"))


def _choose(branches: Mapping[str, Column], of: str) -> Column:
    """The branch that the value of a column names; an empty array for others."""
    chosen = F.array()
    for value, result in branches.items():
        chosen = F.when(F.col(of) == value, result).otherwise(chosen)
    return chosen


def _entries(rows: DataFrame) -> DataFrame:
    """What is kept of arrived records; not yet distinct."""

    def entry(relation: str, key: str, other: Column | None = None) -> Column:
        other = F.lit(None).cast("string") if other is None else other
        return F.struct(F.lit(relation).alias("relation"), F.col(key).alias("key"), other.alias("other"), "day")

    of_type = {
        "orders": F.array(entry("orders", "order_id")),
        "events": F.array(entry("events", "event_id")),
        "order_items": F.array(
            entry("order_items", "order_item_id", F.col("order_id")), entry("items_of_orders", "order_id")
        ),
    }
    known = rows.where(F.col("stream_type").isin(*of_type))
    found = known.select(F.explode(_choose(of_type, "stream_type")).alias("e")).select("e.*")
    return found.where(F.col("key").isNotNull())


@dataclass(frozen=True)
class DayIndex:
    """The index at `path`; the number of buckets must not change afterwards."""

    path: str
    buckets: int = 256

    @property
    def _held(self) -> str:
        return f"{self.path}/entries"

    @property
    def _linked(self) -> str:
        return f"{self.path}/links"

    def bucket(self, key: Column | str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def exists(self, spark: SparkSession) -> bool:
        return folders.exists(spark, f"{self.path}/_complete")

    def _append(self, entries: DataFrame) -> None:
        spark = entries.sparkSession
        place = pointer.current_path(spark, self._held)
        if place is None:
            place = pointer.new_version(spark, self._held)
            pointer.commit_version(spark, self._held, place)
        by = ["relation", BUCKET]
        marked = entries.withColumn(BUCKET, self.bucket("key")).hint("rebalance", *[F.col(c) for c in by])
        marked.write.mode("append").partitionBy(*by).parquet(place)

    def entries(self, spark: SparkSession) -> DataFrame:
        """All entries, with their bucket."""
        schema = T.StructType([*ENTRY.fields, T.StructField(BUCKET, T.IntegerType())])
        place = pointer.current_path(spark, self._held)
        return spark.createDataFrame([], schema) if place is None else read_or_empty(spark, place, schema)

    def _near(self, asked: DataFrame) -> DataFrame:
        """Entries in the buckets that the (relation, key) asked for fall in; no others are read."""
        asked = asked.where(F.col("key").isNotNull())
        touched: dict[str, list[int]] = {}
        for relation, bucket in asked.select("relation", self.bucket("key")).distinct().collect():
            touched.setdefault(relation, []).append(bucket)  # at most `buckets` each
        wanted = F.lit(False)
        for relation, buckets in touched.items():
            wanted = wanted | ((F.col("relation") == relation) & F.col(BUCKET).isin(sorted(buckets)))
        return self.entries(asked.sparkSession).where(wanted).drop(BUCKET)

    def lookup(self, asked: DataFrame, days: DataFrame | None = None) -> DataFrame:
        """Entries of the (relation, key) asked for, with `days` those of these days; only the buckets that
        these fall in are read."""
        held = self._near(asked) if days is None else of_days(self._near(asked), days, "day")
        return held.join(asked.select("relation", "key"), ["key", "relation"], "left_semi").distinct()

    # --- growing

    def add(self, rows: DataFrame) -> None:
        """Add arrived records (a written table with the columns ARRIVAL), then their links."""
        spark, place = rows.sparkSession, new_folder(rows.sparkSession, "entries")
        try:
            _entries(rows).distinct().write.parquet(place, compression=INTERMEDIATE)
            entries = spark.read.schema(ENTRY).parquet(place)
            self._append(entries)
            self._link(entries)
        finally:
            folders.remove(spark, place)

    def _link(self, new: DataFrame) -> None:
        def ask(kind: str, relation: str, first: bool) -> Column:
            # `first`: the day of the new entry comes first in the pair.
            return F.struct(F.lit(kind).alias("kind"), F.lit(relation).alias("_asked"), F.lit(first).alias("first"))

        asks = {
            "orders": F.array(ask("orders", "orders", True), ask("of_order", "items_of_orders", True)),
            "items_of_orders": F.array(ask("of_order", "orders", False)),
            "order_items": F.array(ask("order_items", "order_items", True)),
            "events": F.array(ask("events", "events", True)),
        }
        asked = new.select("key", "day", F.explode(_choose(asks, "relation")).alias("a"))
        asked = asked.select("key", "day", "a.kind", F.col("a._asked").alias("relation"), "a.first")
        # Each side is shuffled once; what repeats goes with the pairs, of which there are few.
        held = self._near(asked).select("relation", "key", F.col("day").alias("_day"))
        met = asked.join(held, ["key", "relation"]).where(~F.col("day").eqNullSafe(F.col("_day")))
        one = F.struct(F.when(F.col("first"), F.col("day")).otherwise(F.col("_day")).alias("day"),
                       F.when(F.col("first"), F.col("_day")).otherwise(F.col("day")).alias("other"))
        back = F.struct(F.col("_day").alias("day"), F.col("day").alias("other"))
        pairs = F.when(F.col("kind") == "of_order", F.array(one)).otherwise(F.array(one, back))
        links = met.select("kind", F.explode(pairs).alias("p")).select("kind", "p.*").distinct()
        links.coalesce(1).write.mode("append").parquet(self._linked)

    def add_products(self, facts: DataFrame, day: str) -> None:
        """Add the days on which the products of facts have some."""
        known = facts.where("product_id IS NOT NULL")
        entry = [F.lit("products"), F.col("product_id"), F.lit(None).cast("string"), F.col(day)]
        self._append(known.select(*[c.alias(n) for c, n in zip(entry, ENTRY.names, strict=True)]).distinct())

    def build(self, rows: DataFrame) -> None:
        """Start from all records there are; an index that was begun before is left behind."""
        spark = rows.sparkSession
        folders.remove(spark, self._held)
        folders.remove(spark, self._linked)
        self.add(rows)
        self.complete(spark)

    def complete(self, spark: SparkSession) -> None:
        folders.replace_text(spark, f"{self.path}/_complete", "")

    def compact(self, spark: SparkSession, most_files: int = 16) -> bool:
        """Rewrite the entries if there are more than `most_files` files a bucket on average.

        The new files count from one rename on; a failure leaves the old ones.
        """
        place = pointer.current_path(spark, self._held)
        if place is None or folders.count_files(spark, place) <= most_files * self.buckets:
            return False
        version = pointer.new_version(spark, self._held)
        by = ["relation", BUCKET]
        rows = self.entries(spark).distinct().hint("rebalance", *[F.col(c) for c in by])
        rows.write.partitionBy(*by).parquet(version)
        pointer.commit_version(spark, self._held, version)
        return True

    # --- answers

    def affected_days(self, rows: DataFrame, products: DataFrame | None = None) -> DataFrame:
        """Days (`day`, not null) whose facts may change by these records, or by these products.

        An item belongs to its order's day, whatever its own time. So these are all days that the
        orders and events concerned ever had, also the orders an item was sent with before. The days
        that orders and events came with are among them; ids are looked up for those alone that are
        not, and only if the links between days allow for any.
        """
        spark, new = rows.sparkSession, _entries(rows)
        came = materialize(new.select("relation", "day").distinct(), "came")
        days = came.where("relation IN ('orders', 'events') AND day IS NOT NULL").select("day").distinct()
        far = materialize(self._reached(came).join(days, "day", "left_anti").where("day IS NOT NULL"), "far")
        found = [days]
        if not far.isEmpty():
            # Items that may have been sent with an order that has one of these days.
            linked = self.links(spark, "of_order")
            near = far.union(linked.join(far, "day", "left_semi").select("other")).distinct()
            items = of_days(self._near(new.where("relation = 'order_items'")), near, "day")
            items = items.join(new.where("relation = 'order_items'").select("key"), "key", "left_semi")
            before = items.select(F.lit("orders").alias("relation"), F.col("other").alias("key"))
            named = new.where("relation IN ('orders', 'items_of_orders')").select(F.lit("orders").alias("relation"), "key")
            asked = [before, named, new.where("relation = 'events'").select("relation", "key")]
            found.append(self.lookup(materialize(union_distinct(asked), "asked"), far).select("day"))
        if products is not None:
            asked = products.select(F.lit("products").alias("relation"), F.col("product_id").alias("key")).distinct()
            found.append(self.lookup(materialize(asked, "asked")).select("day"))
        return union_distinct(found).where("day IS NOT NULL")

    def _reached(self, came: DataFrame) -> DataFrame:
        """Days that orders and events of arrived entries (relation, day) can have by the links between days; null too.

        Any other day of an order, item or event is linked with the one that came, and so is the day
        of an item's order. No ids are looked up for that.
        """
        def with_linked(some: DataFrame, kind: str, by: str = "day", to: str = "other") -> DataFrame:
            linked = self.links(came.sparkSession, kind).select(F.col(by).alias("_by"), F.col(to).alias("_to"))
            met = linked.join(some.select("day").distinct(), F.col("_by").eqNullSafe(F.col("day")), "left_semi")
            return some.select("day").union(met.select("_to"))

        def of(relation: str) -> DataFrame:
            return came.where(F.col("relation") == relation)

        items = with_linked(with_linked(of("order_items").union(of("items_of_orders")), "order_items"), "of_order", "other", "day")
        return union_distinct([with_linked(of("orders"), "orders"), with_linked(of("events"), "events"), items])

    def links(self, spark: SparkSession, kind: str) -> DataFrame:
        return read_or_empty(spark, self._linked, LINK).where(F.col("kind") == kind).select("day", "other")

    def linked_days(self, days: DataFrame) -> DataFrame:
        """(kind, day): the Bronze days that hold records of the facts of `days`, by type of record.

        Null stands for undated records. An order's facts need its records of all days, the items
        that name it, and all other records of these items.
        """
        spark = days.sparkSession

        def with_linked(some: DataFrame, kind: str) -> DataFrame:
            linked = of_days(self.links(spark, kind), some, "day").select(F.col("other").alias("day"))
            return some.select("day").unionByName(linked)

        items = with_linked(with_linked(days, "of_order"), "order_items")
        found = {"orders": with_linked(days, "orders"), "events": with_linked(days, "events"), "order_items": items}
        return union_distinct([df.select(F.lit(kind).alias("kind"), "day") for kind, df in found.items()])

    def records_of(self, tables: Mapping[str, DataFrame], days: DataFrame, day: str) -> dict[str, DataFrame]:
        """Records that the facts of `days` are made of: the partitions of Bronze tables (partitioned
        by the column `day`) that can hold any.

        An order, item or event of these days has all its records there. One of which records are
        missing has no record on these days, or names no order that has; its facts, if any came out,
        would be of other days, which the builders leave out.
        """
        near = materialize(self.linked_days(days), "near")
        kinds = ("orders", "order_items", "events")
        return {n: of_days(tables[n], near.where(F.col("kind") == n).select("day"), day) for n in kinds}
