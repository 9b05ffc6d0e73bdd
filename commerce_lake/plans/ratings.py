"""Product ratings kept up to date by what arrives.

A review may be sent again, corrected or for another product; the one that arrived last counts. Each
addition looks up earlier records of the reviews it brings, takes back what these gave their
products, and adds what they give now. The signed sums and counts are stored; a product's rating is
their total, and reviews that did not come again are not read.

Records are kept in buckets by a hash of the review, of which an addition reads those that its
reviews fall in. Additions are numbered: one that is repeated, as after a failure, replaces what it
wrote before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake import schemas
from commerce_lake.operators.dedup import dedup_by_key
from commerce_lake.plans.gold import ARRIVAL, with_content
from commerce_lake.sinks import folders, pointer
from commerce_lake.sources.files import read_or_empty

_RECORD = schemas.columns(
    f"key string, product_id string, rating double, has_id boolean, {ARRIVAL} string, bucket int, batch bigint"
)
_CHANGE = schemas.columns("product_id string, rating_sum double, rated bigint, review_count bigint, batch bigint")
# The number under which merged additions are kept.
_MERGED = -1


@dataclass(frozen=True)
class RatingState:
    """The state at `path`; the number of buckets must not change afterwards."""

    path: str
    buckets: int = 256

    def exists(self, spark: SparkSession) -> bool:
        return pointer.current_path(spark, self.path) is not None

    def _place(self, spark: SparkSession) -> str:
        place = pointer.current_path(spark, self.path)
        if place is None:
            place = pointer.new_version(spark, self.path)
            pointer.commit_version(spark, self.path, place)
        return place

    def _records(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, f"{self._place(spark)}/records", _RECORD)

    def _changes(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, f"{self._place(spark)}/changes", _CHANGE)

    def add(self, reviews: DataFrame, number: int) -> None:
        """Work in Bronze rows of reviews (a written table) as addition `number`, from 0.

        Reviews without an id repeat each other only if they agree in all columns but the arrival.
        """
        spark = reviews.sparkSession
        rows = with_content(reviews.select(*schemas.BRONZE_STREAM.names), "review_id")
        key = F.when(F.col("review_id").isNull(), F.concat(F.lit("content "), "_content"))
        key = F.coalesce(key, F.concat(F.lit("id "), "review_id"))
        new = rows.select(
            key.alias("key"), "product_id", "rating", F.col("review_id").isNotNull().alias("has_id"), ARRIVAL,
            F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int").alias("bucket"),
            F.lit(number).cast("bigint").alias("batch"),
        )
        touched = [r[0] for r in new.select("bucket").distinct().collect()]  # at most `buckets`
        held = self._records(spark).where(F.col("bucket").isin(touched) & (F.col("batch") != number))
        held = held.join(new.select("key").distinct(), "key", "left_semi").select(*new.columns)
        before, after = _counting(held), _counting(held.unionByName(new))
        change = _signed(after, 1).unionByName(_signed(before, -1)).groupBy("product_id").agg(
            *[F.sum(c).alias(c) for c in ("rating_sum", "rated", "review_count")]
        )
        place = self._place(spark)
        change = change.where("rating_sum <> 0 OR rated <> 0 OR review_count <> 0")
        change.write.mode("overwrite").parquet(f"{place}/changes/batch={number}")
        writer = new.distinct().write.mode("overwrite").partitionBy("bucket", "batch")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{place}/records")

    def ratings(self, spark: SparkSession) -> DataFrame:
        """Mean rating and number of reviews of each product that has rated ones."""
        total = self._changes(spark).groupBy("product_id").agg(
            *[F.sum(c).alias(c) for c in ("rating_sum", "rated", "review_count")]
        )
        mean = F.round(F.col("rating_sum") / F.col("rated"), 2)
        return total.where("rated > 0").select("product_id", mean.alias("avg_rating"), "review_count")

    def compact(self, spark: SparkSession, most_files: int = 16) -> bool:
        """Merge the additions so far, if they have more than `most_files` files a bucket on average.

        Only between runs: a merged addition cannot be repeated any more.
        """
        if not self.exists(spark) or folders.count_files(spark, self._place(spark)) <= most_files * self.buckets:
            return False
        version = pointer.new_version(spark, self.path)
        total = self._changes(spark).groupBy("product_id").agg(
            *[F.sum(c).alias(c) for c in ("rating_sum", "rated", "review_count")]
        )
        total.write.parquet(f"{version}/changes/batch={_MERGED}")
        rows = self._records(spark).withColumn("batch", F.lit(_MERGED).cast("bigint")).distinct()
        rows.hint("rebalance", F.col("bucket")).write.partitionBy("bucket", "batch").parquet(f"{version}/records")
        pointer.commit_version(spark, self.path, version)
        return True


def _counting(records: DataFrame) -> DataFrame:
    """Of each review the record that counts; unrated ones give nothing."""
    last = dedup_by_key(records.select("key", "product_id", "rating", "has_id", ARRIVAL), ["key"], [ARRIVAL])
    return last.where(F.col("rating").isNotNull())


def _signed(records: DataFrame, sign: int) -> DataFrame:
    return records.select(
        "product_id",
        (sign * F.col("rating")).alias("rating_sum"),
        F.lit(sign).cast("bigint").alias("rated"),
        (sign * F.col("has_id").cast("bigint")).alias("review_count"),
    )
