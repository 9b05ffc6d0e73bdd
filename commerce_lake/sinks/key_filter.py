"""Which days of a published table may hold a key: Bloom filters of its days, kept as rows.

Each day has a filter for each addition, of 2^size blocks of 64 bits. A key sets a few bits of one block;
blocks that no key fell in have no row. The filters only say which partitions are to be read: the keys in
there are compared afterwards, so a false positive costs a read and never a row. A key that was added is
always found.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake import schemas
from commerce_lake.sinks import folders
from commerce_lake.sources.files import read_or_empty

#: Bits that a key sets in its block, and keys a block is meant for (a key takes about ten bits).
BITS = 6
KEYS = 6
#: Sizes there are (logarithms of the number of blocks). The smallest is large enough that the keys of a
#: batch do not meet in few blocks; small days fill few of them.
SIZES = (12, 16, 20, 24, 28, 32, 36)

BLOCK = schemas.columns("day date, block bigint, bits bigint, size int")


def key_bits(key: Column) -> Column:
    """The bits that a key sets in its block."""
    bits = F.lit(0).cast("bigint")
    places = F.xxhash64(key, F.lit("bits"))
    for k in range(BITS):
        place = F.shiftrightunsigned(places, 6 * k).bitwiseAND(F.lit(63).cast("bigint"))
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int")))
    return bits


def key_block(key: Column, size: Column) -> Column:
    """The block of a key among 2^size."""
    last = F.call_function("shiftleft", F.lit(1).cast("bigint"), size) - F.lit(1).cast("bigint")
    return F.xxhash64(key).bitwiseAND(last)


def _size(keys: Column) -> Column:
    """The smallest size that leaves a block no more than KEYS keys, on average."""
    chosen = F.lit(SIZES[-1])
    for size in reversed(SIZES[:-1]):
        chosen = F.when(keys <= KEYS * 2**size, F.lit(size)).otherwise(chosen)
    return chosen


@dataclass(frozen=True)
class KeyFilter:
    """The filters at `path` of one version of a table."""

    path: str

    @property
    def _blocks(self) -> str:
        return f"{self.path}/blocks"

    def exists(self, spark: SparkSession) -> bool:
        return folders.exists(spark, f"{self.path}/_complete")

    def blocks(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self._blocks, BLOCK)

    def build(self, rows: DataFrame, key: str, day: str) -> None:
        """Start from all rows of the table; filters that were begun before are left behind."""
        spark = rows.sparkSession
        folders.remove(spark, self.path)
        self.add(rows, key, day)
        folders.replace_text(spark, f"{self.path}/_complete", "")

    def add(self, rows: DataFrame, key: str, day: str) -> None:
        """Add the keys of `rows` (a table that can be read twice) under their days.

        Do so before the rows are appended: if that fails, the keys are false positives. Rows
        without key are left out. Keys of one day are spread by their blocks, however many.
        """
        keys = rows.select(F.col(key).alias("key"), F.col(day).cast("date").alias("day"))
        keys = keys.where("key IS NOT NULL")
        # One row a day, of which a calendar has fewer than four million.
        sizes = keys.groupBy("day").agg(_size(F.count("*")).alias("size"))
        sizes = F.broadcast(sizes.withColumnRenamed("day", "_day"))
        sized = keys.join(sizes, F.col("day").eqNullSafe(F.col("_day")))
        blocks = sized.groupBy("size", "day", key_block(F.col("key"), F.col("size")).alias("block"))
        found = blocks.agg(F.bit_or(key_bits(F.col("key"))).alias("bits"))
        found = found.select(*BLOCK.names).hint("rebalance", F.col("size"))
        found.write.mode("append").partitionBy("size").parquet(self._blocks)

    def days_of(self, rows: DataFrame, key: str) -> DataFrame:
        """Days (`day`) that may hold a key of `rows`."""
        held = self.blocks(rows.sparkSession)
        sizes = [r[0] for r in held.select("size").distinct().collect()]  # some of SIZES
        asked = rows.select(F.col(key).alias("key")).where("key IS NOT NULL")
        asked = asked.withColumn("size", F.explode(F.array(*[F.lit(s) for s in sizes]).cast("array<int>")))
        asked = asked.select(
            "size", key_block(F.col("key"), F.col("size")).alias("block"), key_bits(F.col("key")).alias("asked")
        ).distinct()
        met = held.join(asked, ["size", "block"])
        return met.where(F.col("bits").bitwiseAND(F.col("asked")) == F.col("asked")).select("day").distinct()
