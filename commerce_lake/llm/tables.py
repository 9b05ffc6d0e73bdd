"""Intermediate tables of these operators, and joins with a side of a checked size."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commerce_lake.shared import materialize

__all__ = ["keep", "forget", "drop_shuffles", "semi_by_size", "left_by_size", "read_table", "numbered"]

#: A side of up to this many bytes of data is sent to every executor; above, both are shuffled.
BROADCAST_BYTES = 16 << 20
#: Rows that one task numbers.
NUMBERED_ROWS = 200_000


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keep(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """A written copy in the shared folder: lost executors cost nothing that came before it."""
    return materialize(df, label, compression)


def forget(df: DataFrame) -> None:
    """Delete the files of a written copy that nothing will read again."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs.

    It does so once their plans are garbage in Python and in the driver's JVM, else up to half an hour later.
    """
    gc.collect()
    spark._jvm.System.gc()


def _small(df: DataFrame, row_bytes: int) -> bool:
    return df.count() * row_bytes <= BROADCAST_BYTES


def semi_by_size(df: DataFrame, keys: DataFrame, on: str, row_bytes: int = 16) -> DataFrame:
    """Rows of `df` with a key in `keys` (a written table): sent along if small, else shuffled."""
    return df.join(F.broadcast(keys) if _small(keys, row_bytes) else keys, on, "left_semi")


def left_by_size(df: DataFrame, side: DataFrame, on: str, row_bytes: int) -> DataFrame:
    """`df` left join `side` (a written table, one row a key): sent along if small, else shuffled."""
    return df.join(F.broadcast(side) if _small(side, row_bytes) else side, on, "left")


def numbered(df: DataFrame, key: str, order: list[str], name: str, rows: int) -> DataFrame:
    """Add `name`: 0, 1, ... without gaps among the rows of each key.

    No task sees a whole key: rows are dealt by a hash of `order` into parts of about
    NUMBERED_ROWS, numbered there, and the sizes of the parts before are added. `df` must be a
    written table (it is read twice), `rows` its length. Rows equal in `order` are
    interchangeable.
    """
    parts = max(1, -(-rows // NUMBERED_ROWS))
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    sizes = dealt.groupBy(key, "_part").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col(key).alias("_key"),
        F.col("_part").alias("_of"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
    )
    within = Window.partitionBy(key, "_part").orderBy(*order)
    return (
        dealt.withColumn("_at", F.row_number().over(within) - 1)
        .join(sizes, (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_of")))
        .withColumn(name, F.col("_at") + F.col("_before"))
        .drop("_part", "_at", "_key", "_of", "_before")
    )
