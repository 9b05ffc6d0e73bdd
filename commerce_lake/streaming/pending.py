"""What has arrived and still has to be worked in."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from commerce_lake.shared import INTERMEDIATE
from commerce_lake.sinks import folders


@dataclass(frozen=True)
class PendingLog:
    """Small tables under names, kept until the work they stand for is done.

    A name written again is replaced, so a replayed micro-batch leaves one entry. Entries are removed
    after the work; where that fails, the work is done again.
    """

    path: str

    def add(self, name: str, rows: DataFrame) -> DataFrame:
        """Write an entry and return it as written."""
        place = f"{self.path}/{name}"
        rows.write.mode("overwrite").parquet(place, compression=INTERMEDIATE)
        return rows.sparkSession.read.schema(rows.schema).parquet(place)

    def names(self, spark: SparkSession, prefix: str = "") -> list[str]:
        """Complete entries; one whose writing was cut off has no mark of success."""
        found = [n for n in folders.children(spark, self.path) if n.startswith(prefix)]
        return [n for n in found if folders.exists(spark, f"{self.path}/{n}/_SUCCESS")]

    def read(self, spark: SparkSession, names: Sequence[str], schema: T.StructType) -> DataFrame:
        if not names:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{self.path}/{n}" for n in names])

    def clear(self, spark: SparkSession, names: Sequence[str]) -> None:
        for name in names:
            folders.remove(spark, f"{self.path}/{name}")
