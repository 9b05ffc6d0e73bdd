"""Tables at a path that are replaced as a whole, committed by a pointer.

Every replacement is a folder of its own, `path/v000007_1f3a9c2e`; the file `path/_current` names the
one that counts and is replaced by a rename. A write that fails, or gives no rows, changes nothing;
readers that started before keep their files, since the version before stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from commerce_lake.sinks import folders

_POINTER = "_current"


def current_path(spark: SparkSession, path: str) -> str | None:
    """The folder that counts, or None before the first commit."""
    name = folders.read_text(spark, f"{path}/{_POINTER}")
    return f"{path}/{name}" if name else None


def read_current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The committed table; empty before the first commit."""
    place = current_path(spark, path)
    if place is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(place)


def new_version(spark: SparkSession, path: str) -> str:
    """A folder for the next version, not created yet."""
    name = folders.read_text(spark, f"{path}/{_POINTER}") or "v000000_"
    return f"{path}/v{int(name[1:7]) + 1:06d}_{uuid.uuid4().hex[:8]}"


def commit_version(spark: SparkSession, path: str, version: str, *, keep: int = 2) -> None:
    """Make a written version the current one; of the others, `keep` - 1 that were current stay."""
    before = folders.read_text(spark, f"{path}/{_POINTER}")
    name = version.rpartition("/")[2]
    folders.replace_text(spark, f"{path}/{_POINTER}", name)
    older = [n for n in folders.children(spark, path) if n.startswith("v") and n not in (name, before)]
    for old in older[: len(older) - max(0, keep - 2)]:
        folders.remove(spark, f"{path}/{old}")


def write_current(df: DataFrame, path: str, *, keep: int = 2) -> int:
    """Replace the table at `path` by `df`, which may read from it. Returns its rows.

    An empty `df` leaves the table as it is and returns 0; so does a failure, which is raised.
    """
    spark = df.sparkSession
    version = new_version(spark, path)
    try:
        df.write.parquet(version)
        rows = spark.read.schema(df.schema).parquet(version).count()  # from the file footers
    except Exception:
        folders.remove(spark, version)
        raise
    if rows:
        commit_version(spark, path, version, keep=keep)
    else:
        folders.remove(spark, version)
    return rows
