"""Intermediate tables in the folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


#: Packing of tables that only the next steps read.
INTERMEDIATE = "zstd"


@lru_cache(maxsize=1)
def _folder_of_this_process() -> str:
    return tempfile.mkdtemp(prefix="commerce-lake-")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`.

    Only a local session may go without it; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _folder_of_this_process()


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses (not created yet)."""
    return f"{shared_folder(spark)}/commerce_lake/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write `df` as parquet in the shared folder and read it back.

    Cuts the lineage, so that later stages lost with an executor are recomputed from the table.
    Without `compression` the session's setting counts.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
