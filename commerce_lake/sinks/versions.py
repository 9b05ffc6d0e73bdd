"""Tables that are replaced as a whole while readers keep working.

Each refresh writes a new table `name__v000007_1f3a9c2e` and then points the view `name` at it, a
single catalog call. Until then readers see the old version; a failed write changes nothing. The
last part of the name is random, so that files left behind by a failed write are never in the way.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MARK = "__v"
# Property of a view that names the table it shows.
_SHOWN = "commerce_lake.version"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def _number(table: str) -> int:
    return int(table.lower().rpartition(_MARK)[2].partition("_")[0])


def versions(spark: SparkSession, name: str) -> list[str]:
    """Stored versions of `database.name`, oldest first."""
    database, short = name.split(".")
    pattern = re.compile(re.escape(short.lower() + _MARK) + r"\d+_[0-9a-f]+$")
    found = [
        t.name
        for t in spark.catalog.listTables(database, f"{short}{_MARK}*")
        if pattern.match(t.name.lower())
    ]
    return [f"{database}.{n}" for n in sorted(found, key=_number)]


def current_version(spark: SparkSession, name: str) -> str | None:
    """The table that the view `database.name` shows, or None if there is no such view."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "VIEW":
        return None
    found = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    stored = versions(spark, name)  # views of earlier releases show the newest
    return found.get(_SHOWN) or (stored[-1] if stored else None)


def _show(spark: SparkSession, name: str, table: str) -> None:
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # a plain table of an earlier release makes room for the view
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_SHOWN}' = '{table}') AS SELECT * FROM {table}")


def write_version(
    df: DataFrame, name: str, *, keep: int = 2, by: Sequence[str] = (), allow_empty: bool = False
) -> int:
    """Replace `database.name` by `df`, which may read from it. Returns the number of rows.

    An empty `df` leaves the table as it is and returns 0, unless `allow_empty`. `by` names partition
    columns. The `keep` newest versions stay, for readers that still use the one before.
    """
    spark = df.sparkSession
    stored = versions(spark, name)
    number = _number(stored[-1]) + 1 if stored else 1
    stage = f"{name}{_MARK}{number:06d}_{uuid.uuid4().hex[:8]}"
    writer = (df.hint("rebalance", *[F.col(c) for c in by]) if by else df).write
    # The table appears in the catalog only when it is complete.
    writer = writer.partitionBy(*by) if by else writer
    writer.format("parquet").mode("errorifexists").saveAsTable(stage)
    try:
        rows = spark.table(stage).count()
        if rows or allow_empty:
            _show(spark, name, stage)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
        raise
    outdated = (stored + [stage])[:-keep] if rows or allow_empty else [stage]
    for table in outdated:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return rows
