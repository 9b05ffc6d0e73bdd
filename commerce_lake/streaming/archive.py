"""Moving files out of the landing folder once their records are safe."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from commerce_lake.sinks import folders


def processed_files(spark: SparkSession, checkpoint: str, names: list[str]) -> list[str]:
    """Those of the given file names that committed micro-batches of a file stream have read, by the
    stream's own log."""
    log, commits = f"{checkpoint}/sources/0", folders.children(spark, f"{checkpoint}/commits")
    done = [int(n) for n in commits if n.isdigit()]
    if not done or not names or not folders.exists(spark, log):
        return []
    entry = F.from_json("value", "path string, batchId bigint")
    lines = spark.read.text(log).select(entry.alias("e")).where(F.col("e.batchId") <= max(done))
    # Addresses are percent-encoded, but a plus sign is itself.
    last = F.replace(F.element_at(F.split("e.path", "/"), -1), F.lit("+"), F.lit("%2B"))
    seen = lines.select(F.url_decode(last).alias("name"))
    here = spark.createDataFrame([(n,) for n in names], "name string")
    return sorted(r["name"] for r in here.join(seen, "name", "left_semi").collect())


def archive_stream(spark: SparkSession, landing: str, checkpoint: str, archive: str) -> list[str]:
    """Move all files that the stream has read, its last batch too; others stay. Returns their names."""
    names = [n for n in folders.children(spark, landing) if not n.startswith((".", "_"))]
    moved = processed_files(spark, checkpoint, names)
    for name in moved:
        folders.move(spark, f"{landing}/{name}", f"{archive}/{name}")
    return moved


def archive_file(spark: SparkSession, path: str, archive: str, stamp: str | None) -> bool:
    """Move a file that has been read, unless it was replaced since (see `folders.stamp`)."""
    if stamp is None or folders.stamp(spark, path) != stamp:
        return False
    folders.move(spark, path, f"{archive}/{path.rpartition('/')[2]}")
    return True
