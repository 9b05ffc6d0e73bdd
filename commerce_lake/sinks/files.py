"""Parquet and JSON writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F


# Records in a packed text file, which one task reads.
PACKED_ROWS = 500_000


def packed(writer: DataFrameWriter) -> DataFrameWriter:
    """Text files (CSV, JSON) with gzip, cut so that they can be read by many tasks."""
    return writer.options(compression="gzip", maxRecordsPerFile=PACKED_ROWS)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the table at `path`. `df` must not read from it (see sinks.versions)."""
    df.write.mode("overwrite").parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    *,
    replace: str = "dynamic",
    files_per_partition: int | None = None,
    allow_null: bool = False,
) -> None:
    """Write one folder per value of `by`.

    replace="dynamic" replaces the partitions that occur in `df` and leaves all others, "static"
    replaces the whole table, "append" adds to it. Rows are first brought together by partition
    to keep the number of files low: by default Spark sizes the files itself and splits big
    partitions over several tasks; `files_per_partition` sets an upper limit on their number.

    Rows with a null partition value are refused unless `allow_null`: a dynamic overwrite would
    replace all earlier rows of that kind.
    """
    if replace not in ("dynamic", "static", "append"):
        raise ValueError(f"unknown replace mode {replace!r}")
    for column in () if allow_null else by:
        df = df.withColumn(
            column,
            F.when(F.col(column).isNotNull(), F.col(column)).otherwise(
                F.raise_error(F.lit(f"null in partition column {column}")).cast(
                    df.schema[column].dataType
                )
            ),
        )
    columns = [F.col(c) for c in by]
    if files_per_partition is None:
        df = df.hint("rebalance", *columns)
    else:
        rest = [c for c in df.columns if c not in by]
        df = df.repartition(*columns, F.pmod(F.xxhash64(*rest), F.lit(files_per_partition)))
    mode = "append" if replace == "append" else "overwrite"
    writer = df.write.mode(mode).partitionBy(*by)
    if replace != "append":
        writer = writer.option("partitionOverwriteMode", replace)
    writer.parquet(path)


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence) -> None:
    """Delete the folders of these values of the partition column."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for value in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
        folder.getFileSystem(conf).delete(folder, True)


def write_sorted(df: DataFrame, path: str, *order: str) -> None:
    """Replace the table at `path`, its files in global order."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON record per line; read back with `multi_line=False`.

    Field names and nulls are most of such text, so files are packed. A packed file is read by one
    task and therefore holds at most PACKED_ROWS records, however many a task writes.
    """
    packed(df.write.mode(mode)).option("ignoreNullFields", False).json(path)


def write_external(
    df: DataFrame, target: str, options: Mapping[str, str], table: str, mode: str
) -> None:
    """Write to a table of an external database (any data source with `dbtable`)."""
    df.write.format(target).options(**options).option("dbtable", table).mode(mode).save()
