"""CSV, JSON and parquet readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake import schemas
from commerce_lake.functions.cleaning import cast_columns, strip_column_names, to_int
from commerce_lake.operators.days import of_days
from commerce_lake.operators.envelope import flatten_envelope
from commerce_lake.operators.merge import union_all
from commerce_lake.sinks import folders

# Text of records that could not be parsed.
CORRUPT = "_corrupt_record"
# Value of `stream_type` under which Bronze keeps them.
REJECTED = "_rejected"
EVENT_DATE = "event_date"


def _no_such_path(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    *,
    missing_ok: bool = False,
) -> DataFrame:
    """CSV with a header row; blanks around column names are removed.

    With a schema, columns are picked by name and cast, in one pass (nothing is inferred); values
    that do not fit become null. A missing file is an empty table if `missing_ok`. Several files
    must have the same columns in the same order; one that does not makes the read fail, since
    its values would land under the wrong names (`read_csv_by_name` reads them).
    """
    try:
        df = spark.read.csv(path, header=True, enforceSchema=False)
    except AnalysisException as error:
        if missing_ok and schema is not None and _no_such_path(error):
            return spark.createDataFrame([], schema)
        raise
    df = strip_column_names(df)
    if schema is None:
        return df
    schemas.require_columns(df, *schema.names)
    return cast_columns(
        df.select(*schema.names), {f.name: f.dataType.simpleString() for f in schema}
    )


def read_csv_by_name(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    optional: Sequence[str] = (),
    missing_ok: bool = False,
) -> DataFrame:
    """CSV files that may have their columns in different orders, or further ones, each with a header.

    Files are grouped by their header line, and each group is read by its own names, so values never
    land under a wrong one. A column that a group lacks is null if it is `optional`; otherwise the
    read fails. Headers are read by the driver, one line a file.
    """
    groups: dict[str | None, list[str]] = {}
    for file in folders.files(spark, path):
        groups.setdefault(folders.first_line(spark, file), []).append(file)
    groups.pop(None, None)  # files without a line
    if not groups:
        if missing_ok:
            return spark.createDataFrame([], schema)
        raise FileNotFoundError(f"no CSV file with a header at {path}")
    found = []
    for _, files in sorted(groups.items()):
        df = read_csv(spark, files)
        lacking = [n for n in optional if n in schema.names and n not in df.columns]
        df = df.withColumns({n: F.lit(None).cast("string") for n in lacking})
        schemas.require_columns(df, *schema.names)
        types = {f.name: f.dataType.simpleString() for f in schema}
        found.append(cast_columns(df.select(*schema.names), types))
    return union_all(found)


def envelope_file_schema() -> T.StructType:
    """The envelope as it is read: quantity may be written `2` or `2.0`, bad records are kept."""
    data = T.StructType(
        [
            T.StructField(f.name, T.DoubleType() if f.name == "quantity" else f.dataType)
            for f in schemas.DATA_FIELDS
        ]
    )
    fields = [T.StructField("data", data) if f.name == "data" else f for f in schemas.ENVELOPE]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def envelope_columns(raw: DataFrame) -> DataFrame:
    """Files as read to flat Bronze columns plus the text of bad records."""
    return (
        flatten_envelope(raw)
        .withColumn("quantity", to_int(F.col("quantity")))
        .select(*schemas.BRONZE_STREAM.names, CORRUPT)
    )


def read_envelopes(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Envelope files as flat rows; unparseable records carry their text in `_corrupt_record`.

    Array files need `multi_line`, and each is read by one task. One record per line
    (`multi_line=False`) can be split, so prefer it for big files.
    """
    raw = spark.read.json(path, schema=envelope_file_schema(), multiLine=multi_line)
    return envelope_columns(raw)


def read_json_table(
    spark: SparkSession, path: str, schema: T.StructType, *, multi_line: bool = True
) -> DataFrame:
    """A JSON table with a flat schema; unknown fields are ignored, missing ones null."""
    return spark.read.json(path, schema=schema, multiLine=multi_line)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet; the schema, if given, also fixes the types of partition columns."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet, or an empty table if nothing was written yet; any other error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if _no_such_path(error):
            return spark.createDataFrame([], schema)
        raise


def bronze_schema(by_date: bool = False) -> T.StructType:
    extra = [T.StructField(EVENT_DATE, T.DateType())] if by_date else []
    return T.StructType([*schemas.BRONZE_STREAM.fields, *extra])


def read_bronze(
    spark: SparkSession,
    path: str,
    stream_type: str | None = None,
    *,
    by_date: bool = False,
    dates: Sequence | DataFrame | None = None,
    keep_date: bool = False,
) -> DataFrame:
    """Bronze rows, without rejected ones; only the partitions asked for are read.

    `dates` (a list, or a table with a column `day`) needs a Bronze table written with `by_date`; null
    among them stands for undated rows. `keep_date` keeps the partition column `event_date`.
    """
    df = spark.read.schema(bronze_schema(by_date)).parquet(path)
    if stream_type is not None:
        df = df.where(F.col("stream_type") == stream_type)
    else:
        df = df.where(F.col("stream_type") != REJECTED)
    if dates is not None:
        if not by_date:
            raise ValueError("dates needs a Bronze table partitioned by date")
        df = of_days(df, dates, EVENT_DATE)
    return df.select(*schemas.BRONZE_STREAM.names, *[EVENT_DATE] * keep_date)


def split_bronze(spark: SparkSession, path: str, **options) -> Mapping[str, DataFrame]:
    """One frame per stream type, each reading its own partitions only.

    The folder is listed once for all of them, and nothing is cached, so partition filters work.
    """
    df = read_bronze(spark, path, **options)
    return {name: df.where(F.col("stream_type") == name) for name in schemas.STREAM_TYPES}


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Text of the records that ingestion could not parse."""
    schema = T.StructType([*schemas.BRONZE_STREAM.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .parquet(path)
        .where(F.col("stream_type") == REJECTED)
        .select(CORRUPT, "event_time", "ingestion_time")
    )
