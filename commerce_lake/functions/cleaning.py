"""Parsing, casting and null handling that cannot fail under ANSI mode."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def parse_timestamp(text: Column | str) -> Column:
    """Timestamp from text; null where the text is no timestamp."""
    return F.try_to_timestamp(text)


def parse_date(text: Column | str) -> Column:
    """Calendar day from text; null where the text is no date or timestamp."""
    return F.try_to_date(text)


def format_timestamp(value: Column | str, pattern: str = EVENT_TIME_FORMAT) -> Column:
    return F.date_format(value, pattern)


def to_int(value: Column) -> Column:
    """Whole number from a number or text such as `2.0`; null where there is none."""
    return value.try_cast("double").try_cast("int")


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; values that do not fit become null."""
    return df.withColumns(
        {
            name: to_int(F.col(name)) if kind == "int" else F.col(name).try_cast(kind)
            for name, kind in types.items()
        }
    )


def require_not_null(df: DataFrame, *names: str) -> DataFrame:
    """Rows that have all of the named values. Unlike `dropna`, the test reaches the scan."""
    return df.where(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names]))


def finite(value: Column) -> Column:
    """The value, or null for NaN and both infinities (Spark orders NaN above infinity)."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def _scrub(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return finite(value)
    if isinstance(kind, T.StructType):
        fields = [_scrub(value[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _scrub(item, kind.elementType))
    return value


def _holds_fraction(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_fraction(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _holds_fraction(kind.elementType)
    return isinstance(kind, (T.DoubleType, T.FloatType))


def scrub_non_finite(df: DataFrame) -> DataFrame:
    """Null every NaN and infinity, also inside structs and arrays."""
    fractional = {
        f.name: _scrub(F.col(f"`{f.name}`"), f.dataType)
        for f in df.schema
        if _holds_fraction(f.dataType)
    }
    return df.withColumns(fractional) if fractional else df


def json_field(text: Column | str, path: str) -> Column:
    """One scalar of a JSON text as string."""
    return F.get_json_object(text, path)


def literal_lookup(value: Column, mapping: Mapping[str, int], default: int) -> Column:
    """Map a few fixed values; anything else (null too) becomes `default`."""
    branches = F.lit(default)
    for key, result in mapping.items():
        branches = F.when(value == key, F.lit(result)).otherwise(branches)
    return branches
