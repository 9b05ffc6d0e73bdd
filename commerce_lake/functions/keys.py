"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.operators.numbering import number_rows

_SMALLEST = {"hash": -(2**31), "hash64": -(2**63)}


def non_negative(value: Column, smallest: int) -> Column:
    """The absolute value; the smallest integer, which has none, stays as it is."""
    return F.when(value == F.lit(smallest), value).otherwise(F.abs(value))


def hash_key(value: Column | str, strategy: str = "hash") -> Column:
    """Stable id of a natural key; null for null.

    `hash` has 32 bits and suits a handful of values, `hash64` any number of them.
    """
    value = F.col(value) if isinstance(value, str) else value
    hashed = F.hash(value) if strategy == "hash" else F.xxhash64(value)
    # A null value hashes to the bare seed, which must not become an id.
    return F.when(value.isNotNull(), non_negative(hashed, _SMALLEST[strategy]))


def add_surrogate_key(
    df: DataFrame, natural: str, name: str, strategy: str = "hash"
) -> DataFrame:
    """Add an id column to a frame holding each natural key once.

    hash, hash64   a function of the key: the same in every run, no lookup join needed
    dense          1..n in key order, numbered without a single sorting task
    monotonic      unique only; differs between evaluations, so write the result before use
    """
    if strategy in _SMALLEST:
        return df.withColumn(name, hash_key(natural, strategy))
    if strategy == "dense":
        numbered = number_rows(df, [F.col(natural)], name)
        return numbered.withColumn(name, F.col(name) + 1)
    if strategy == "monotonic":
        return df.withColumn(name, F.monotonically_increasing_id())
    raise ValueError(f"unknown key strategy {strategy!r}")
