"""Consecutive row numbers over data of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commerce_lake.operators.joins import BROADCAST_ROWS
from commerce_lake.shared import INTERMEDIATE, materialize

# monotonically_increasing_id keeps the partition number above this many bits.
_ROW_BITS = 33


def number_rows(
    df: DataFrame, order_by: Sequence[Column], name: str, within: Sequence[str] = ()
) -> DataFrame:
    """Add 0-based row numbers in `order_by` order, restarting for each value of `within`.

    Unlike `row_number`, no group has to fit one task: rows are range-partitioned on the whole
    order, numbered per partition, and shifted by the sizes of the partitions before. The table
    is written once between the two steps because both must see the same partition limits.
    Rows equal in `order_by` are told apart by a hash of their content; exact copies by the input
    partition they come from, so many copies still spread over several tasks.

    Meant for the whole table or for few groups of any size (days, say). For very many groups
    that are all small, `row_number` is the cheaper way.
    """
    within = list(within)
    helpers = ["_tie", "_copy", "_position"]
    spread = df.withColumns(
        {"_tie": F.xxhash64(*df.columns), "_copy": F.spark_partition_id()}
    )
    order = [F.col(c) for c in within] + list(order_by) + [F.col("_tie"), F.col("_copy")]
    placed = materialize(
        spread.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id()),
        "numbered",
        INTERMEDIATE,
    )
    part = F.shiftright("_position", _ROW_BITS)
    sizes = placed.groupBy(*within, part.alias("_part")).agg(
        F.count("*").alias("_rows"), F.min("_position").alias("_first")
    )
    # One row per partition and group; the running sum sees those rows only, never the data.
    before = (
        W.partitionBy(*[F.col(c) for c in within], F.lit(0))
        .orderBy("_part")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = materialize(
        sizes.select(
            *[F.col(c).alias(f"_in_{c}") for c in within],
            "_part",
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        ),
        "offsets",
    )
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    match = part == F.col("_part")
    for column in within:
        match = match & F.col(column).eqNullSafe(F.col(f"_in_{column}"))
    return (
        placed.join(offsets, match)
        .withColumn(name, F.col("_position") + F.col("_shift"))
        .drop(*helpers, "_part", "_shift", *[f"_in_{c}" for c in within])
    )
