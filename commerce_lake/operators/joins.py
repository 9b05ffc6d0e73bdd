"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


# A key seen less often than this in the sample may be there by chance.
_FEWEST_SAMPLES = 10


# A lookup table of up to this many (narrow) rows is sent to every executor, tens of megabytes.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class HotKey:
    """A join key with so many rows that they are spread over `parts` partitions."""

    value: object
    parts: int


def find_hot_keys(
    df: DataFrame,
    key: str | Column,
    *,
    rows: int | None = None,
    min_share: float = 0.001,
    fraction: float = 0.0001,
    min_rows: int = 10_000_000,
    seed: int = 7,
) -> list[HotKey]:
    """Keys (null too) holding at least `min_share` of the rows, at most 1/min_share of them.

    Reads a sample of the key column alone. The sample only decides how rows are spread, never
    which rows a join returns. Frames below `min_rows` are too small for skew to matter; with
    `rows`, the known size, they are not even sampled.
    """
    if rows is not None and rows < min_rows:
        return []
    seen = Observation()
    counts = (
        df.select((F.col(key) if isinstance(key, str) else key).alias("value"))
        .sample(fraction, seed)
        .groupBy("value")
        .count()
        .observe(seen, F.sum("count").alias("rows"))
        .orderBy(F.desc("count"))
        .limit(int(1 / min_share))
        .collect()
    )
    sampled = seen.get["rows"] or 0
    if not counts or sampled / fraction < min_rows:
        return []
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return [
        HotKey(row["value"], max(2, round(row["count"] / sampled * partitions)))
        for row in counts
        if row["count"] >= max(min_share * sampled, _FEWEST_SAMPLES)
    ]


def plan_lookup(
    table: DataFrame, rows: int, dimension: DataFrame, dimension_rows: int, key: str
) -> tuple[DataFrame, list[HotKey]]:
    """The dimension and the hot keys to pass to `lookup`, given the sizes of both tables.

    A small dimension is broadcast, and skew does not matter. A larger one is shuffled, and the
    rows of hot keys are spread.
    """
    if dimension_rows <= BROADCAST_ROWS:
        return F.broadcast(dimension), []
    return dimension, find_hot_keys(table, key, rows=rows)


def join_on_key(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    hot: Sequence[HotKey] = (),
) -> DataFrame:
    """Equi-join on `key` (inner, left, left_semi or left_anti); `right` should hold a key once.

    Without hot keys this is the ordinary join and Spark picks the strategy. The left rows of a
    hot key are spread over several partitions, each of which gets a copy of the right row.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if not hot:
        return left.join(right, key, how)
    salted = _dealt(left, F.col(key), hot, "_salt")
    copies = _copied(right, F.col(key), hot, "_salt")
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def _parts(df: DataFrame, key: Column, hot: Sequence[HotKey]) -> DataFrame:
    """(_hot, _parts), at most 1/min_share rows (see find_hot_keys): small enough for every executor."""
    kind = df.select(key.alias("_hot")).schema["_hot"].dataType.simpleString()
    rows = [(h.value, h.parts) for h in hot]
    return F.broadcast(df.sparkSession.createDataFrame(rows, f"_hot {kind}, _parts int"))


def _dealt(df: DataFrame, key: Column, hot: Sequence[HotKey], salt: str) -> DataFrame:
    """Add `salt`: rows of a hot key are dealt over its parts, all others have 0."""
    spread = F.pmod(
        F.xxhash64(F.spark_partition_id(), *df.columns), F.coalesce("_parts", F.lit(1))
    )
    with_parts = df.join(_parts(df, key, hot), key.eqNullSafe(F.col("_hot")), "left")
    return with_parts.withColumn(salt, spread).drop("_hot", "_parts")


def _copied(df: DataFrame, key: Column, hot: Sequence[HotKey], salt: str) -> DataFrame:
    """Rows that have a key, once for each part (`salt`) of theirs."""
    last = F.coalesce("_parts", F.lit(1)) - 1
    every = F.explode(F.sequence(F.lit(0), last).cast("array<bigint>"))
    with_parts = df.where(key.isNotNull()).join(_parts(df, key, hot), key == F.col("_hot"), "left")
    return with_parts.withColumn(salt, every).drop("_hot", "_parts")


def lookup(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    columns: Sequence[str],
    hot: Sequence[HotKey] = (),
) -> DataFrame:
    """Add `columns` of the dimension row with the same `key`; null where there is none."""
    return join_on_key(rows, dimension.select(key, *columns), key, "left", hot)


def lookup_where(
    rows: DataFrame,
    dimension: DataFrame,
    condition: Column,
    *,
    on: tuple[Column, Column] | None = None,
    hot: Sequence[HotKey] = (),
) -> DataFrame:
    """Left outer join on an expression, for keys that are named differently on the two sides.

    `on` are the two sides of an equality that `condition` implies: an expression over `rows` and
    one over `dimension`. With it, the rows of `hot` keys (values of the first) are spread over
    several partitions, each of which gets a copy of the dimension rows of that key. The result is
    that of the plain join, whatever else the condition asks for.
    """
    if not hot:
        return rows.join(dimension, condition, "left")
    if on is None:
        raise ValueError("hot keys need the equality they are keys of (`on`)")
    dealt = _dealt(rows, on[0], hot, "_dealt")
    copies = _copied(dimension, on[1], hot, "_copied")
    same = (on[0] == on[1]) & (F.col("_dealt") == F.col("_copied"))
    return dealt.join(copies, condition & same, "left").drop("_dealt", "_copied")


def inherit_event_time(
    children: DataFrame, parents: DataFrame, key: str, hot: Sequence[HotKey] = ()
) -> DataFrame:
    """Give each child row the event time of its parent; null for orphans."""
    return lookup(children, parents, key, ["event_time"], hot)


def rows_of(
    children: DataFrame, parents: DataFrame, key: str, hot: Sequence[HotKey] = ()
) -> DataFrame:
    """Child rows whose parent is present; none when there are no parents."""
    return join_on_key(children, parents.select(key).distinct(), key, "left_semi", hot)
