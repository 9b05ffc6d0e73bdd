"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake.functions.cleaning import require_not_null


def _sortable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], latest: Sequence[str] = (), *, null_keys: str = "drop"
) -> DataFrame:
    """Keep the row of each key with the largest `latest` values.

    The remaining columns break ties, so the choice never depends on the partitioning. Spark
    reduces each key to one row per input task before the shuffle (`WindowGroupLimit`), so a key
    with very many copies costs no more than others.

    null_keys="drop" leaves out rows without a key. "content" keeps them and removes only
    repeats that agree in every column outside `latest`.
    """
    rest = [
        f.name
        for f in df.schema
        if f.name not in keys and f.name not in latest and _sortable(f.dataType)
    ]
    partition = [F.col(k) for k in keys]
    if null_keys == "drop":
        df = require_not_null(df, *keys)
    elif null_keys == "content":
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        partition.append(F.when(no_key, F.struct(*rest)) if rest else F.lit(None))
    else:
        raise ValueError(f"unknown null_keys {null_keys!r}")
    order = [F.col(c).desc_nulls_last() for c in latest] + [F.col(c) for c in rest]
    if not order:
        return df.distinct()
    best_first = W.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(best_first)).where("_rank = 1").drop("_rank")
