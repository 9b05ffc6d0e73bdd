"""Unions and keyed merges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def merge_by_key(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `existing` that `new` does not replace, followed by `new`.

    Write the result somewhere else than where `existing` is read from (see sinks.versions).
    """
    kept = existing.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new)
