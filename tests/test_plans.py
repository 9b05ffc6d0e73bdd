"""What the physical plans must look like, whatever the size of the data."""

import re

import pytest

from suite import QUERIES
from suite.entities import Tables
from test_queries import FOLDER

# Queries whose result is one row, a top-k, or a count per table.
GLOBAL = {
    "time_range", "rotating_day", "preview_limit", "gold_summary", "surrogate_key_monotonic",
}


@pytest.fixture(scope="module")
def plan(spark):
    found = {}

    def of(name):
        if name not in found:
            df = QUERIES[name](spark, FOLDER)
            found[name] = spark.sparkContext._jvm.PythonSQLUtils.explainString(
                df._jdf.queryExecution(), "formatted"
            )
        return found[name]

    return of


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_python_or_single_tasks(plan, name):
    text = plan(name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert not re.search(r"Python|ArrowEval|MapInPandas", text)
    if name not in GLOBAL:
        assert "SinglePartition" not in text


def test_columns_are_pruned(plan):
    text = plan("join_left_expr")
    assert re.findall(r"ReadSchema: (.*)", text) == [
        "struct<event_id:bigint,event_type:string>",
        "struct<event_type:string>",
    ]
    schemas = re.findall(r"ReadSchema: (.*)", plan("fact_events_from_bronze"))
    assert schemas and all("review_text" not in s and "order_id" not in s for s in schemas)


def test_filters_reach_the_scan(plan):
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan("day_slice")
    assert re.search(r"PartitionFilters: .*stream_type.* = orders", plan("scan_partitioned_split"))


def test_hash_keys_need_no_lookup_join(plan):
    assert "Join" not in plan("fact_events")
    # Orders and products; the status id takes no join.
    assert len(re.findall(r"^\(\d+\) \w*Join", plan("fact_orders"), re.M)) == 2


def test_dedup_is_partial_before_each_shuffle(plan):
    text = plan("fact_events")
    assert "WindowGroupLimit" in text and "Partial" in text


def test_items_of_the_landing_files_meet_their_orders_by_number(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        found = spark.sparkContext._jvm.PythonSQLUtils.explainString(
            Tables(spark, FOLDER).envelopes()._jdf.queryExecution(), "formatted"
        )
    finally:
        spark.conf.set(threshold, before)
    shuffled = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]", found)
    assert shuffled and not any("order_item_id" in columns for columns in shuffled)
