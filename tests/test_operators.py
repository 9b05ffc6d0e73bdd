import datetime as dt
import glob
import gzip
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from commerce_lake.operators import envelope as env
from commerce_lake.operators import quality
from commerce_lake.operators.dedup import dedup_by_key
from commerce_lake.operators.joins import (
    HotKey, find_hot_keys, inherit_event_time, join_on_key, lookup, lookup_where, plan_lookup,
    rows_of,
)
from commerce_lake.operators.merge import merge_by_key, union_distinct
from commerce_lake.operators.numbering import number_rows
from commerce_lake.operators.quality import (
    count_by, fail_on_collisions, fail_on_orphans, orphan_keys, table_summary,
)
from commerce_lake.plans.event_stream import build_event_stream, tables_of_day, write_batch_files
from commerce_lake.schemas import SchemaMismatch, require_columns, require_schema, columns
from commerce_lake.sources.files import read_envelopes
from frames import frame, values


def plan_of(df, capsys) -> str:
    df.explain()
    return capsys.readouterr().out


# --- one row per key


def test_dedup_keeps_the_latest_and_drops_null_keys(spark):
    df = frame(
        spark, "user_id string, city string, at int",
        ["u1", "A", 1], ["u1", "B", 2], ["u2", "C", None], ["u2", "D", 0], [None, "E", 9],
    )
    assert values(dedup_by_key(df, ["user_id"], ["at"])) == [("u1", "B", 2), ("u2", "D", 0)]


def test_dedup_does_not_depend_on_partitioning(spark):
    df = frame(spark, "k int, v string", *[[i % 3, f"v{i}"] for i in range(60)])
    expected = values(dedup_by_key(df.coalesce(1), ["k"]))
    assert values(dedup_by_key(df.repartition(7), ["k"])) == expected
    assert expected == [(0, "v0"), (1, "v1"), (2, "v11")]


def test_dedup_by_content_keeps_different_rows_without_key(spark):
    df = frame(
        spark, "k string, v int, at int",
        [None, 1, 1], [None, 1, 2], [None, 2, 1], ["a", 1, 1], ["a", 5, 2],
    )
    assert values(dedup_by_key(df, ["k"], ["at"], null_keys="content")) == [
        (None, 1, 2), (None, 2, 1), ("a", 5, 2),
    ]


def test_dedup_reduces_before_the_shuffle(spark, capsys):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = plan_of(dedup_by_key(df, ["k"], ["v"]), capsys)
    shuffle = plan.index("Exchange hashpartitioning")
    assert "Partial" in plan[shuffle:] and "Final" in plan[:shuffle]


# --- joins under skew


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the left rows share a key, another part has none, and some are exact copies."""
    rng = random.Random(3)
    rows = []
    for i in range(6000):
        draw = rng.random()
        key = "hot" if draw < 0.33 else None if draw < 0.5 else f"k{rng.randrange(300)}"
        rows.append([key, i if draw > 0.1 else 0])
    left = frame(spark, "key string, n int", *rows).repartition(6)
    right = frame(
        spark, "key string, v int", ["hot", 1], [None, 2], *[[f"k{i}", i] for i in range(250)]
    )
    return left, right


HOT = [HotKey("hot", 5), HotKey(None, 3), HotKey("k1", 2), HotKey("absent", 2)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spreading_hot_keys_does_not_change_a_join(spark, skewed, how):
    left, right = skewed
    spread = join_on_key(left, right, "key", how, HOT)
    plain = left.join(right, "key", how)
    assert spread.columns == plain.columns
    assert values(spread) == values(plain)


def test_hot_keys_are_spread_over_partitions(spark, skewed):
    left, right = skewed
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def most(hot):
            joined = join_on_key(left, right, "key", "inner", hot)
            sizes = joined.where("key = 'hot'").groupBy(F.spark_partition_id()).count()
            return sizes.agg(F.max("count"), F.count("*")).first()

        plain, spread = most([]), most([HotKey("hot", 32)])
        assert plain[1] == 1
        assert spread[1] > 4 and spread[0] < 0.5 * plain[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("hot", [HOT, [HotKey("hot", 32)], [HotKey(None, 4)]])
def test_spreading_hot_keys_does_not_change_a_join_on_an_expression(spark, skewed, hot):
    left, right = skewed
    other = right.select(F.col("key").alias("name"), "v")
    other = other.union(frame(spark, "name string, v int", ["hot", 7], ["k1", None], [None, 9]))
    on = (F.lower(left["key"]), other["name"])
    for condition in (on[0] == on[1], (on[0] == on[1]) & (left["n"] > other["v"])):
        spread = lookup_where(left, other, condition, on=on, hot=hot)
        plain = lookup_where(left, other, condition)
        assert spread.columns == plain.columns
        assert values(spread) == values(plain)
        assert lookup_where(left.where("false"), other, condition, on=on, hot=hot).isEmpty()
        none = lookup_where(left, other.where("false"), condition, on=on, hot=hot)
        assert none.count() == left.count() and none.where("v IS NOT NULL").isEmpty()
    with pytest.raises(ValueError):
        lookup_where(left, other, on[0] == on[1], hot=hot)


def test_hot_keys_of_an_expression_are_spread_over_partitions(spark, skewed, capsys):
    left, right = skewed
    other = right.select(F.col("key").alias("name"), "v")
    on = (left["key"], other["name"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def sizes(hot):
            joined = lookup_where(left, other, on[0] == on[1], on=on, hot=hot)
            counts = joined.where("key = 'hot'").groupBy(F.spark_partition_id()).count()
            return joined, counts.agg(F.max("count"), F.count("*")).first()

        (_, plain), (joined, spread) = sizes([]), sizes([HotKey("hot", 32)])
        assert plain[1] == 1
        assert spread[1] > 4 and spread[0] < 0.5 * plain[0]
        exchanges = re.findall(r"hashpartitioning\((.*?), 8\)", plan_of(joined, capsys))
        assert len(exchanges) == 2 and all("_dealt" in e or "_copied" in e for e in exchanges)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_found(spark, skewed):
    left, _ = skewed
    found = find_hot_keys(left, "key", min_share=0.05, fraction=1.0, min_rows=100)
    assert {h.value for h in found} == {"hot", None}
    assert all(h.parts >= 2 for h in found)
    lower = find_hot_keys(left, F.upper("key"), min_share=0.05, fraction=1.0, min_rows=100)
    assert {h.value for h in lower} == {"HOT", None}
    assert find_hot_keys(left, "key") == find_hot_keys(left, "key", rows=6000) == []
    assert find_hot_keys(left.where("false"), "key", fraction=1.0, min_rows=0) == []


def test_only_small_dimensions_are_broadcast(spark, skewed, capsys):
    left, right = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small, hot = plan_lookup(left, 6000, right, 300, "key")
        assert hot == [] and "BroadcastHashJoin" in plan_of(lookup(left, small, "key", ["v"]), capsys)
        large, hot = plan_lookup(left, 6000, right, 10**9, "key")
        plan = plan_of(lookup(left, large, "key", ["v"], hot), capsys)
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookups(spark):
    items = frame(spark, "order_id string, n int", ["o1", 1], ["o9", 2], [None, 3])
    orders = frame(spark, "order_id string, event_time string, x int", ["o1", "t", 5])
    assert values(lookup(items, orders, "order_id", ["x"]), "n", "x") == [(1, 5), (2, None), (3, None)]
    assert values(inherit_event_time(items, orders, "order_id"), "n", "event_time") == [
        (1, "t"), (2, None), (3, None),
    ]
    assert values(rows_of(items, orders, "order_id"), "n") == [(1,)]
    assert rows_of(items, orders.where("false"), "order_id").isEmpty()


# --- numbering


def test_numbers_follow_the_order_without_a_single_partition_sort(spark):
    rng = random.Random(5)
    rows = [[rng.randrange(40), f"r{i:05d}"] for i in range(5000)]
    df = frame(spark, "t int, name string", *rows).repartition(5)
    found = values(number_rows(df, [F.col("t"), F.col("name")], "n"), "n", "t", "name")
    assert found == [(i, *r) for i, r in enumerate(sorted(map(tuple, rows)))]


def test_numbers_restart_within_groups_even_if_one_is_huge(spark):
    rows = [["big", i] for i in range(3000)] + [[f"g{i % 7}", i] for i in range(700)] + [[None, 1], [None, 2]]
    df = frame(spark, "g string, v int", *rows).repartition(4)
    found = number_rows(df, [F.col("v")], "n", ["g"])
    by_group = {}
    for g, v, n in values(found, "g", "v", "n"):
        by_group.setdefault(g, []).append((v, n))
    assert len(by_group) == 9
    for pairs in by_group.values():
        assert [n for _, n in sorted(pairs)] == list(range(len(pairs)))


def test_exact_copies_spread_over_partitions(spark):
    df = spark.range(4000, numPartitions=8).select(F.lit("same").alias("v"))
    numbered = number_rows(df, [F.col("v")], "n")
    assert values(numbered, "n") == [(i,) for i in range(4000)]
    spread = (
        df.withColumn("_copy", F.spark_partition_id())
        .repartitionByRange(8, "v", "_copy")
        .groupBy(F.spark_partition_id())
        .count()
        .agg(F.max("count"))
        .first()[0]
    )
    assert spread <= 1000


# --- gates


def test_collisions_stop_what_is_written(spark):
    good = frame(spark, "id int, name string", [1, "a"], [1, "a"], [2, "b"], [3, None], [None, "c"])
    assert values(fail_on_collisions(good, "id", "name")) == values(good)
    assert fail_on_collisions(good.where("false"), "id", "name").isEmpty()
    for row in ([1, "z"], [1, None], [None, "d"]):
        bad = good.union(frame(spark, "id int, name string", row))
        with pytest.raises(Exception, match="id of several name"):
            fail_on_collisions(bad, "id", "name").collect()


@pytest.mark.parametrize("small", [True, False])
def test_orphans_stop_what_is_written(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(quality, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(quality, "find_hot_keys", lambda *_: [HotKey("a", 3), HotKey(None, 2)])
    facts = frame(spark, "n int, k string", [1, "a"], [2, "a"], [3, None], [4, "b"], [4, "b"])
    keys = frame(spark, "name string, n int", ["a", 1], ["a", 2], ["b", 3], [None, 4])
    checked = fail_on_orphans(facts, "k", keys, "name")
    assert checked.columns == facts.columns and values(checked) == values(facts)
    with pytest.raises(Exception, match="k without a row: b"):
        fail_on_orphans(facts, "k", keys.where("name = 'a'"), "name").collect()
    assert fail_on_orphans(facts.where("k IS NULL"), "k", keys.where("false"), "name").count() == 1


# --- merging


def test_merge_prefers_new_rows(spark):
    old = frame(spark, "d int, v string", [1, "old"], [2, "old"])
    new = frame(spark, "v string, d int", ["new", 2], ["new", 3])
    assert values(merge_by_key(old, new, ["d"])) == [(1, "old"), (2, "new"), (3, "new")]


def test_union_distinct(spark):
    a, b = frame(spark, "d int", [1], [1], [2]), frame(spark, "d int", [2], [None])
    assert values(union_distinct([a, b])) == [(None,), (1,), (2,)]


# --- envelopes

T1, T2 = dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 2, 9)


@pytest.fixture(scope="module")
def shop(spark):
    return {
        "events": frame(
            spark, "event_id string, user_id string, product_id string, event_type string, event_time timestamp_ntz",
            ["e1", "u1", "p1", "view", T1], ["e2", "u1", "p1", "cart", T2], ["e3", "u1", "p1", "cart", None],
        ),
        "orders": frame(
            spark, "order_id string, user_id string, total_amount double, order_status string, event_time timestamp_ntz",
            ["o1", "u1", 10.0, "Completed", T1], ["o2", "u1", float("nan"), "Returned", T2],
        ),
        "order_items": frame(
            spark, "order_item_id string, order_id string, product_id string, quantity int, item_price double",
            ["i1", "o1", "p1", 1, 5.0], ["i2", "o2", "p1", 2, 5.0], ["i3", "o9", "p1", 2, 5.0],
        ),
        "reviews": frame(
            spark, "review_id string, product_id string, user_id string, rating double, review_text string, event_time timestamp_ntz",
            ["r1", "p1", "u1", 4.0, "ok", T1],
        ),
    }


def test_event_stream_orders_parents_first_and_batches(spark, shop):
    stream = build_event_stream(shop, 2)
    found = values(stream, "batch_id", "event_time", env.priority(), env.record_id())
    assert found == [
        (0, T1, 0, "e1"), (0, T1, 1, "o1"), (1, T1, 2, "i1"), (1, T1, 3, "r1"),
        (2, T2, 0, "e2"), (2, T2, 1, "o2"), (3, T2, 2, "i2"),
    ]
    counts = values(env.batch_type_counts(stream))
    assert counts == [(0, 1, 1, 0, 0), (1, 0, 0, 1, 1), (2, 1, 1, 0, 0), (3, 0, 0, 1, 0)]
    total = stream.where("data.order_id = 'o2' AND stream_type = 'orders'").first()
    assert total["data"]["total_amount"] is None


def test_batch_files_are_ordered_arrays(spark, shop, tmp_path):
    path = str(tmp_path / "batches")
    write_batch_files(build_event_stream(shop, 3), path)
    found = {}
    for file in glob.glob(f"{path}/batch_id=*/*.txt"):
        number = int(file.split("batch_id=")[1].split("/")[0])
        found[number] = [r["stream_type"] for r in json.load(open(file))]
    assert found == {
        0: ["events", "orders", "order_items"],
        1: ["reviews", "events", "orders"],
        2: ["order_items"],
    }


def test_packed_batch_files_are_the_same_arrays(spark, shop, tmp_path):
    plain, small = str(tmp_path / "plain"), str(tmp_path / "packed")
    stream, arrived = build_event_stream(shop, 3), F.lit(T1)
    write_batch_files(stream, plain, arrived)
    write_batch_files(stream, small, arrived, compression="gzip")
    found = {}
    for file in glob.glob(f"{small}/batch_id=*/*.txt.gz"):
        with gzip.open(file, "rt") as f:
            found[file.split("batch_id=")[1].split("/")[0]] = f.read()
    assert len(found) == 3 and found == {
        f.split("batch_id=")[1].split("/")[0]: open(f).read() for f in glob.glob(f"{plain}/batch_id=*/*.txt")
    }
    assert values(read_envelopes(spark, small)) == values(read_envelopes(spark, plain))


def test_one_day_of_the_stream(spark, shop):
    day = tables_of_day(shop, dt.date(2024, 1, 2))
    assert {n: df.count() for n, df in day.items()} == {
        "events": 1, "orders": 1, "order_items": 1, "reviews": 0,
    }
    empty = tables_of_day(shop, dt.date(2030, 1, 1))
    assert all(df.isEmpty() for df in empty.values())


def test_unknown_stream_types_go_last(spark):
    df = frame(spark, "stream_type string", ["orders"], ["other"])
    assert [r[0] for r in df.select(env.priority()).collect()] == [1, 99]


def test_missing_columns_are_an_error(spark, shop):
    with pytest.raises(SchemaMismatch, match="event_time"):
        env.build_envelope(shop["order_items"], "order_items")


def test_explode_records(spark):
    df = frame(spark, "records array<struct<a int, b string>>", [[(1, "x"), (2, "y")]], [[]], [None])
    assert values(env.explode_records(df, "records")) == [(1, "x"), (2, "y")]


# --- checks


def test_orphans_and_summary(spark):
    fact = frame(spark, "k int", [1], [2], [2], [None])
    dim = frame(spark, "id int", [1])
    assert values(orphan_keys(fact, "k", dim, "id")) == [(2, 2)]
    assert values(table_summary({"fact": fact, "dim": dim})) == [("dim", 1), ("fact", 4)]
    summary = table_summary({"fact": fact, "none": fact.where("false")})
    assert values(summary) == [("fact", 4), ("none", 0)]
    assert "SinglePartition" not in summary._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in count_by(fact, "k").collect()] == [(None, 1), (1, 1), (2, 2)]


def test_contracts(spark):
    df = frame(spark, "b string, a int", ["x", 1])
    assert require_schema(df, columns("a int, b string")).columns == ["a", "b"]
    with pytest.raises(SchemaMismatch, match="a is int, not bigint"):
        require_schema(df, columns("a bigint, b string"))
    with pytest.raises(SchemaMismatch, match="missing c"):
        require_columns(df, "a", "c")
