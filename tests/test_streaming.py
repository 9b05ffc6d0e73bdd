import datetime as dt
import glob
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from commerce_lake import schemas
from commerce_lake.operators.merge import merge_by_key
from commerce_lake.operators.quality import orphan_keys
from commerce_lake.plans import daily, gold
from commerce_lake.sinks.versions import create_database, write_version
from commerce_lake.sources.files import read_bronze, read_rejected
from commerce_lake.streaming.facts import start_append
from commerce_lake.streaming.landing import drop_repeats, read_landing, start_bronze
from frames import event, frame, item, order, review, values, write_array

DAY1, DAY2 = "2024-01-01 10:00:00", "2024-01-02 10:00:00"


def batches(query) -> int:
    query.awaitTermination()
    return sum(1 for p in query.recentProgress if p["numInputRows"])


def test_files_are_ingested_once_and_rate_limited(spark, tmp_path):
    landing, bronze, state = (str(tmp_path / n) for n in ("landing", "bronze", "state"))
    for n in range(3):
        write_array(landing, f"b{n}.json", [event(f"e{n}", DAY1), order(f"o{n}", DAY1)])
    with open(f"{landing}/bad.json", "w") as f:
        f.write("{not json")

    def run():
        return batches(start_bronze(read_landing(spark, landing, max_files=1), bronze, state))

    assert run() == 4
    assert run() == 0
    write_array(landing, "b9.json", [event("e9", DAY2, ingestion_time=None)])
    assert run() == 1
    found = read_bronze(spark, bronze)
    assert found.count() == 7
    assert found.where("event_id = 'e9'").first()["ingestion_time"] is not None
    assert read_rejected(spark, bronze).count() == 1


def test_processed_files_are_archived(spark, tmp_path):
    landing, archive = str(tmp_path / "landing"), str(tmp_path / "archive")
    bronze, state = str(tmp_path / "bronze"), str(tmp_path / "state")
    for n in range(3):
        write_array(landing, f"b{n}.json", [event(f"e{n}", DAY1)])
        stream = read_landing(spark, landing, archive=archive)
        start_bronze(stream, bronze, state).awaitTermination()
    moved = glob.glob(f"{archive}/**/*.json", recursive=True)
    assert moved
    assert len(moved) + len(glob.glob(f"{landing}/*.json")) == 3
    assert read_bronze(spark, bronze).count() == 3


def test_replayed_stream_appends_nothing(spark, tmp_path):
    landing = str(tmp_path / "landing")
    create_database(spark, "replay", str(tmp_path / "db"))
    write_array(landing, "a.json", [event("e1", DAY1), event("e2", DAY1), event("e2", DAY1)])
    for state in ("first", "second"):
        rows = read_landing(spark, landing).select("event_id", "event_type")
        start_append(rows, "replay.fact", "event_id", str(tmp_path / state)).awaitTermination()
    assert values(spark.table("replay.fact"), "event_id") == [("e1",), ("e2",)]


def test_repeats_within_the_delay_are_dropped(spark, tmp_path):
    landing, bronze, state = (str(tmp_path / n) for n in ("landing", "bronze", "state"))
    write_array(landing, "a.json", [event("e1", DAY1), event("e2", DAY1)])
    write_array(landing, "b.json", [event("e2", DAY1), event("e3", DAY1)])
    stream = drop_repeats(read_landing(spark, landing, max_files=1), "event_id", "1 hour")
    start_bronze(stream, bronze, state).awaitTermination()
    assert values(read_bronze(spark, bronze), "event_id") == [("e1",), ("e2",), ("e3",)]


# --- the daily run


@pytest.fixture()
def lake(spark, tmp_path):
    name = "_" + os.path.basename(str(tmp_path)).replace("-", "_")
    landing = str(tmp_path / "landing")
    write_array(f"{landing}/static", "users.json", [{"user_id": "u1", "name": "A"}])
    write_array(f"{landing}/static", "products.json", [{"product_id": "p1", "price": 9.5}])
    write_array(
        f"{landing}/stream",
        "a.json",
        [
            event("e1", DAY1), event("e2", DAY2, "cart"), event("bad", "junk"),
            order("o1", DAY1), order("o2", DAY2, "Returned"),
            item("i1", "o1", DAY1), item("i2", "o2", DAY2), item("i3", "o2", DAY2, "p9"),
            review("r1", DAY1), review("r2", DAY1, rating=5.0),
        ],
    )
    lake = daily.Lake(landing, str(tmp_path / "lake"), "gold" + name, "warehouse" + name)
    yield lake
    for database in (lake.gold_database, lake.warehouse_database):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def contents(spark, lake) -> dict:
    found = {}
    for name, df in daily.gold_tables(spark, lake).items():
        columns = [c for c in df.columns if c != "gold_created_at"]
        found[name] = values(df, *columns)
    return found


def published(spark, lake, name, *columns):
    return values(spark.table(f"{lake.warehouse_database}.{name}"), *columns)


def test_daily_run_is_idempotent(spark, lake):
    first = daily.run_daily(spark, lake)
    assert first == {
        "dim_date": 2, "dim_order_status": 2, "dim_event_type": 2, "dim_users": 1,
        "dim_products": 1, "fact_orders": 3, "fact_events": 2,
    }
    before = contents(spark, lake)
    again = daily.run_daily(spark, lake)
    assert (again["fact_orders"], again["fact_events"]) == (0, 0)
    assert contents(spark, lake) == before
    assert {r[0]: r[1] for r in daily.summarize(spark, lake).collect()} == {
        "dim_date": 2, "dim_order_status": 2, "dim_event_type": 2, "dim_users": 1,
        "dim_products": 1, "fact_orders": 3, "fact_events": 2,
    }
    assert before["dim_products"] == [("p1", None, None, 9.5, None, 4.5, 2)]
    orders = daily.gold_tables(spark, lake)["fact_orders"]
    dates = daily.gold_tables(spark, lake)["dim_date"]
    assert orphan_keys(orders, "order_date_id", dates, "date_id").isEmpty()
    assert orders.where("order_item_id = 'i3'").first()["is_returned"] == 1


def test_late_and_resent_records(spark, lake):
    daily.run_daily(spark, lake)
    write_array(
        lake.stream_landing,
        "b.json",
        [
            event("e3", DAY1, "wishlist"), event("e1", DAY1),
            item("i4", "o1", DAY1), item("i1", "o1", DAY1), order("o1", DAY1),
        ],
    )
    second = daily.run_daily(spark, lake)
    assert (second["fact_orders"], second["fact_events"]) == (1, 1)
    assert second["dim_event_type"] == 3
    tables = daily.gold_tables(spark, lake)
    assert values(tables["fact_events"], "event_id") == [("e1",), ("e2",), ("e3",)]
    assert values(tables["fact_orders"], "order_item_id") == [("i1",), ("i2",), ("i3",), ("i4",)]
    assert published(spark, lake, "fact_orders", "order_item_id") == [("i1",), ("i2",), ("i3",), ("i4",)]


def test_facts_outside_the_calendar_stop_publishing_when_asked(spark, lake):
    daily.run_daily(spark, lake)
    before = published(spark, lake, "fact_events", "event_id")
    strict = replace(lake, check_references=True, key_filters=True)
    write_array(lake.stream_landing, "y.json", [event("e8", "2019-01-01 10:00:00"), event("e7", DAY1)])
    with pytest.raises(Exception, match="event_date_id without a row: 2019-01-01"):
        daily.run_daily(spark, strict)
    assert published(spark, lake, "fact_events", "event_id") == before
    # A calendar that holds the day makes up for it.
    dates = gold.build_dim_date(frame(spark, "day date", [dt.date(2019, 1, 1)]), dt.date(2019, 1, 1))
    write_version(merge_by_key(spark.table(lake.gold_table("dim_date")), dates, ["date_id"]), lake.gold_table("dim_date"))
    assert daily.run_daily(spark, strict)["fact_events"] == 2


def test_a_hash_of_two_statuses_stops_the_run(spark, lake, monkeypatch):
    daily.run_daily(spark, lake)
    before = values(spark.table(lake.gold_table("dim_event_type")))
    plain = gold.build_dim_event_type
    monkeypatch.setattr(gold, "build_dim_event_type", lambda df: plain(df).withColumn("event_type_id", F.lit(5)))
    write_array(lake.stream_landing, "z.json", [event("e7", DAY1, "wave"), event("e8", DAY1, "nod")])
    with pytest.raises(Exception, match="event_type_id of several event_type_name"):
        daily.run_daily(spark, lake)
    assert values(spark.table(lake.gold_table("dim_event_type"))) == before


def test_moved_records_and_items_of_other_days_equal_a_full_build(spark, lake):
    daily.run_daily(spark, lake)
    write_array(
        lake.stream_landing,
        "b.json",
        [item("i5", "o1", DAY2), item("i6", "o1", "junk"), event("e1", DAY2), order("o2", DAY1)],
    )
    daily.run_daily(spark, lake)
    write_array(lake.stream_landing, "c.json", [event("e9", DAY1)])
    daily.run_daily(spark, lake)
    built = contents(spark, lake)
    daily.rebuild_facts(spark, lake)
    full = contents(spark, lake)
    assert (built["fact_orders"], built["fact_events"]) == (full["fact_orders"], full["fact_events"])
    ids = published(spark, lake, "fact_orders", "order_item_id")
    assert ids == [(f"i{k}",) for k in (1, 2, 3, 5, 6)]
    assert published(spark, lake, "fact_events", "event_id") == [("e1",), ("e2",), ("e9",)]


def test_only_touched_days_are_rewritten(spark, lake):
    daily.run_daily(spark, lake)
    old = set(glob.glob(f"{lake.gold('fact_events')}/*/*.parquet"))
    write_array(lake.stream_landing, "b.json", [event("e3", DAY2)])
    daily.run_daily(spark, lake)
    new = set(glob.glob(f"{lake.gold('fact_events')}/*/*.parquet"))
    assert {os.path.dirname(f)[-10:] for f in old & new} == {"2024-01-01"}
    assert {os.path.dirname(f)[-10:] for f in new - old} == {"2024-01-02"}


def test_a_failed_publication_is_made_up_for(spark, lake, monkeypatch):
    daily.run_daily(spark, lake)
    write_array(lake.stream_landing, "b.json", [event("e3", DAY2)])

    def fail(*args, **kwargs):
        raise RuntimeError("warehouse is down")

    with monkeypatch.context() as patch:
        patch.setattr(daily, "publish_all", fail)
        with pytest.raises(RuntimeError):
            daily.run_daily(spark, lake)
    assert values(daily.pending_days(spark, lake)) == [(dt.date(2024, 1, 2),)]
    assert daily.run_daily(spark, lake)["fact_events"] == 1
    assert values(daily.pending_days(spark, lake)) == []


def test_facts_follow_their_contracts(spark, lake):
    daily.run_daily(spark, lake)
    tables = daily.gold_tables(spark, lake)
    schemas.require_schema(tables["dim_date"], schemas.DIM_DATE)
    schemas.require_schema(tables["dim_order_status"], schemas.DIM_ORDER_STATUS)
    for name in ("fact_orders", "fact_events"):
        written = spark.read.parquet(lake.gold(name))
        schemas.require_schema(written, daily.CONTRACTS[name])
        target = spark.table(f"{lake.warehouse_database}.{name}")
        schemas.require_schema(target, daily.CONTRACTS[name])
    assert tables["fact_events"].where(F.col("gold_created_at").isNull()).isEmpty()
