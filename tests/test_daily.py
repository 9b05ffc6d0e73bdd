"""The daily run against a full build: late, moved and re-sent records, prices, failures, archive."""

import datetime as dt
import glob
import json
import os
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from commerce_lake import schemas
from commerce_lake.operators.days import of_days
from commerce_lake.plans import daily
from commerce_lake.plans.day_index import DayIndex, arrivals
from commerce_lake.plans.ratings import RatingState
from commerce_lake.shared import shared_folder
from commerce_lake.sinks import folders
from commerce_lake.streaming.facts import rebuild_late_days
from commerce_lake.streaming.landing import read_landing
from commerce_lake.streaming.pending import PendingLog
from commerce_lake.sources.files import EVENT_DATE, read_bronze
from frames import event, frame, item, order, review, values, write_array

TIMES = [f"2024-01-0{n} 10:00:00" for n in range(1, 8)]
DAYS = [dt.date(2024, 1, n) for n in range(1, 8)]


@pytest.fixture(scope="module", autouse=True)
def small_plans(spark):
    """Many small jobs: less time for planning, listing and compiling them."""
    options = {
        "spark.sql.shuffle.partitions": "2", "spark.sql.codegen.wholeStage": "false",
        "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
    }
    before = {name: spark.conf.get(name, None) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def static(lake, **tables):
    for name, rows in tables.items():
        write_array(f"{lake.landing}/static", f"{name}.json", rows)


def products(**prices):
    return [{"product_id": p, "price": price} for p, price in prices.items()]


@pytest.fixture()
def lake(spark, tmp_path, monkeypatch):
    """A lake whose runs publish nothing (see test_streaming for that)."""
    monkeypatch.setattr(daily, "publish_gold", lambda *args: {})
    name = "_" + os.path.basename(str(tmp_path)).replace("-", "_")
    lake = daily.Lake(
        str(tmp_path / "landing"), str(tmp_path / "lake"), "gold" + name, "house" + name,
        archive=str(tmp_path / "archive"), index_buckets=4,
    )
    static(lake, users=[{"user_id": "u1", "name": "A"}], products=products(p1=10.0, p2=1.0))
    yield lake
    for database in (lake.gold_database, lake.warehouse_database):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def deliver(lake, name, *records):
    write_array(lake.stream_landing, f"{name}.json", list(records))


def facts(spark, lake):
    tables = daily.gold_tables(spark, lake)
    return {
        n: values(tables[n].drop("gold_created_at"), *sorted(set(tables[n].columns) - {"gold_created_at"}))
        for n in daily.FACTS
    }


def assert_as_full_build(spark, lake):
    built = facts(spark, lake)
    daily.rebuild_facts(spark, lake)
    assert built == facts(spark, lake)


def prices(spark, lake):
    return dict(values(daily.gold_tables(spark, lake)["fact_orders"], "order_item_id", "list_price"))


def test_changed_prices_reach_old_days(spark, lake):
    deliver(lake, "a", order("o1", TIMES[0]), order("o2", TIMES[1]), item("i1", "o1", TIMES[0]), item("i2", "o2", TIMES[1], "p2"), item("i3", "o2", TIMES[1], "p3"))
    daily.run_daily(spark, lake)
    assert prices(spark, lake) == {"i1": 10.0, "i2": 1.0, "i3": None}
    static(lake, products=products(p1=20.0, p2=1.0, p3=7.0))
    deliver(lake, "b", event("e1", TIMES[1]))
    daily.run_daily(spark, lake)
    assert prices(spark, lake) == {"i1": 20.0, "i2": 1.0, "i3": 7.0}
    assert_as_full_build(spark, lake)
    static(lake, products=products(p1=20.0, p3=7.0))
    daily.land_static(spark, lake)
    assert values(daily.pending_days(spark, lake)) == [(DAYS[1],)]  # p2 has no price any more


def test_random_deliveries_equal_a_full_build(spark, lake):
    """Orders, items and events come again under other days, orders and times without a day."""
    rng = random.Random(4)
    lake = replace(lake, archive=None)
    for run in range(3):
        records, stamp = [], f"2024-02-0{run + 1} 00:00:00"
        for _ in range(25):
            time = rng.choice([*TIMES, "junk"] if run else TIMES)
            kind, n = rng.choice("eooiii"), rng.randrange(12)
            if kind == "e":
                records.append(event(f"e{n}", time, ingestion_time=stamp))
            elif kind == "o":
                records.append(order(f"o{n % 6}", time, total=rng.random(), ingestion_time=stamp))
            else:
                number = rng.choice([f"i{n}", None])
                records.append(item(number, f"o{rng.randrange(6)}", time, rng.choice(["p1", "p2"]), rng.randrange(9), ingestion_time=stamp))
        deliver(lake, f"run{run}", *records)
        if rng.random() < 0.6:
            static(lake, products=products(p1=rng.random(), p2=rng.random()))
        daily.run_daily(spark, lake)
        if run:
            assert_as_full_build(spark, lake)


def test_many_files_are_one_rebuild(spark, lake, monkeypatch):
    lake = replace(lake, max_files=1)
    for n in range(5):
        deliver(lake, f"f{n}", event(f"e{n}", TIMES[0]))
    calls = []
    write = daily.write_partitioned

    def counted(df, path, *args, **options):
        calls.append(path.rpartition("/")[2])
        return write(df, path, *args, **options)

    monkeypatch.setattr(daily, "write_partitioned", counted)
    daily.run_daily(spark, lake)
    assert sorted(calls) == ["fact_events", "fact_orders"]
    assert len(facts(spark, lake)["fact_events"]) == 5


def test_late_days_are_rebuilt_once_and_made_up_for(spark, tmp_path):
    landing, bronze, state = (str(tmp_path / n) for n in ("landing", "bronze", "state"))
    log = PendingLog(str(tmp_path / "log"))
    seen = []

    def rebuild(days, fails=False):
        seen.append([d for (d,) in values(days)])
        if fails:
            raise RuntimeError("no")

    def run(fails=False):
        rebuild_late_days(read_landing(spark, landing, max_files=1), bronze, state, log, lambda d: rebuild(d, fails))

    for n in range(3):
        write_array(landing, f"a{n}.json", [event(f"e{n}", TIMES[n % 2])])
    run()
    assert seen == [DAYS[:2]] and log.names(spark) == []
    write_array(landing, "b.json", [event("e9", TIMES[3]), event("e8", "junk")])
    with pytest.raises(RuntimeError):
        run(fails=True)
    run()
    run()
    assert seen[1:] == [[None, DAYS[3]]] * 2
    assert read_bronze(spark, bronze).count() == 5
    assert glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/commerce_lake/landed-*") == []


def test_reference_tables_survive_empty_and_broken_files(spark, lake):
    deliver(lake, "a", review("r1", TIMES[0]))
    daily.run_daily(spark, lake)
    before = {n: values(daily.gold_tables(spark, lake)[n]) for n in daily.REPLACED_DIMENSIONS}
    assert all(before.values())
    for text in ("[]", "{broken", "", '[{"other": 1}]'):
        for name in ("users", "products"):
            os.makedirs(f"{lake.landing}/static", exist_ok=True)
            with open(f"{lake.landing}/static/{name}.json", "w") as f:
                f.write(text)
        assert daily.land_static(spark, lake) == {}
        daily.rebuild_dimensions(spark, lake, daily.pending_arrivals(spark, lake))
        assert before == {n: values(daily.gold_tables(spark, lake)[n]) for n in before}


def test_a_failing_dimension_leaves_the_old_one(spark, lake, monkeypatch):
    deliver(lake, "a", review("r1", TIMES[0]))
    daily.run_daily(spark, lake)
    before = values(daily.gold_tables(spark, lake)["dim_products"])
    static(lake, products=products(p1=99.0))

    def broken(*args, **options):
        return spark.range(1).select(F.raise_error(F.lit("broken")).alias("product_id"))

    with monkeypatch.context() as patch:
        patch.setattr(daily.gold, "with_ratings", broken)
        with pytest.raises(Exception, match="broken"):
            daily.run_daily(spark, lake)
    assert values(daily.gold_tables(spark, lake)["dim_products"]) == before
    daily.run_daily(spark, lake)
    assert dict(values(daily.gold_tables(spark, lake)["dim_products"], "product_id", "list_price")) == {"p1": 99.0}


def test_the_landing_folder_is_empty_after_a_run(spark, lake):
    deliver(lake, "a 1+2%", event("e1", TIMES[0]))
    deliver(lake, "b", event("e2", TIMES[0]))
    daily.run_daily(spark, lake)
    left = glob.glob(f"{lake.landing}/**/*.json", recursive=True)
    assert left == []
    assert sorted(os.listdir(f"{lake.archive}/stream")) == [".a 1+2%.json.crc", ".b.json.crc", "a 1+2%.json", "b.json"] or sorted(
        n for n in os.listdir(f"{lake.archive}/stream") if not n.startswith(".")
    ) == ["a 1+2%.json", "b.json"]
    assert sorted(n for n in os.listdir(f"{lake.archive}/static") if not n.startswith(".")) == ["products.json", "users.json"]
    deliver(lake, "c", event("e3", TIMES[1]))
    daily.run_daily(spark, lake)
    assert len(facts(spark, lake)["fact_events"]) == 3
    assert glob.glob(f"{lake.landing}/**/*.json", recursive=True) == []


def test_nothing_is_archived_before_it_is_safe(spark, lake, monkeypatch):
    deliver(lake, "a", event("e1", TIMES[0]))

    def fail(*args, **options):
        raise RuntimeError("no")

    with monkeypatch.context() as patch:
        patch.setattr(daily, "rebuild_facts", fail)
        with pytest.raises(RuntimeError):
            daily.run_daily(spark, lake)
    assert glob.glob(f"{lake.stream_landing}/*.json")
    daily.run_daily(spark, lake)
    assert len(facts(spark, lake)["fact_events"]) == 1
    assert glob.glob(f"{lake.stream_landing}/*.json") == []


def test_a_lake_without_an_index_gets_one(spark, lake):
    deliver(lake, "a", order("o1", TIMES[0]), item("i1", "o1", TIMES[0]), event("e1", TIMES[2]))
    daily.run_daily(spark, lake)
    folders.remove(spark, lake.index.path)
    static(lake, products=products(p1=33.0))
    deliver(lake, "b", order("o1", TIMES[1]), event("e1", TIMES[3]))
    daily.run_daily(spark, lake)
    assert prices(spark, lake) == {"i1": 33.0}
    assert_as_full_build(spark, lake)


# --- the index itself


def flat(spark, *records):
    rows = [(r["stream_type"], r["event_time"], r["data"]) for r in records]
    text = frame(spark, "stream_type string, event_time string, data string", *[(a, b, json.dumps(c)) for a, b, c in rows])
    data = F.from_json("data", schemas.T.StructType([*schemas.DATA_FIELDS]))
    return text.select("stream_type", "event_time", data.alias("d")).select("stream_type", "event_time", "d.*")


def asked(spark, relation, *keys):
    return frame(spark, "relation string, key string", *[(relation, k) for k in keys])


def test_lookups_read_touched_buckets_only(spark, tmp_path):
    index = DayIndex(str(tmp_path / "index"), 64)
    index.add(arrivals(flat(spark, *[order(f"o{n}", TIMES[n % 7]) for n in range(500)])).cache())
    ids = asked(spark, "orders", "o3", "o44", None, "unknown")
    touched = {r[0] for r in ids.where("key IS NOT NULL").select(index.bucket("key")).collect()}
    everything = {f.partition("bucket=")[2].partition("/")[0] for f in index.entries(spark).inputFiles()}
    assert len(everything) > 50 and 2 <= len(touched) <= 3
    found = index.lookup(ids)
    assert values(found, "key", "day") == [("o3", DAYS[3]), ("o44", DAYS[2])]
    # Files of other buckets may as well be gone.
    for bucket in map(int, everything):
        if bucket not in touched:
            for folder in glob.glob(f"{tmp_path}/index/entries/v*/relation=orders/bucket={bucket}/*.parquet"):
                open(folder, "w").close()
    assert values(index.lookup(ids), "key", "day") == [("o3", DAYS[3]), ("o44", DAYS[2])]


def test_links_join_days_of_one_id(spark, tmp_path):
    index = DayIndex(str(tmp_path / "index"), 4)
    index.add(arrivals(flat(spark, order("o1", TIMES[0]), item("i1", "o1", TIMES[2]), event("e1", TIMES[0]))).cache())
    assert values(index.links(spark, "of_order")) == [(DAYS[0], DAYS[2])]
    index.add(arrivals(flat(spark, order("o1", TIMES[1]), event("e1", TIMES[0]), event("e1", "junk"))).cache())
    assert values(index.links(spark, "orders")) == [(DAYS[0], DAYS[1]), (DAYS[1], DAYS[0])]
    assert (DAYS[1], DAYS[2]) in values(index.links(spark, "of_order"))
    assert values(index.links(spark, "events").distinct()) == [(None, DAYS[0]), (DAYS[0], None)]
    days = frame(spark, "day date", [DAYS[1]])
    near = values(index.linked_days(days).where("kind <> 'events'"))
    assert near == [("order_items", DAYS[1]), ("order_items", DAYS[2]), ("orders", DAYS[0]), ("orders", DAYS[1])]
    again = arrivals(flat(spark, item("i1", "o2", TIMES[4]))).cache()
    index.add(again)
    assert values(index.links(spark, "order_items").distinct()) == [(DAYS[2], DAYS[4]), (DAYS[4], DAYS[2])]
    assert values(index.affected_days(again)) == [(DAYS[0],), (DAYS[1],)]  # of the order it had before


def test_ids_are_looked_up_for_days_in_doubt_only(spark, tmp_path, monkeypatch):
    """Days that orders and events came with are affected; others only where a link leads there."""
    asked, lookup = [], DayIndex.lookup
    monkeypatch.setattr(DayIndex, "lookup", lambda self, *of: asked.append(of) or lookup(self, *of))
    index = DayIndex(str(tmp_path / "index"), 4)

    def add(*records):
        rows = arrivals(flat(spark, *records)).cache()
        index.add(rows)
        return values(index.affected_days(rows))

    first = order("o1", TIMES[0]), order("o2", TIMES[1]), item("i1", "o1", TIMES[0]), item("i2", "o2", TIMES[0]), event("e1", TIMES[2])
    assert add(*first) == [(DAYS[0],), (DAYS[1],), (DAYS[2],)] and not asked
    assert add(event("e2", "junk")) == [] and not asked
    assert add(order("o3", TIMES[0]), item("i3", "o3", TIMES[0])) == [(DAYS[0],)]  # the link of o2 puts day 1 in doubt
    assert len(asked) == 1
    assert add(item("i2", "o9", TIMES[5])) == [(DAYS[1],)]  # no order o9; o2 had the item before
    assert add(order("o3", TIMES[6])) == [(DAYS[0],), (DAYS[6],)]
    assert add(event("e1", "junk")) == [(DAYS[2],)]


def test_arrivals_are_shuffled_once(spark, tmp_path, monkeypatch):
    seen, link = [], DayIndex._link

    def watched(self, new):
        seen.append(new._jdf.queryExecution().executedPlan().toString())
        link(self, new)

    monkeypatch.setattr(DayIndex, "_link", watched)
    before = folders.children(spark, shared_folder(spark) + "/commerce_lake")
    index = DayIndex(str(tmp_path / "index"), 4)
    for day in ("2024-01-01", "2024-01-02"):
        index.add(arrivals(flat(spark, order("o1", f"{day} 08:00:00"), order("o1", f"{day} 08:00:00"))))
    assert len(seen) == 2 and all("Exchange" not in plan for plan in seen)
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert values(index.links(spark, "orders")) == [(d1, d2), (d2, d1)]
    left = folders.children(spark, shared_folder(spark) + "/commerce_lake")
    assert not [n for n in left if n.startswith("entries") and n not in before]


def test_compacting_changes_no_answer(spark, tmp_path):
    index = DayIndex(str(tmp_path / "index"), 2)
    for n in range(6):
        index.add(arrivals(flat(spark, order("o1", TIMES[n]), order(f"x{n}", TIMES[n]))).cache())
    before = values(index.entries(spark))
    assert index.compact(spark, most_files=4)
    assert values(index.entries(spark)) == before
    assert not index.compact(spark, most_files=4)
    index.add(arrivals(flat(spark, order("o1", TIMES[6]))).cache())
    assert values(index.lookup(asked(spark, "orders", "o1")), "day") == [(d,) for d in DAYS]


def test_facts_of_a_day_read_linked_partitions_only(spark, lake):
    deliver(lake, "a", *[order(f"o{n}", TIMES[n]) for n in range(6)], *[item(f"i{n}", f"o{n}", TIMES[n]) for n in range(6)])
    daily.run_daily(spark, lake)
    deliver(lake, "b", item("i9", "o1", TIMES[3]))
    daily.run_daily(spark, lake)
    days = frame(spark, "day date", [DAYS[1]])
    near = lake.index.linked_days(days).where("kind = 'order_items'").select("day")
    assert values(near) == [(DAYS[1],), (DAYS[3],)]
    tables = daily.bronze_tables(spark, lake)
    found = lake.index.records_of(tables, days, EVENT_DATE)
    assert values(found["order_items"], "order_item_id") == [("i1",), ("i3",), ("i9",)]
    assert values(found["orders"], "order_id") == [("o1",)]
    assert "dynamicpruning" in of_days(tables["order_items"], near, EVENT_DATE)._jdf.queryExecution().executedPlan().toString()


# --- ratings


def rating_rows(spark, *records):
    rows = flat(spark, *records)
    stamps = frame(spark, "event_time string, stamp string", *sorted({(r["event_time"], r["ingestion_time"]) for r in records}))
    return rows.join(stamps, "event_time").withColumnRenamed("stamp", "ingestion_time").cache()


def test_ratings_by_changes_equal_those_of_all_reviews(spark, tmp_path):
    rng = random.Random(3)
    state, everything = RatingState(str(tmp_path / "ratings"), 4), None
    for number in range(4):
        records = []
        for _ in range(20):  # the time tells the arrival here
            record = review(rng.choice([f"r{rng.randrange(15)}", None]), TIMES[number], f"p{rng.randrange(4)}", rng.choice([1.0, 2.5, 4.0, None]))
            records.append({**record, "ingestion_time": f"2024-02-0{number + 1}"})
        rows = rating_rows(spark, *records)
        state.add(rows, number)
        if number == 2:
            state.add(rows, number)  # again, as after a failure
            assert state.compact(spark, most_files=0)
        everything = rows if everything is None else everything.unionByName(rows)
        products = frame(spark, "product_id string, product_name string, category string, price double, brand string", *[[f"p{k}", "n", "c", 1.0, "b"] for k in range(4)])
        full = values(daily.gold.build_dim_products(products, everything))
        assert values(daily.gold.with_ratings(products, state.ratings(spark))) == full


def test_an_addition_reads_its_own_buckets_only(spark, tmp_path):
    state = RatingState(str(tmp_path / "ratings"), 64)
    state.add(rating_rows(spark, *[{**review(f"r{k}", TIMES[0]), "ingestion_time": "1"} for k in range(200)]), 0)
    mine = rating_rows(spark, {**review("r7", TIMES[1], "p2", 1.0), "ingestion_time": "2"})
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit("id r7")), F.lit(64))).first()[0]
    spoiled = [f for f in glob.glob(f"{tmp_path}/ratings/v*/records/bucket=*/*/*.parquet") if f"/bucket={bucket}/" not in f]
    assert len(spoiled) > 40
    for file in spoiled:
        open(file, "w").close()
    state.add(mine, 1)
    assert values(state.ratings(spark), "product_id", "avg_rating", "review_count") == [("p1", 4.0, 199), ("p2", 1.0, 1)]
