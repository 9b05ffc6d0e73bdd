import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from commerce_lake.functions import calendar, cleaning
from commerce_lake.functions.keys import add_surrogate_key, hash_key, non_negative
from commerce_lake.operators.quality import key_collisions
from frames import frame, values


def test_unreadable_times_become_null(spark):
    df = frame(spark, "t string", ["2024-01-01 05:06:07"], ["junk"], [None], ["2024-01-01"])
    found = df.select(
        "t", cleaning.parse_date("t").alias("d"), cleaning.parse_timestamp("t").alias("ts")
    )
    day = dt.date(2024, 1, 1)
    assert values(found) == [
        (None, None, None),
        ("2024-01-01", day, dt.datetime(2024, 1, 1)),
        ("2024-01-01 05:06:07", day, dt.datetime(2024, 1, 1, 5, 6, 7)),
        ("junk", None, None),
    ]


def test_non_finite_numbers_become_null_at_any_depth(spark):
    inf, nan = math.inf, math.nan
    rows = [[x, (x, 1), [x, 2.5]] for x in (nan, inf, -inf, 1.5)] + [[None, None, None]]
    df = frame(spark, "x double, s struct<y double, n int>, a array<double>", *rows)
    found = cleaning.scrub_non_finite(df).collect()
    assert [r["x"] for r in found] == [None, None, None, 1.5, None]
    assert [r["s"] and r["s"]["y"] for r in found] == [None, None, None, 1.5, None]
    assert found[0]["s"]["n"] == 1 and found[4]["s"] is None
    assert [r["a"] for r in found] == [[None, 2.5]] * 3 + [[1.5, 2.5], None]


def test_casts_never_fail(spark):
    df = frame(spark, "a string, b string", ["2.0", "1.5"], ["7", "x"], ["x", None], ["3e10", "1"])
    found = cleaning.cast_columns(df, {"a": "int", "b": "double"})
    assert [tuple(r) for r in found.collect()] == [
        (2, 1.5), (7, None), (None, None), (None, 1.0),
    ]


def test_column_names_are_stripped(spark):
    assert cleaning.strip_column_names(frame(spark, "` a ` int, `b` int")).columns == ["a", "b"]


def test_literal_lookup_has_a_default(spark):
    df = frame(spark, "k string", ["a"], ["z"], [None])
    found = df.select(cleaning.literal_lookup(F.col("k"), {"a": 0, "b": 1}, 99))
    assert [r[0] for r in found.collect()] == [0, 99, 99]


# 32-bit hash ids of these texts.
KNOWN_IDS = {
    "Completed": 1385611969,
    "Cancelled": 117756722,
    "Returned": 496464601,
    "cart": 751442116,
    "wishlist": 1288181839,
    "view": 1617517293,
    "purchase": 1482606664,
}


def test_hash_keys_are_stable_and_null_for_null(spark):
    df = frame(spark, "k string", *[[k] for k in KNOWN_IDS], [None])
    found = {r[0]: r[1] for r in df.select("k", hash_key("k")).collect()}
    assert found == {**KNOWN_IDS, None: None}


def test_smallest_hash_does_not_fail(spark):
    smallest = -(2**31)
    df = frame(spark, "n int", [smallest], [-5], [7])
    assert [r[0] for r in df.select(non_negative(F.col("n"), smallest)).collect()] == [smallest, 5, 7]
    with pytest.raises(Exception, match="OVERFLOW"):
        df.select(F.abs("n")).collect()


@pytest.mark.parametrize("strategy", ["hash", "hash64", "dense", "monotonic"])
def test_key_strategies_give_unique_ids(spark, strategy):
    names = spark.range(1000).select(F.format_string("n%04d", "id").alias("name"))
    keyed = add_surrogate_key(names, "name", "id", strategy)
    assert keyed.select("id").distinct().count() == 1000
    assert key_collisions(keyed, "id", "name").isEmpty()
    if strategy == "dense":
        assert values(keyed, "id") == [(i,) for i in range(1, 1001)]
        assert keyed.where("name = 'n0007'").first()["id"] == 8


def test_date_attributes(spark):
    df = frame(spark, "d date", [dt.date(2024, 3, 2)], [dt.date(2024, 12, 30)])
    assert values(df.select(*calendar.date_attributes("d"))) == [
        (dt.date(2024, 3, 2), 2024, 3, 2, 1, 7, "Saturday", "March", True),
        (dt.date(2024, 12, 30), 2024, 12, 30, 4, 2, "Monday", "December", False),
    ]


@pytest.mark.parametrize("today", [dt.date(2024, 1, 1), dt.date(2024, 5, 17), dt.date(2023, 12, 31)])
def test_rotating_day_counts_full_days(spark, today):
    first, last = dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 5, 1)
    df = frame(spark, "t timestamp_ntz", [first], [last], [dt.datetime(2024, 1, 3)])
    days = (last - first).days
    offset = today.timetuple().tm_yday % (days + 1)
    expected = (first + dt.timedelta(days=offset)).date()
    assert calendar.rotating_day(df, "t", today) == expected


def test_day_filter_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    rows = [[dt.datetime(2024, 1, 14, 23, 59, 59)], [dt.datetime(2024, 1, 15)], [dt.datetime(2024, 1, 16)]]
    frame(spark, "t timestamp_ntz", *rows).write.parquet(path)
    df = spark.read.parquet(path).where(calendar.on_day("t", dt.date(2024, 1, 15)))
    assert values(df) == [(dt.datetime(2024, 1, 15),)]
    df.explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(t,2024-01-15T00:00)" in plan and "LessThan(t,2024-01-16T00:00)" in plan
