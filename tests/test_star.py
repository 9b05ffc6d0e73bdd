import datetime as dt

from pyspark.sql import functions as F

from commerce_lake import schemas
from commerce_lake.plans import gold
from frames import frame, values

TIMES = "2024-01-0{} 10:00:00"


def test_users_are_unique(spark):
    users = frame(
        spark, "user_id string, name string, email string, city string, gender string",
        ["u1", "A", "a", "Rome", "F"], ["u1", "A", "a", "Paris", "F"], [None, "X", "x", "Y", "M"],
    )
    assert values(gold.build_dim_users(users)) == [("u1", "A", "a", "F", "Paris")]


def test_ratings(spark):
    reviews = frame(
        spark, "review_id string, product_id string, rating double",
        ["r1", "p1", 4.0], ["r2", "p1", 5.0], ["r3", "p1", None], [None, "p1", 4.0], ["r1", "p1", 4.0],
    )
    products = frame(
        spark, "product_id string, product_name string, category string, price double, brand string",
        ["p1", "n", "c", 1.5, "b"], ["p2", "n", "c", 2.5, "b"], [None, "n", "c", 2.5, "b"],
    )
    dim = gold.build_dim_products(products, reviews)
    schemas.require_schema(dim, schemas.DIM_PRODUCTS)
    assert values(dim, "product_id", "list_price", "avg_rating", "review_count") == [
        ("p1", 1.5, 4.33, 2), ("p2", 2.5, 0.0, 0),
    ]
    kept = gold.build_dim_products(products, reviews, resent=False)
    assert values(kept, "avg_rating", "review_count") == [(0.0, 0), (4.25, 3)]


def test_dates_within_bounds_only(spark):
    days = gold.event_days(
        frame(spark, "event_time string", [TIMES.format(1)], ["junk"], [None], ["1990-01-01 00:00:00"]),
        frame(spark, "event_time string", [TIMES.format(1)], [TIMES.format(3)], ["2027-01-01 00:00:00"]),
    )
    dim = gold.build_dim_date(days)
    schemas.require_schema(dim, schemas.DIM_DATE)
    assert values(dim, "date_id") == [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 3),)]
    more = gold.build_dim_date(days, dt.date(1990, 1, 1), dt.date(2030, 1, 1))
    assert values(gold.merge_dim_date(dim, more), "date_id")[0] == (dt.date(1990, 1, 1),)
    assert gold.merge_dim_date(dim, more).count() == 4


ITEMS = "order_item_id string, order_id string, product_id string, quantity int, item_price double, ingestion_time string"
ORDERS = "order_id string, user_id string, event_time string, total_amount double, order_status string, ingestion_time string"


def order_tables(spark):
    items = frame(
        spark, ITEMS,
        ["i1", "o1", "p1", 2, 1.255, "1"], ["i2", "o1", "p9", 1, 5.0, "1"], ["i3", None, "p1", 1, 5.0, "1"],
        ["i4", "o1", None, 1, 5.0, "1"], ["i5", "o2", "p1", 3, 2.0, "1"], ["i6", "o9", "p1", 3, 2.0, "1"],
        # sent again, once with a corrected quantity
        ["i1", "o1", "p1", 2, 1.255, "2"], ["i5", "o2", "p1", 4, 2.0, "2"],
        # without id
        [None, "o1", "p1", 7, 1.0, "1"], [None, "o1", "p1", 8, 1.0, "1"], [None, "o1", "p1", 8, 1.0, "2"],
    )
    orders = frame(
        spark, ORDERS,
        ["o1", "u1", TIMES.format(1), 10.0, "Returned", "1"], ["o1", "u1", TIMES.format(1), 10.0, "Returned", "2"],
        ["o2", "u2", "junk", 10.0, None, "1"], [None, "u2", TIMES.format(1), 10.0, "Completed", "1"],
    )
    products = frame(spark, "product_id string, list_price double", ["p1", 9.5])
    return items, orders, products


def test_order_facts(spark):
    items, orders, products = order_tables(spark)
    fact = gold.build_fact_orders(items, orders, products)
    schemas.require_schema(fact, schemas.FACT_ORDERS)
    day = dt.date(2024, 1, 1)
    assert values(
        fact, "order_item_id", "user_id", "order_date_id", "status_id", "quantity", "list_price",
        "line_total", "is_returned",
    ) == [
        (None, "u1", day, 496464601, 7, 9.5, 7.0, 1),
        (None, "u1", day, 496464601, 8, 9.5, 8.0, 1),
        ("i1", "u1", day, 496464601, 2, 9.5, 2.51, 1),
        ("i2", "u1", day, 496464601, 1, None, 5.0, 1),
        ("i5", "u2", None, None, 4, 9.5, 8.0, 0),
    ]
    assert values(gold.undated(orders), "order_id") == [("o2",)]


def test_resent_files_multiply_rows_only_if_told_they_do_not_exist(spark):
    items, orders, products = order_tables(spark)
    assert gold.build_fact_orders(items, orders, products, resent=False).count() > 5


def test_order_facts_with_a_status_table_and_chosen_days(spark):
    items, orders, products = order_tables(spark)
    dense = gold.build_dim_order_status(orders, "dense")
    fact = gold.build_fact_orders(items, orders, products, dense, dates=[dt.date(2024, 1, 1)])
    assert {r[0] for r in fact.select("status_id").collect()} == {2}
    assert fact.where("order_item_id = 'i5'").isEmpty()


def test_event_facts(spark):
    events = frame(
        spark, "event_id string, user_id string, product_id string, event_type string, event_time string, ingestion_time string",
        ["e1", "u1", "p1", "view", TIMES.format(1), "1"], ["e1", "u1", "p1", "cart", TIMES.format(1), "2"],
        ["e2", None, "p1", "view", TIMES.format(1), "1"], [None, "u1", "p1", "view", TIMES.format(1), "1"],
        ["e3", "u1", "p1", None, "junk", "1"],
    )
    fact = gold.build_fact_events(events)
    schemas.require_schema(fact, schemas.FACT_EVENTS)
    assert values(fact, "event_id", "event_type_id", "funnel_step", "event_date_id") == [
        ("e1", 751442116, 751442116, dt.date(2024, 1, 1)), ("e3", None, None, None),
    ]
    ordered = gold.build_fact_events(events, funnel_order=["view", "cart", "wishlist", "purchase"])
    assert values(ordered, "event_id", "funnel_step") == [("e1", 2), ("e3", 0)]
    joined = gold.build_fact_events(events, gold.build_dim_event_type(events))
    columns = ["event_id", "event_type_id", "event_date_id"]
    assert values(joined, *columns) == values(fact, *columns)
    assert values(gold.build_fact_events(events, dates=[dt.date(2024, 1, 1)]), "event_id") == [("e1",)]


def test_lookup_dimension_keys(spark):
    rows = frame(spark, "event_type string", ["view"], ["view"], [None], ["cart"])
    dim = gold.build_dim_event_type(rows)
    schemas.require_schema(dim, schemas.DIM_EVENT_TYPE)
    assert values(dim) == [(751442116, "cart"), (1617517293, "view")]
    wide = gold.build_dim_event_type(rows, "hash64")
    assert wide.where(F.col("event_type_id") < 0).isEmpty()


def test_records_without_id_repeat_only_as_a_whole(spark):
    reviews = spark.createDataFrame(
        [(None, "p", 5.0, u, "x") for u in ("u1", "u2", "u3", "u3")] + [(None, "p", 1.0, "u4", "x")],
        "review_id string, product_id string, rating double, user_id string, ingestion_time string",
    )
    products = spark.createDataFrame(
        [("p", "n", "c", 1.0, "b")],
        "product_id string, product_name string, category string, price double, brand string",
    )
    assert gold.build_dim_products(products, reviews).first()["avg_rating"] == 4.0
    items = spark.createDataFrame(
        [(None, "o", "p", 1, 2.0, t) for t in ("t1", "t2", "t2")],
        "order_item_id string, order_id string, product_id string, quantity int, item_price double, event_time string",
    )
    assert gold.order_lines(items).count() == 2
