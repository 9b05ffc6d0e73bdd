"""Small literal frames."""

from __future__ import annotations

import json
import os


def frame(spark, schema: str, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def values(df, *columns) -> list:
    """Rows as sorted tuples (nulls first)."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: tuple((v is not None, v) for v in r))


def envelope(stream_type, event_time, ingestion_time="2024-01-02 00:00:00", **data):
    return {
        "stream_type": stream_type,
        "event_time": event_time,
        "priority": 0,
        "ingestion_time": ingestion_time,
        "data": data,
    }


def write_array(folder, name, records) -> str:
    """An array file as the producer of the landing folder writes it."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(str(folder), name)
    with open(path, "w") as f:
        json.dump(records, f, indent=2)
    return path


def event(number, time, kind="view", product="p1", user="u1", **more):
    return envelope(
        "events", time, event_id=number, user_id=user, product_id=product, event_type=kind, **more
    )


def order(number, time, status="Completed", total=10.0, user="u1", **more):
    return envelope(
        "orders", time, order_id=number, user_id=user, total_amount=total, order_status=status, **more
    )


def item(number, parent, time, product="p1", quantity=2, price=5.0, **more):
    return envelope(
        "order_items",
        time,
        order_item_id=number,
        order_id=parent,
        product_id=product,
        quantity=quantity,
        item_price=price,
        **more,
    )


def review(number, time, product="p1", rating=4.0, user="u1"):
    return envelope(
        "reviews",
        time,
        review_id=number,
        product_id=product,
        user_id=user,
        rating=rating,
        review_text="fine",
    )
