"""Literal rows for the unit tests."""

import csv

from custbehav.operators import cleaning
from custbehav.schema import RAW

from pyspark.sql import functions as F


# One valid row; tests state what differs from it.
TEMPLATE = {
    "event_time": "2020-01-01 00:00:00 UTC", "event_type": "purchase", "product_id": 4711,
    "category_id": "2053013555631882655", "category_code": "garden.tools.hand", "brand": "orbit", "price": 12.5,
    "user_id": 1, "user_session": "visit-7f3a9c21",
}
SHORT = {"who": "user_id", "at": "event_time", "what": "event_type"}


def made(*who_and_when, **changes):
    """The template with a user, a time and other columns changed."""
    changes = {SHORT.get(name, name): value for name, value in changes.items()}
    return TEMPLATE | dict(zip(("user_id", "event_time"), who_and_when)) | changes


def raw_frame(spark, rows, source="sample.csv"):
    values = [tuple(float(r[c]) if c == "price" and r[c] is not None else r[c] for c in RAW.names) for r in rows]
    return spark.createDataFrame(values, RAW).withColumn("source_file", F.lit(source))


def stored(spark, rows, cfg):
    return cleaning.clean(raw_frame(spark, rows), cfg)


def write_csv(path, rows, columns=None):
    names = columns or RAW.names
    with open(path, "w", newline="") as file:
        writer = csv.DictWriter(file, names, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(rows)
