import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from custbehav.functions.columns import amount_sums, amount_total, format_percent
from custbehav.functions.ordering import grouped_quantiles, running_totals, unit_bucket, values_at_ranks


def skewed_counts(seed=3):
    """One group holds most rows; prices of very different size, some negative; a null group."""
    generator = random.Random(seed)
    counts = {}
    for i in range(4000):
        group = "hot" if i % 3 else generator.choice(["a", "b", None])
        price = round(generator.choice([-1, 1]) * generator.lognormvariate(2, 3), 2)
        counts[group, price] = counts.get((group, price), 0) + generator.randint(1, 4)
    return [(g, p, c) for (g, p), c in counts.items()]


def test_grouped_quantiles_equal_numpy(spark):
    rows = skewed_counts()
    frame = spark.createDataFrame(rows, "g string, price double, copies long")
    found = grouped_quantiles(frame, ["g"], "price", "copies", {"q1": 0.25, "median": 0.5, "q99": 0.99}).collect()
    assert {row["g"] for row in found} == {"hot", "a", "b", None}
    for row in found:
        values = np.repeat([p for g, p, _ in rows if g == row["g"]], [c for g, _, c in rows if g == row["g"]])
        assert row["n"] == len(values)
        for name, q in (("q1", 0.25), ("median", 0.5), ("q99", 0.99)):
            assert row[name] == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_quantile_with_infinite_and_single_values(spark):
    frame = spark.createDataFrame([("a", float("inf"), 5), ("b", 2.0, 1)], "g string, price double, copies long")
    found = {r["g"]: r["q"] for r in grouped_quantiles(frame, ["g"], "price", "copies", {"q": 0.99}).collect()}
    assert found == {"a": float("inf"), "b": 2.0}


def test_running_totals_equal_a_sorted_scan(spark):
    generator = random.Random(5)
    rows = [(generator.random(), generator.randint(0, 9)) for _ in range(2000)] + [(0.0, 1), (1.0, 2)]
    frame = spark.createDataFrame(rows, "score double, n long")
    for descending in (False, True):
        found = running_totals(frame, [], "score", unit_bucket(F.col("score")), ["n"], descending).collect()
        total, expected = 0, {}
        for score, n in sorted(rows, reverse=descending):
            expected[score] = total
            total += n
        assert {row["score"]: row["n_before"] for row in found} == expected


def test_values_at_ranks_of_structs(spark):
    frame = spark.range(1000).select(
        F.struct((F.col("id") % 50).alias("hash"), F.col("id").alias("user_id")).alias("key"), F.lit(1).alias("rows")
    )
    row = values_at_ranks(frame, [], "key", "rows", F.shiftright(F.col("key.hash"), 3), {"v": lambda n: n - 1 - 990}).first()
    ordered = sorted((i % 50, i) for i in range(1000))
    assert tuple(row["v"]) == ordered[9] and row["n"] == 1000


def test_amounts_do_not_depend_on_order_and_keep_large_values(spark):
    prices = [0.1] * 10 + [0.2, 0.005, 123.45] + [3e15]
    frame = spark.createDataFrame([(p,) for p in prices] + [(None,)], "price double").repartition(4)
    total = frame.agg(*amount_sums(F.col("price"), "x")).select(amount_total("x").alias("t")).first()["t"]
    assert total == 3e15 + 124.655
    small = frame.filter("price < 1").agg(*amount_sums(F.col("price"), "x")).select(amount_total("x").alias("t"))
    assert small.first()["t"] == 1.205


def test_percent_text_equals_python(spark):
    shares = [p / n for n in (1, 3, 7, 16, 32, 80, 400, 2000) for p in range(0, n + 1)]
    frame = spark.createDataFrame([(s,) for s in shares], "s double")
    for row in frame.select("s", format_percent(F.col("s")).alias("t")).collect():
        assert row["t"] == f"{row['s']:.1%}", row


def test_amounts_are_added_exactly_whatever_their_size_and_order(spark):
    from custbehav.functions.columns import amount_sums, amount_total

    def total(values, partitions):
        frame = spark.createDataFrame([(v,) for v in values], "price double").repartition(partitions)
        return frame.agg(*amount_sums(F.col("price"), "paid")).select(amount_total("paid").alias("t")).first()["t"]

    values = [1e9 + 0.25] * 40 + [0.1] * 70 + [3e-7] * 50 + [7e12]
    for seed in range(3):
        random.Random(seed).shuffle(values)
        assert total(values, seed + 1) == 7040000000017.000015
    assert total([], 1) == 0.0
    with pytest.raises(Exception, match="(?i)numeric|decimal"):
        total([1e20], 1)
