"""Sums under many conditions: one array per left row, the same numbers as a column each."""

import random

import pytest

from relweave.functions.aggregates import Agg
from relweave.functions.timecols import days
from relweave.operators import conditional, grouping, interval

AGGS = [
    Agg(f, None if f == "COUNT" else "`x`", c, f"{f.lower()}{k}")
    for k, c in enumerate([None, "`x` > 2.0", "NOT (`x` > 2.0)", "`c` = 'a'", "NOT (`c` = 'a')"])
    for f in ("COUNT", "SUM")
]


def sides(spark, timed=False):
    rng = random.Random(3)
    keys = [*range(40), None]
    at = lambda: f"2024-01-{rng.randint(1, 28):02d} 0{rng.randint(0, 9)}:00:00" if rng.random() > 0.05 else None
    left = [(i % 300, rng.choice(keys), at()) for i in range(330)]  # ids repeat
    right = [(rng.choice(keys), at(), rng.choice([None, 1.0, 2.5, -3.0, 7.0]), rng.choice(["a", "b", None])) for _ in range(3000)]
    right += [(5, "2024-01-05 00:00:00", 1.0, "a")] * 400  # more rows than a batch of the test holds
    l = spark.createDataFrame(left, "id long, k long, t string").selectExpr("id", "k", "CAST(t AS TIMESTAMP) AS t")
    r = spark.createDataFrame(right, "rk long, rt string, x double, c string").selectExpr("rk", "CAST(rt AS TIMESTAMP) AS rt", "x", "c")
    return l, r


def packed(rows, name):
    return sorted(((r["id"], r["k"], r["t"], [round(v, 9) for v in r[name]]) for r in rows.collect()), key=str)


def wide(rows):
    return sorted(((r["id"], r["k"], r["t"], [round(float(r[a.alias] or 0.0), 9) for a in AGGS]) for r in rows.collect()), key=str)


@pytest.fixture
def small_batches(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    monkeypatch.setattr(conditional, "CELLS", 130)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sums_by_key(spark, small_batches):
    left, right = sides(spark)
    found, _ = conditional.sums(left, right, AGGS, [("k", "rk")], "a")
    assert packed(found, "a") == wide(grouping.join_aggregate(left, right, AGGS, [("k", "rk")]))


def test_sums_in_windows(spark, small_batches):
    left, right = sides(spark, True)
    left = left.dropDuplicates(["id"])
    right = right.where("rk <> 5 OR x <> 1.0")
    plan = interval.plan_interval(left, right, AGGS, on=[("k", "rk")], times=("t", "rt"), row_id=["id"], horizon=days(1), memory=days(4))
    found, _ = conditional.sums(left, right, AGGS, [("k", "rk")], "a", plan)
    assert packed(found, "a") == wide(left.join(interval.interval_aggregate(left, right, plan), "id"))


def test_values_that_are_no_numbers(spark):
    left = spark.createDataFrame([(1, 1, None), (2, 2, None), (3, 3, None)], "id long, k long, t timestamp")
    right = spark.createDataFrame([(1, float("inf")), (1, 1.0), (2, float("nan")), (3, float("-inf"))], "rk long, x double")
    aggs = [Agg("SUM", "`x`", c, f"s{i}") for i, c in enumerate([None, "`x` <= 1.0"])]
    found, _ = conditional.sums(left, right, aggs, [("k", "rk")], "a")
    assert {r["id"]: r["a"] for r in found.collect()} == {1: [float("inf"), 1.0], 2: [0.0, 0.0], 3: [float("-inf"), float("-inf")]}


def test_hot_keys_and_other_aggregates_take_the_other_form(spark, hot):
    left, right = sides(spark)
    assert conditional.sums(left, right, AGGS, [("k", "rk")], "a") is None
    assert conditional.sums(left, right, [Agg("MAX", "`x`", None, "m")], [("k", "rk")], "a") is None
