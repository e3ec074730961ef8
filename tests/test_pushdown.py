"""Gradients carried down joins, and gains of conditions, next to plain versions."""

import random

import pytest

from relweave.operators import roles as R
from relweave.plans import pushdown
from relweave.plans.model import Join, Placeholder


def rows(spark, seed, n=60):
    rng = random.Random(seed)
    left = [(rng.choice([1, 2, 3, None]), rng.randrange(50), float(rng.randrange(-9, 9)), 1.0) for _ in range(n)]
    right = [(rng.choice([1, 2, 4, None]), rng.randrange(50), rng.randrange(100)) for _ in range(n)]
    return left, right, spark.createDataFrame(left, "k int, t int, __g double, __h double"), spark.createDataFrame(right, "r int, s int, x int")


@pytest.mark.parametrize("bounds", [None, (3, 10), (0, 7), (5, None)])
def test_sums_reach_the_right_rows(spark, bounds):
    left, right, a, b = rows(spark, str(bounds))
    times = {} if bounds is None else {"time_stamps": ("t", "s"), "horizon": bounds[0], "memory": bounds[1]}
    found = pushdown.carried(a, Join(Placeholder("b"), (("k", "r"),), **times), b).select("r", "s", "x", "__g", "__h").collect()
    want = []
    for r, s, x in right:
        seen = [g for k, t, g, _ in left if k is not None and k == r and (bounds is None or (s <= t - bounds[0] and (bounds[1] is None or s > t - bounds[0] - bounds[1])))]
        if seen:
            want.append((r, s, x, sum(seen), float(len(seen))))
    assert sorted(map(tuple, found)) == sorted(want)


def test_gains(spark):
    rng = random.Random(1)
    data = [(rng.randrange(10), rng.choice([1.5, -2.0, None, float("nan")]), rng.gauss(0, 1), float(rng.randrange(1, 4))) for _ in range(200)]
    df = spark.createDataFrame(data, "a int, x double, __g double, __h double")
    found = pushdown.gains(df, ["`a` > 4", "`a` = 3", "`a` > 100", "`x` > 0"], [None, "x"])

    def part(keep, value):
        own = [(v if v is not None and v == v else 0.0, g, h) for i, (_, v, g, h) in enumerate(data) if keep[i]]
        own = [(1.0, g, h) for _, g, h in own] if value is None else own
        return sum(v * g for v, g, _ in own), sum(v * v * h for v, _, h in own)

    for cond, test in (("`a` > 4", lambda r: r[0] > 4), ("`a` = 3", lambda r: r[0] == 3)):
        for value in (None, "x"):
            yes = [test(r) for r in data]
            (g1, h1), (g0, h0), (g, h) = part(yes, value), part([not y for y in yes], value), part([True] * len(data), value)
            assert found[cond, value] == pytest.approx(g1 * g1 / h1 + g0 * g0 / h0 - g * g / h, rel=1e-6, abs=1e-9)
    assert not any(c == "`a` > 100" for c, _ in found)
    # NaN counts as larger than everything in a condition, and as nothing in a sum
    assert ("`x` > 0", None) in found


def test_search_goes_through_lookups_and_levels(spark):
    from pyspark.sql import functions as F

    from relweave.plans.learners import ConditionSearch
    from relweave.plans.model import DataModel, View

    rng = random.Random(3)
    people = spark.createDataFrame([(i,) for i in range(80)], "p int")
    visits = spark.createDataFrame([(i, rng.randrange(80), i % 30) for i in range(400)], "v int, vp int, vd int")
    doctors = spark.createDataFrame([(i, i % 5) for i in range(30)], "d int, area int")
    notes = spark.createDataFrame([(rng.randrange(30), rng.choice("abcd"), float(rng.randrange(9))) for _ in range(300)], "nd int, kind string, size double")
    notes = R.set_role(R.set_role(notes, "kind", R.CATEGORICAL), "size", R.NUMERICAL)
    per_doctor = notes.groupBy("nd").agg(F.count_if(F.col("kind") == "b").cast("double").alias("n"))
    total = visits.join(per_doctor, F.col("vd") == F.col("nd"), "left").groupBy("vp").agg(F.sum("n").alias("y"))
    rows = people.join(total, F.col("p") == F.col("vp"), "left").select("p", F.coalesce("y", F.lit(0.0)).alias("y"))
    dm = DataModel(Placeholder("population", ("p",))).add("visits", "doctors", "notes")
    dm.population.join(dm.visits, on=("p", "vp"))
    dm.visits.join(dm.doctors, on=("vd", "d"), relationship="many_to_one")
    dm.doctors.join(dm.notes, on=("d", "nd"))
    view = View(R.set_role(rows, "y", R.TARGET), {"visits": visits, "doctors": doctors, "notes": notes})
    learner = ConditionSearch(num_features=1, aggregation=("SUM",), n_thresholds=1, n_most_frequent=4).fit(dm, view, "y")
    name = learner.features()[0].name
    off = learner.transform(dm, view).join(rows, "p").where(F.abs(F.col(f"`{name}`") - F.col("y")) > 1e-6)
    assert off.count() == 0 and "kind" in str(learner.extra[("visits", "doctors", "notes")][0].condition)
