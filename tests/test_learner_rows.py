"""What a search for conditions deals and reads again: narrow rows, in pieces that follow their number."""

import random

from relweave.functions.aggregates import Agg
from relweave.operators import conditional
from relweave.operators import roles as R
from relweave.plans import learners
from relweave.plans.model import DataModel, Placeholder, View


def planted(spark):
    rng = random.Random(2)
    items = [(rng.randrange(120), rng.randrange(10), rng.choice("ab")) for _ in range(900)]
    totals = [0.0] * 120
    for k, x, c in items:
        totals[k] += (3.0 if c == "a" else 1.0) if x > 4 else (-2.0 if c == "a" else 0.0)
    right = spark.createDataFrame([(k, float(x), c) for k, x, c in items], "rk long, x double, c string")
    right = R.set_role(R.set_role(right, "x", R.NUMERICAL), "c", R.CATEGORICAL)
    rows = R.set_role(spark.createDataFrame(list(enumerate(totals)), "k long, y double"), "y", R.TARGET)
    dm = DataModel(Placeholder("population", ("k",))).add("items")
    dm.population.join(dm.items, on=("k", "rk"))
    return dm, View(rows, {"items": right})


def test_pieces_follow_the_rows(spark, monkeypatch):
    left = spark.createDataFrame([(i,) for i in range(900)], "k long")
    right = spark.createDataFrame([(i % 700, float(i)) for i in range(3000)], "rk long, x double")
    monkeypatch.setattr(conditional, "PIECE", 100)
    spark.conf.set("spark.relweave.hotRows", "1000")
    try:
        found, held = conditional.sums(left, right, [Agg("SUM", "`x`", None, "s")], [("k", "rk")], "a")
    finally:
        spark.conf.unset("spark.relweave.hotRows")
    assert held.rdd.getNumPartitions() == 39 and found.count() == 900


def test_no_arrays_are_dealt_and_the_last_tree_is_not_brought_back(spark, monkeypatch):
    dm, view = planted(spark)
    lefts, plain = [], conditional.sums
    monkeypatch.setattr(conditional, "sums", lambda left, *a: lefts.append(left) or plain(left, *a))
    learner = learners.BoostedAggregates(num_features=2, max_depth=2, n_thresholds=4, min_num_samples=5).fit(dm, view, "y")
    assert len(learner.trees) == 2 and all(len(leaves) == 4 for _, leaves in learner.trees)
    assert len(lefts) == 4  # search, two times deeper, the first tree brought back
    assert not any("array" in f.dataType.typeName() for left in lefts for f in left.schema.fields)


def test_deep_trees_fit_what_is_left(spark):
    dm, view = planted(spark)
    learner = learners.BoostedAggregates(num_features=3, max_depth=2, n_thresholds=9, min_num_samples=5).fit(dm, view, "y")
    names = [f.name for f in learner.features()]
    rows = learner.transform(dm, view).join(view.population, "k").collect()
    left = [r["y"] - sum(r[n] for n in names) for r in rows]
    mean, all_ = sum(left) / len(left), sum(r["y"] for r in rows) / len(rows)
    assert sum((v - mean) ** 2 for v in left) < 0.05 * sum((r["y"] - all_) ** 2 for r in rows)


def test_thresholds_are_found_once(spark, monkeypatch):
    dm, view = planted(spark)
    learner = learners.ConditionSearch(n_thresholds=3)
    relation = learner._relations(dm, view)[0]
    first = learner.conditions(relation)
    monkeypatch.setattr(learners.F, "percentile_approx", None)
    assert learner.conditions(relation) == first
