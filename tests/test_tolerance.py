"""Odd values, keys that are no numbers, far origins, and several targets."""

import numpy as np
from pyspark.sql import functions as F

from relweave.functions import exprs
from relweave.operators import moments, prep
from relweave.operators import roles as R
from relweave.plans.features import Propositionalizer
from relweave.plans.flow import Pipeline
from relweave.plans.learners import BoostedAggregates
from relweave.plans.model import DataModel, Placeholder, View


def test_missing_and_malformed_values(spark):
    df = spark.createDataFrame([("1.5", "a", "2020-01-02"), ("NULL", "NULL", "x"), ("", "", ""), ("abc", None, None)], "x string, c string, t string")
    out = R.set_role(R.set_role(R.set_role(df, "x", R.NUMERICAL), "c", R.CATEGORICAL), "t", R.TIME_STAMP).collect()
    assert [r.x for r in out] == [1.5, None, None, None]
    assert [r.c for r in out] == ["a", None, None, None]
    assert [r.t is None for r in out] == [False, True, True, True]
    assert [r.x for r in R.apply_types(df, {"x": "Integer"}).collect()][2:] == [None, None]


def test_hash_of_any_key(spark):
    df = spark.createDataFrame([(f"key {i}", i) for i in range(2000)] + [(None, None)], "k string, n long")
    rows = df.select(exprs.hash_unit("k").alias("h"), exprs.hash_unit("n").alias("m"), exprs.hash_unit(F.col("n").cast("string")).alias("s")).collect()
    assert all(0 <= r.h < 1 and r.m == r.s for r in rows)
    assert abs(np.mean([r.h for r in rows]) - 0.5) < 0.05 and len({r.h for r in rows}) > 1900


def test_moments_far_from_the_origin(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 2)) + [1e9, -1e9]
    y = x[:, 0] - 1e9 + rng.normal(size=3000)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y, strict=True)], "a double, b double, y double").repartition(5)
    found = moments.covariances(df, ["a", "b", "y"])
    want = np.cov(np.column_stack([x, y]).T, bias=True)
    assert np.allclose(found.cov, want, atol=1e-5) and np.allclose(found.mean, [*x.mean(axis=0), y.mean()])
    n, mean, var, cov, mean_y, var_y = moments.cross_moments(df, ["a", "b"], F.col("y"))
    assert n == 3000 and np.allclose(var, np.diag(want)[:2], atol=1e-5) and np.allclose(cov, want[:2, 2], atol=1e-5) and np.isclose(var_y, want[2, 2])
    assert moments.covariances(df.limit(0), ["a"]).n == 0


def test_every_target_has_its_learners(spark):
    right = spark.createDataFrame([(i % 50, float(i % 7), float(i * i % 11)) for i in range(600)], "k long, u double, v double")
    right = R.set_role(R.set_role(right, "u", R.NUMERICAL), "v", R.NUMERICAL)
    sums = right.groupBy("k").agg(F.sum("u").alias("y1"), F.sum("v").alias("y2"))
    left = R.set_role(R.set_role(sums.select("k", "y1", "y2"), "y1", R.TARGET), "y2", R.TARGET)
    dm = DataModel(Placeholder("population", ("k",))).add("right")
    dm.population.join(dm.right, on="k")
    pipe = Pipeline(dm, feature_learners=[BoostedAggregates(num_features=1, linear=True, n_thresholds=2)])
    view = View(left, {"right": right})
    flat = pipe.fit(view, ["y1", "y2"]).transform(view)
    names = [f.name for f in pipe.features()]
    assert [n.rsplit("__for_")[1] for n in names] == ["y1", "y2"]
    for r in flat.collect():
        assert abs(r[names[0]] - r.y1) < 1e-6 and abs(r[names[1]] - r.y2) < 1e-6


def test_words_follow_the_view(spark):
    docs = spark.createDataFrame([(1, "a b a", 1.0), (2, "c", 0.0), (3, None, 0.0)], "id long, t string, y double")
    docs = docs.withMetadata("t", {"role": R.TEXT}).withMetadata("y", {"role": R.TARGET})
    pipe = Pipeline(DataModel(Placeholder("population", ("id",))), preprocessors=[prep.TextFieldSplitter(["id"])], feature_learners=[Propositionalizer(("COUNT",))])
    pipe.fit(View(docs.where("id < 3"), {}), ["y"])
    assert {r.id: r.words_of_t__count for r in pipe.transform(View(docs, {})).collect()} == {1: 3, 2: 1, 3: 0}
