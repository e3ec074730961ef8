"""Data model, learners, pipeline, series builders."""

import pytest
from pyspark.sql import functions as F

from relweave.operators import roles as R
from relweave.plans import flow, learners, predict, select
from relweave.plans.features import Propositionalizer
from relweave.plans.model import Container, DataModel, Placeholder, StarSchema, TimeSeries, View
from relweave.plans.series import DfsSeriesBuilder, StatSeriesBuilder
from relweave.queries.learning import order_model, views


def test_model_is_checked():
    p = Placeholder("population", ("id",))
    with pytest.raises(ValueError):
        p.join(Placeholder("a"), on="k", time_stamps="t", lagged_targets=True)
    with pytest.raises(ValueError):
        p.join(Placeholder("a"), on="k", memory=3)
    with pytest.raises(ValueError):
        p.join(Placeholder("a"))
    with pytest.raises(ValueError):
        Placeholder("population").join(Placeholder("a"), on="k", time_stamps="t")
    p.join(Placeholder("a"), on=["k", ("x", "y")])
    assert p.joins[0].on == (("k", "k"), ("x", "y"))


def test_container(spark):
    df = spark.range(10)
    c = Container(df, F.when(F.col("id") < 6, "train").otherwise("test")).add(other=df).freeze()
    assert c.train.population.count() == 6 and c.test.peripheral["other"].count() == 10
    with pytest.raises(ValueError):
        c.add(more=df)
    assert Container(train=df, test=df.limit(2)).test.population.count() == 2


def test_time_series_looks_back_into_training_rows(spark):
    rows = spark.createDataFrame([(i, i, float(i)) for i in range(20)], "id long, t long, x double")
    rows = R.set_role(R.set_role(rows, "x", R.NUMERICAL), "t", R.JOIN_KEY)
    split = F.when(F.col("t") < 10, "train").otherwise("test")
    series = TimeSeries(rows, "t", ["id"], horizon=1, memory=3, split=split)
    learner = Propositionalizer(("SUM", "COUNT")).fit(series, series.train)
    out = {r["id"]: r["population_history__sum__x"] for r in learner.transform(series, series.test).collect()}
    assert out[10] == 7 + 8 + 9 and len(out) == 10


def fit_quality(df, target, columns):
    model = predict.LinearRegression().fit(df, columns, [target])
    return flow._quality(model, df, [target])


def test_condition_search_finds_the_planted_condition(spark, folder):
    dm, orders, tables = order_model(spark, folder)
    v = views(orders, tables)
    learner = learners.ConditionSearch(num_features=3, aggregation=("SUM", "COUNT"), n_thresholds=9).fit(dm, v["train"], "y")
    assert "SUM(`l_quantity`) WHERE `l_discount` > 0.05" in learner.features()[0].sql
    flat = learner.transform(dm, v["full"]).join(orders.select("o_orderkey", "y"), "o_orderkey")
    assert flat.count() == orders.count()
    assert fit_quality(flat, "y", [learner.features()[0].name]) > 0.999


def test_linear_aggregates_recover_the_planted_sum(spark, folder):
    dm, orders, tables = order_model(spark, folder)
    v = views(orders, tables)
    learner = learners.BoostedAggregates(num_features=1, linear=True, n_thresholds=9).fit(dm, v["train"], "y")
    flat = learner.transform(dm, v["test"]).join(orders.select("o_orderkey", "y"), "o_orderkey")
    assert fit_quality(flat, "y", [learner.features()[0].name]) > 0.999


@pytest.mark.parametrize("depth", [1, 2])
def test_weighted_aggregates_improve_with_rounds(spark, folder, depth):
    dm, orders, tables = order_model(spark, folder)
    v = views(orders, tables)
    learner = learners.BoostedAggregates(num_features=3, max_depth=depth, min_num_samples=20).fit(dm, v["train"], "y")
    names = [f.name for f in learner.features()]
    flat = learner.transform(dm, v["test"]).join(orders.select("o_orderkey", "y"), "o_orderkey")
    one, all_of_them = fit_quality(flat, "y", names[:1]), fit_quality(flat, "y", names)
    assert one > 0.5 and all_of_them >= one - 1e-6


def test_cross_entropy_separates(spark, folder):
    dm, orders, tables = order_model(spark, folder, "binary")
    v = views(orders, tables)
    learner = learners.BoostedAggregates(num_features=2, loss=learners.CROSS_ENTROPY, linear=True, n_thresholds=9).fit(dm, v["train"], "y")
    flat = learner.transform(dm, v["test"]).join(orders.select("o_orderkey", "y"), "o_orderkey")
    model = predict.LogisticRegression().fit(flat, [f.name for f in learner.features()], ["y"])
    assert flow._quality(model, flat, ["y"]) > 0.95


def test_pipeline_ignores_test_targets(spark, folder):
    dm, orders, tables = order_model(spark, folder)
    v = views(orders, tables)

    def build():
        learner = Propositionalizer(("SUM", "COUNT", "AVG"), num_features=4, compare_units=False)
        return flow.Pipeline(dm, feature_learners=[learner], predictors=[predict.LinearRegression()])

    honest = build().fit(v["train"], ["y"]).predict(v["test"])
    spoiled = R.set_role(orders.withColumn("y", F.lit(1e6)), "y", R.TARGET)
    other = build().fit(v["train"], ["y"]).predict(View(spoiled.where("o_orderkey >= 0").join(v["test"].population.select("o_orderkey"), "o_orderkey"), tables))
    a = {r[0]: r[1] for r in honest.select("o_orderkey", "prediction__y").collect()}
    b = {r[0]: r[1] for r in other.select("o_orderkey", "prediction__y").collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 for k in a)


def test_pipeline_scores_selects_and_explains(spark, folder):
    dm, orders, tables = order_model(spark, folder)
    v = views(orders, tables)
    learner = Propositionalizer(("SUM", "COUNT", "AVG"), n_most_frequent=1, compare_units=False)
    pipe = flow.Pipeline(
        dm, feature_learners=[learner], feature_selectors=(predict.GbtRegressor({"n_estimators": 2}),),
        predictors=(predict.GbtRegressor({"n_estimators": 5}),), share_selected_features=0.5, include_categorical=True,
    )
    pipe.fit(v["train"], ["y"])
    assert pipe.score(v["test"]).first()["rsquared"] > 0.3
    assert sum(pipe.importances().values()) == pytest.approx(1.0)
    columns = pipe.column_importances()
    assert sum(columns.values()) == pytest.approx(1.0) and max(columns, key=columns.get).startswith("lineitem.")
    catalogue = pipe.catalogue(v["train"])
    assert catalogue.sort("importance").first(1).table.count() == 1
    assert catalogue.filter("l_discount").table.where("NOT sql LIKE '%l_discount%'").count() == 0
    assert catalogue.find(pipe.columns[0]).count() == 1
    assert pipe.check(v["train"])[0:1] == [] or pipe.check(v["train"])[0][2] < 0.2


def test_star_schema_with_separate_subsets(spark):
    people = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    visits = R.set_role(spark.createDataFrame([(1, 5.0), (1, 7.0), (3, 1.0)], "id long, v double"), "v", R.NUMERICAL)
    star = StarSchema(row_id=["id"], train=people.where("id < 3"), test=people.where("id = 3"))
    star.join(visits, "visits", on="id")
    learner = Propositionalizer(("SUM",)).fit(star, star.train)
    assert learner.transform(star, star.test).collect()[0]["visits__sum__v"] == 1.0


def test_relevance_filter_drops_noise(spark):
    df = spark.range(2000).select(
        "id", (F.col("id") % 50).cast("double").alias("y"), (F.col("id") % 50 + F.rand(1)).alias("good"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("noise"), F.lit(1.0).alias("flat")
    )
    assert select.select_relevant(df, ["good", "noise", "flat"], "y") == ["good"]


def test_series_builders_replay(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "user_id", "ts", "value")
    dfs = DfsSeriesBuilder(5, 3_600_000_000, 86_400_000_000 * 5, "user_id", "ts", "value", ["event_id"], allow_lagged_targets=True, holistic=False)
    fitted = dfs.fit(events)
    assert len(dfs.selected_features) <= 5 and fitted.count() == events.count()
    assert set(events.columns) <= set(fitted.columns)
    again = dfs.transform(events)
    key = lambda df: sorted(map(tuple, df.select("event_id", *[f"`{c}`" for c in dfs.selected_features]).collect()))
    assert key(again) == key(fitted)
    stat = StatSeriesBuilder(5, 10, "user_id", "ts", "value", ["event_id"], allow_lagged_targets=True)
    assert stat.fit(events).count() == events.count()
    hidden = StatSeriesBuilder(5, 10, "user_id", "ts", "value", ["event_id"])
    assert hidden._inputs(hidden._source(events)) == []


def test_population_lookup_and_preprocessors(spark):
    pop = spark.createDataFrame([(i, i % 4, float(i % 4) * 2 + 1) for i in range(80)], "id long, shop long, y double")
    pop = R.set_role(R.set_role(pop, ["id", "shop"], R.JOIN_KEY), "y", R.TARGET)
    shops = spark.createDataFrame([(i, float(i), f"kind{i % 2}", f"0{i}7") for i in range(4)], "shop long, size double, kind string, code string")
    shops = R.set_role(R.set_role(R.set_role(shops, "shop", R.JOIN_KEY), "size", R.NUMERICAL), ["kind", "code"], R.CATEGORICAL)
    dm = DataModel(Placeholder("population", ("id",))).add("shops")
    dm.population.join(dm.shops, on="shop", relationship="many_to_one")
    from relweave.operators import prep

    pipe = flow.Pipeline(
        dm, preprocessors=[prep.Mapping(), prep.Imputation()], predictors=[predict.LinearRegression()], include_categorical=True
    )
    view = View(pop, {"shops": shops})
    pipe.fit(view, ["y"])
    assert "shops__size" in pipe.columns and "shops__kind__mean_target" in pipe.columns
    assert pipe.score(view).first()["rsquared"] > 0.999


def test_second_row_of_a_lookup_key_fails(spark):
    from relweave.plans.features import fold_lookup
    from relweave.plans.model import Join

    left = spark.createDataFrame([(1, 2), (2, 3), (None, 4), (5, 5)], "k int, x int")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k int, v string")
    join = Join(Placeholder("r"), (("k", "k"),), relationship="many_to_one")
    folded, _ = fold_lookup(left, right, join)
    assert sorted((r.x, r.r__v) for r in folded.collect()) == [(2, "a"), (3, "b"), (4, None), (5, None)]
    twice, _ = fold_lookup(left, right.unionByName(right.limit(1)), join)
    with pytest.raises(Exception, match="several rows of the lookup"):
        twice.collect()


@pytest.mark.parametrize("shared", [False, True])
def test_rows_with_the_same_id_keep_their_features(spark, shared):
    rows = [(1, 1, 10, 5.0), (1, 1, 20, 7.0), (None, 1, 20, 1.0), (2, 2, 11, 2.0), (2, 2, 11, 2.0), (3, None, 5, 1.0)]
    df = spark.createDataFrame([(i if shared else n, k, t, x) for n, (i, k, t, x) in enumerate(rows)], "id int, k int, t int, x double")
    df = R.set_role(df, "x", R.NUMERICAL)
    dm = DataModel(Placeholder("population", ("id",))).add("h")
    dm.population.join(dm.h, on="k", time_stamps="t", horizon=1, memory=30)
    dm.population.join(dm.h, on="k")
    learner = Propositionalizer(("COUNT", "SUM"), compare_units=False).fit(dm, View(df, {"h": df}))
    found = learner.transform(dm, View(df, {"h": df})).collect()
    want = [(0, None), (1, 5.0), (1, 5.0), (0, None), (0, None), (0, None)]
    assert sorted((r["h__count"], r["h__sum__x"] or 0) for r in found) == sorted((n, s or 0) for n, s in want)


def test_exported_mappings_are_resolved_once(spark, folder, tmp_path):
    from relweave.operators import prep
    from relweave.sources.pipeline_scripts import pipeline_scripts

    rows = spark.createDataFrame([(i, "ab"[i % 2], float(i % 2) + i / 100) for i in range(40)], "id long, c string, y double")
    rows = R.set_role(R.set_role(rows, "c", R.CATEGORICAL), "y", R.TARGET)
    pipe = flow.Pipeline(DataModel(Placeholder("population", ("id",))), preprocessors=[prep.Mapping(min_freq=2)], feature_learners=[], predictors=[predict.LinearRegression()])
    statements, stored = pipeline_scripts(pipe.fit(View(rows, {}), ["y"]), View(rows, {}), f"{tmp_path}/it's")
    (made,) = [sql for name, sql in statements if name in stored]
    assert " USING parquet " in made and not any("parquet.`" in sql for _, sql in statements)
    for name, df in stored.items():
        df.write.parquet(f"{tmp_path}/it's/{name}")
    rows.createOrReplaceTempView("population")
    for _, sql in statements:
        spark.sql(sql)
    told = {r["id"]: r["prediction__y"] for r in spark.table("PREDICTIONS").collect()}
    assert told == pytest.approx({r["id"]: r["prediction__y"] for r in pipe.predict(View(rows, {})).collect()})


def test_sweep_keeps_its_rows(spark, folder):
    dm, orders, tables = order_model(spark, folder, "binary")
    v, seen = views(orders, tables), []

    def accuracy(pipe, view):
        seen.append((v["train"].population.is_cached, view.population.is_cached))
        return len(pipe.columns)

    build = lambda aggregation: flow.Pipeline(dm, feature_learners=[Propositionalizer(aggregation, compare_units=False)])
    found = flow.sweep(build, {"aggregation": [("COUNT",), ("COUNT", "SUM")]}, v["train"], v["validation"], ["y"], accuracy)
    assert seen == [(True, True)] * 2 and found["params"] == {"aggregation": ("COUNT", "SUM")}
    assert not v["train"].population.is_cached and not v["validation"].population.is_cached
