"""Everything that is learnt. No SQL twin; tests check recovery."""

from pyspark.sql import functions as F

from ..operators import metrics, prep
from ..operators import roles as R
from ..plans import flow, learners, predict, select
from ..plans.features import Propositionalizer
from ..plans.model import DataModel, Placeholder, View
from ..sources.tables import load_dataset
from .preparation import random_split
from .registry import query, table


def order_model(spark, d, target=None, relationship=None):
    """Orders with a target built from their lines: the quantity of heavily discounted ones."""
    data = load_dataset(spark, d, ["orders", "lineitem"])
    items = data["lineitem"].select("l_orderkey", "l_quantity", "l_discount", "l_returnflag")
    planted = items.groupBy("l_orderkey").agg(F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_quantity"))).alias("planted"))
    orders = data["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    orders = orders.join(planted, orders.o_orderkey == planted.l_orderkey, "left").drop("l_orderkey")
    y = F.coalesce("planted", F.lit(0.0))
    y = (y > 30).cast("double") if target == "binary" else y
    orders = R.set_role(orders.withColumn("y", y).drop("planted"), "y", R.TARGET)
    dm = DataModel(Placeholder("population", ("o_orderkey",))).add("lineitem")
    dm.population.join(dm.lineitem, on=("o_orderkey", "l_orderkey"), relationship=relationship or "many_to_many")
    return dm, orders, {"lineitem": items}


def views(orders, tables):
    split = random_split()
    return {s: View(orders.where(split == s), tables) for s in ("train", "validation", "test")} | {"full": View(orders, tables)}


PLANTED = """SELECT o_orderkey, {value} AS feature FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey"""
PLANTED_SUM = "coalesce(sum(CASE WHEN l_discount > 0.05 THEN l_quantity END), 0)"


@query("f4_condition_search", PLANTED.format(value=PLANTED_SUM))
def _(spark, d):
    # the search has to find the planted aggregate and condition among all candidates
    dm, orders, tables = order_model(spark, d)
    v = views(orders, tables)
    learner = learners.ConditionSearch(num_features=3, aggregation=("SUM", "COUNT"), n_thresholds=9).fit(dm, v["train"], "y")
    return learner.transform(dm, v["full"]).select("o_orderkey", F.col(learner.features()[0].name).alias("feature"))


@query(
    "f5_weighted_aggregates",
    PLANTED.format(
        value="round(2 * count(CASE WHEN l_discount > 0.05 THEN 1 END) + 0.5::DOUBLE * count(CASE WHEN l_discount <= 0.05 THEN 1 END), 3) + 0.0::DOUBLE"
    ),
)
def _(spark, d):
    # two planted weights: 2 for heavily discounted lines, 0.5 for the others
    dm, orders, tables = order_model(spark, d)
    heavy = F.count(F.when(F.col("l_discount") > 0.05, 1))
    planted = tables["lineitem"].groupBy("l_orderkey").agg((2 * heavy + 0.5 * (F.count(F.lit(1)) - heavy)).alias("w"))
    rows = orders.drop("y").join(planted, orders.o_orderkey == planted.l_orderkey, "left").drop("l_orderkey")
    rows = R.set_role(rows.withColumn("y", F.coalesce("w", F.lit(0.0))).drop("w"), "y", R.TARGET)
    v = views(rows, tables)
    learner = learners.BoostedAggregates(num_features=1, min_num_samples=100, n_thresholds=9).fit(dm, v["train"], "y")
    return learner.transform(dm, v["full"]).select("o_orderkey", (F.round(learner.features()[0].name, 3) + 0.0).alias("feature"))


@query("f5_boosted_trees")
def _(spark, d):
    dm, orders, tables = order_model(spark, d)
    v = views(orders, tables)
    learner = learners.BoostedAggregates(num_features=2, max_depth=2, min_num_samples=20).fit(dm, v["train"], "y")
    return learner.transform(dm, v["full"])


@query("f6_linear_aggregates", PLANTED.format(value=f"round({PLANTED_SUM}, 3) + 0.0::DOUBLE"))
def _(spark, d):
    # the weights of the learnt linear function must be those of the planted sum
    dm, orders, tables = order_model(spark, d)
    v = views(orders, tables)
    learner = learners.BoostedAggregates(num_features=1, linear=True, n_thresholds=9).fit(dm, v["train"], "y")
    return learner.transform(dm, v["full"]).select("o_orderkey", (F.round(learner.features()[0].name, 3) + 0.0).alias("feature"))


def planted_customers(spark, d):
    """Customers with the number of all their line items, two tables away, as target."""
    data = load_dataset(spark, d, ["customer", "orders", "lineitem"])
    items, orders = data["lineitem"].select("l_orderkey", "l_quantity"), data["orders"].select("o_orderkey", "o_custkey")
    total = items.join(orders, items.l_orderkey == orders.o_orderkey).groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("t"))
    rows = data["customer"].select("c_custkey").join(total, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("t", F.lit(0.0)).alias("y"))
    dm = DataModel(Placeholder("population", ("c_custkey",))).add("orders", "lineitem")
    dm.population.join(dm.orders, on=("c_custkey", "o_custkey"))
    dm.orders.join(dm.lineitem, on=("o_orderkey", "l_orderkey"))
    return dm, View(R.set_role(rows, "y", R.TARGET), {"orders": orders, "lineitem": items})


SNOWFLAKE = """SELECT c_custkey, CAST(count(l_orderkey) AS DOUBLE) AS feature FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY c_custkey"""


@query("f4_snowflake", SNOWFLAKE)
def _(spark, d):
    dm, view = planted_customers(spark, d)
    learner = learners.ConditionSearch(num_features=1, aggregation=("SUM", "COUNT"), n_thresholds=3).fit(dm, view, "y")
    return learner.transform(dm, view).select("c_custkey", F.col(learner.features()[0].name).cast("double").alias("feature"))


@query("f5_snowflake", SNOWFLAKE)
def _(spark, d):
    # the weights have to be 1 on the inner count and 0 elsewhere
    dm, view = planted_customers(spark, d)
    learner = learners.BoostedAggregates(num_features=1, linear=True, n_thresholds=3).fit(dm, view, "y")
    return learner.transform(dm, view).select("c_custkey", (F.round(learner.features()[0].name, 3) + 0.0).alias("feature"))


@query("j14_learned_mix", PLANTED.format(value=f"{PLANTED_SUM} AS learnt, CAST(count(l_orderkey) AS BIGINT) AS plain, o_totalprice").replace(" AS feature", "").replace("GROUP BY o_orderkey", "GROUP BY o_orderkey, o_totalprice"))
def _(spark, d):
    # one relation is learnt, the same table once more is only enumerated
    dm, orders, tables = order_model(spark, d)
    dm.add(plain=Placeholder("plain"))
    dm.population.join(dm.plain, on=("o_orderkey", "l_orderkey"), relationship="propositionalization")
    tables = {**tables, "plain": tables["lineitem"]}
    v = views(orders, tables)
    learner = learners.ConditionSearch(num_features=1, aggregation=("SUM", "COUNT"), n_thresholds=9).fit(dm, v["train"], "y")
    found = learner.transform(dm, v["full"]).join(orders.select("o_orderkey", "o_totalprice"), "o_orderkey")
    return found.select("o_orderkey", F.col(learner.features()[0].name).alias("learnt"), F.col("plain__count").cast("long").alias("plain"), "o_totalprice")


@query("f7_cross_entropy")
def _(spark, d):
    dm, orders, tables = order_model(spark, d, "binary")
    v = views(orders, tables)
    learner = learners.BoostedAggregates(num_features=3, loss=learners.CROSS_ENTROPY).fit(dm, v["train"], "y")
    return learner.transform(dm, v["full"])


def flat_orders(spark, d, target=None):
    dm, orders, tables = order_model(spark, d, target)
    view = View(orders, tables)
    learner = Propositionalizer(("COUNT", "AVG", "SUM", "MAX"), n_most_frequent=2, compare_units=False).fit(dm, view)
    names = [f.name for f in learner.features()]
    return learner.transform(dm, view).join(orders.select("o_orderkey", "y"), "o_orderkey"), names, learner, view


@query("f12_relevance_filter")
def _(spark, d):
    flat, names, _, _ = flat_orders(spark, d)
    kept = select.select_relevant(flat, names, "y")
    return flat.select("o_orderkey", *kept)


@query("f13_feature_selection")
def _(spark, d):
    flat, names, _, _ = flat_orders(spark, d)
    kept = select.select_features(predict.GbtRegressor({"n_estimators": 3}), flat, names, ["y"], 0.2)
    return flat.select("o_orderkey", *kept)


@query("f14_column_selection")
def _(spark, d):
    flat, names, learner, view = flat_orders(spark, d)
    fitted = predict.GbtRegressor({"n_estimators": 3}).fit(flat, names, ["y"])
    dm = DataModel(Placeholder("population", ("o_orderkey",)))
    return select.select_columns(dm, view.peripheral, learner.features(), fitted.importances(), 0.35)["lineitem"]


def document_rows(spark, d):
    """Numeric features of all documents, from the whole text; labels where there are any."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    words = prep.words("text")
    return docs.select(
        "doc_id",
        F.col("quality").cast("double").alias("quality"),
        F.col("toxic").cast("double").alias("toxic"),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(words).cast("double").alias("n_words"),
        (F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))).alias("variety"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"),
    )


DOC_FEATURES = ["n_chars", "n_words", "variety", "lines"]


@query("e1_gbt_regressor")
def _(spark, d):
    flat, names, _, _ = flat_orders(spark, d)
    return predict.GbtRegressor({"n_estimators": 5}).fit(flat, names, ["y"]).predict(flat).select("o_orderkey", "prediction__y")


@query("e2_gbt_classifier")
def _(spark, d):
    rows = document_rows(spark, d)
    model = predict.GbtClassifier({"n_estimators": 5, "max_depth": 2}).fit(rows, DOC_FEATURES, ["quality"])
    return model.predict(rows).select("doc_id", "prediction__quality")


@query("e3_logistic_regression")
def _(spark, d):
    rows = document_rows(spark, d)
    model = predict.LogisticRegression({"reg_lambda": 0.01}).fit(rows, DOC_FEATURES, ["quality", "toxic"])
    return model.predict(rows).select("doc_id", "prediction__quality", "prediction__toxic")


def order_flow(spark, d, target=None, **extra):
    dm, orders, tables = order_model(spark, d, target)
    learner = Propositionalizer(("COUNT", "AVG", "SUM", "MAX"), n_most_frequent=1, compare_units=False)
    predictor = (predict.GbtClassifier if target == "binary" else predict.GbtRegressor)({"n_estimators": 3})
    pipe = flow.Pipeline(dm, feature_learners=[learner], predictors=[predictor], **extra)
    return pipe, views(orders, tables)


@query("e4_tuning")
def _(spark, d):
    pipe, v = order_flow(spark, d)
    pipe.fit(v["train"], ["y"])
    found = flow.tune(pipe, v["train"], v["validation"], {"max_depth": [2, 3], "learning_rate": [0.1, 0.3]})
    rows = [(p["max_depth"], p["learning_rate"], s) for s, p in found["tried"]]
    return spark.createDataFrame(rows, "max_depth int, learning_rate double, score double")


@query("e5_sweep")
def _(spark, d):
    dm, orders, tables = order_model(spark, d, "binary")
    v = views(orders, tables)

    def build(num_features, aggregation):
        learner = Propositionalizer(aggregation, num_features=num_features, compare_units=False)
        return flow.Pipeline(dm, feature_learners=[learner], predictors=[predict.LogisticRegression()])

    grid = {"num_features": [2, 5], "aggregation": [("COUNT",), ("COUNT", "SUM", "AVG")]}
    found = flow.sweep(build, grid, v["train"], v["validation"], ["y"], lambda p, view: p.score(view).first()["accuracy"])
    rows = [(p["num_features"], ",".join(p["aggregation"]), s) for s, p in found["tried"]]
    return spark.createDataFrame(rows, "num_features int, aggregation string, accuracy double")


@query("e6_predict")
def _(spark, d):
    pipe, v = order_flow(spark, d)
    return pipe.fit(v["train"], ["y"]).predict(v["test"]).select("o_orderkey", "prediction__y")


@query("e6_score")
def _(spark, d):
    pipe, v = order_flow(spark, d, "binary")
    return pipe.fit(v["train"], ["y"]).score(v["test"])


@query("e7_one_vs_rest")
def _(spark, d):
    vectors = table(spark, d, "embeddings")
    labels = [str(r[0]) for r in vectors.select("label").distinct().orderBy("label").collect()]
    width = vectors.select(F.max(F.size("embedding"))).first()[0]
    cols = {f"e{i}": F.col("embedding")[i].cast("double") for i in range(width)}
    rows = R.make_target_columns(vectors.select("vec_id", "label", F.col("label").cast("string").alias("actual"), *[c.alias(n) for n, c in cols.items()]), "label")
    targets = R.roles(rows)[R.TARGET]
    scored = predict.LogisticRegression({"reg_lambda": 0.1}).fit(rows, list(cols), targets).predict(rows)
    return metrics.argmax_accuracy(scored, "actual", [f"prediction__label={v}" for v in labels], labels)


@query("e10_feature_importances")
def _(spark, d):
    pipe, v = order_flow(spark, d)
    found = pipe.fit(v["train"], ["y"]).importances()
    return spark.createDataFrame(sorted(found.items()), "feature string, importance double")


@query("e11_column_importances")
def _(spark, d):
    pipe, v = order_flow(spark, d)
    found = pipe.fit(v["train"], ["y"]).column_importances()
    return spark.createDataFrame(sorted(found.items()), "source string, importance double")


@query("e12_feature_catalogue")
def _(spark, d):
    pipe, v = order_flow(spark, d)
    pipe.fit(v["train"], ["y"])
    return pipe.catalogue(v["train"]).filter("l_quantity").sort("correlation").first(5).table


