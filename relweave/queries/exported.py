"""S7 for whole fitted pipelines: the saved scripts alone have to tell what the pipeline predicts."""

from pyspark.sql import functions as F

from ..functions.timecols import days
from ..operators import prep
from ..operators import roles as R
from ..plans import flow, learners, predict
from ..plans.features import Propositionalizer
from ..plans.model import DataModel, Placeholder, View
from ..sources.pipeline_scripts import save_pipeline
from ..sources.scripts import own_views, run_sql_folder
from ..sources.tables import load_dataset
from . import inner, planted
from .preparation import random_split
from .registry import query, rounded, scratch


def told_by_scripts(spark, pipe, view, fitted_on):
    """PREDICTIONS of `view` after the scripts of the pipeline ran in a session that only has the tables."""
    folder = scratch(spark, "pipeline")
    save_pipeline(pipe, fitted_on, folder)
    with own_views(spark):
        view.population.createOrReplaceTempView("population")
        for name, df in view.peripheral.items():
            df.createOrReplaceTempView(name)
        run_sql_folder(spark, folder)
        return spark.table("PREDICTIONS")


@query("s7_pipeline_boosted", f"SELECT o_orderkey, CAST({planted.STEP} AS DOUBLE) AS prediction FROM ({planted.TOPS})")
def _(spark, d):
    pipe, v = planted.step_flow(spark, d, planted.STEP, planted.one_tree(predict.GbtRegressor))
    told = told_by_scripts(spark, pipe.fit(v["train"], ["y"]), v["full"], v["train"])
    return rounded(told.select("o_orderkey", F.col("prediction__y").alias("prediction")))


@query("s7_pipeline_logistic", f"SELECT o_orderkey, CAST({planted.STEP} > 5 AS INTEGER) AS label FROM ({planted.TOPS})")
def _(spark, d):
    pipe, v = planted.step_flow(spark, d, f"{planted.STEP} > 5", predict.LogisticRegression())
    told = told_by_scripts(spark, pipe.fit(v["train"], ["y"]), v["full"], v["train"])
    return told.select("o_orderkey", (F.col("prediction__y") > 0.5).cast("int").alias("label"))


@query("s7_pipeline_learnt", inner.two_joins(inner.ACCEPTED, "prediction"))
def _(spark, d):
    # the condition was learnt two joins away; the scripts hold it, its weight and the line through the feature
    dm, view = inner.planted_customers(spark, d, inner.ACCEPTED)
    learner = learners.BoostedAggregates(num_features=1, n_thresholds=3, n_most_frequent=7)
    pipe = flow.Pipeline(dm, feature_learners=[learner], predictors=[predict.LinearRegression()]).fit(view, ["y"])
    return told_by_scripts(spark, pipe, view, view).select("c_custkey", (F.round("prediction__y", 3) + 0.0).alias("prediction"))


def prepared_pipeline(spark, d, predictor, binary=False):
    """Orders with a customer looked up, earlier orders and lines below, and every preprocessor."""
    data = load_dataset(spark, d, ["orders", "customer", "lineitem"])
    orders = R.set_subroles(R.set_role(data["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice"), "o_orderpriority", R.CATEGORICAL), "o_orderpriority", "code")
    customers = data["customer"].select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 4 > 0, F.col("c_acctbal")).alias("c_acctbal"), "c_mktsegment")
    customers = R.set_role(R.set_role(customers, "c_acctbal", R.NUMERICAL), "c_mktsegment", R.CATEGORICAL)
    items = data["lineitem"].select("l_orderkey", "l_quantity", "l_returnflag")
    y = F.col("o_totalprice") * (1 + F.length("o_orderpriority")) + F.col("o_custkey")
    rows = R.set_role(orders.withColumn("y", (y > 2_000_000).cast("double") if binary else y), "y", R.TARGET)
    dm = DataModel(Placeholder("population", ("o_orderkey",))).add("customer", "orders", "lineitem")
    dm.population.join(dm.customer, on=("o_custkey", "c_custkey"), relationship="many_to_one")
    dm.population.join(dm.orders, on="o_custkey", time_stamps="o_orderdate", horizon=days(1), memory=days(300))
    dm.population.join(dm.lineitem, on=("o_orderkey", "l_orderkey"))
    found = [Propositionalizer(("COUNT", "AVG"), n_most_frequent=1, compare_units=False), learners.ConditionSearch(num_features=1, aggregation=("SUM", "COUNT"), n_thresholds=2, n_most_frequent=1)]
    steps = [prep.Seasonal(("month", "weekday")), prep.Substring(0, 1, subrole="code"), prep.Mapping(min_freq=5), prep.Imputation()]
    pipe = flow.Pipeline(dm, preprocessors=steps, feature_learners=found, predictors=[predictor], include_categorical=True)
    tables, split = {"customer": customers, "orders": orders, "lineitem": items}, random_split()
    return pipe.fit(View(rows.where(split == "train"), tables), ["y"]), View(rows.where(split == "train"), tables), View(rows, tables)


def differences(spark, d, predictor, binary):
    pipe, train, view = prepared_pipeline(spark, d, predictor, binary)
    told = told_by_scripts(spark, pipe, view, train).select("o_orderkey", F.col("prediction__y").alias("told"))
    both = pipe.predict(view).select("o_orderkey", F.col("prediction__y").alias("p")).join(told, "o_orderkey", "left")
    off = F.coalesce(F.abs(F.col("p") - F.col("told")) > 1e-9 * (1 + F.abs(F.col("p"))), F.lit(True))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(off).alias("wrong"))


@query("s7_pipeline_equals_trees", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS wrong FROM orders")
def _(spark, d):
    # a boosted model behind all preprocessors and two learners: every row's prediction is compared
    return differences(spark, d, predict.GbtRegressor({"n_estimators": 5, "max_depth": 4}), False)


@query("s7_pipeline_equals_logistic", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS wrong FROM orders")
def _(spark, d):
    return differences(spark, d, predict.LogisticRegression({"reg_lambda": 0.01}), True)
