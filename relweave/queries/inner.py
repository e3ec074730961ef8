"""F4-F6, F8 with conditions planted two joins away from the population: they have to be found in the inner table."""

from pyspark.sql import functions as F

from ..functions.timecols import days
from ..operators import roles as R
from ..operators import splits
from ..plans import flow, learners, predict
from ..plans.model import DataModel, Placeholder, View
from ..sources.tables import load_dataset
from .registry import query, rounded


def planted_customers(spark, d, value):
    """Customers whose target is a sum over the lines of their orders; `value` is over one line."""
    data = load_dataset(spark, d, ["customer", "orders", "lineitem"])
    items = R.set_role(data["lineitem"].select("l_orderkey", "l_quantity", "l_linenumber", "l_returnflag"), "l_linenumber", R.NUMERICAL)
    orders = data["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    each = items.select("l_orderkey", F.expr(value).cast("double").alias("v"))
    total = each.join(orders, each.l_orderkey == orders.o_orderkey).groupBy("o_custkey").agg(F.sum("v").alias("t"))
    rows = data["customer"].select("c_custkey").join(total, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("t", F.lit(0.0)).alias("y"))
    dm = DataModel(Placeholder("population", ("c_custkey",))).add("orders", "lineitem")
    dm.population.join(dm.orders, on=("c_custkey", "o_custkey"))
    dm.orders.join(dm.lineitem, on=("o_orderkey", "l_orderkey"))
    return dm, View(R.set_role(rows, "y", R.TARGET), {"orders": orders, "lineitem": items})


def two_joins(value, name="feature"):
    return f"""SELECT c_custkey, CAST(coalesce(sum({value}), 0) AS DOUBLE) AS {name} FROM customer LEFT JOIN orders ON o_custkey = c_custkey
        LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY c_custkey"""


ACCEPTED = "CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END"
LATE = "CASE WHEN l_linenumber > 4 THEN 1 ELSE 0 END"
RETURNED = "CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END"


@query("f4_inner_condition", two_joins(ACCEPTED))
def _(spark, d):
    # the number of accepted lines, in any order of the customer
    dm, view = planted_customers(spark, d, ACCEPTED)
    learner = learners.ConditionSearch(num_features=2, aggregation=("SUM", "COUNT"), n_thresholds=3, n_most_frequent=7).fit(dm, view, "y")
    return learner.transform(dm, view).select("c_custkey", F.col(learner.features()[0].name).cast("double").alias("feature"))


@query("f5_inner_condition", two_joins(f"CASE WHEN l_orderkey IS NOT NULL THEN 2 * {LATE} + 1 END"))
def _(spark, d):
    # a weight of one for every line and of two more beyond a line number
    dm, view = planted_customers(spark, d, f"2 * ({LATE}) + 1")
    learner = learners.BoostedAggregates(num_features=1, n_thresholds=7, n_most_frequent=3).fit(dm, view, "y")
    return rounded(learner.transform(dm, view).select("c_custkey", (F.round(learner.features()[0].name, 3) + 0.0).alias("feature")))


@query("f6_inner_condition", two_joins(RETURNED))
def _(spark, d):
    # the weight of the quantity of returned lines, two tables away
    dm, view = planted_customers(spark, d, RETURNED)
    learner = learners.BoostedAggregates(num_features=1, linear=True, n_thresholds=3).fit(dm, view, "y")
    return rounded(learner.transform(dm, view).select("c_custkey", (F.round(learner.features()[0].name, 3) + 0.0).alias("feature")))


@query("f8_inner_learnt", two_joins(ACCEPTED, "prediction"))
def _(spark, d):
    # learnt on a random part of the customers, told for all: a line through the learnt feature gives the target back
    dm, view = planted_customers(spark, d, ACCEPTED)
    learner = learners.BoostedAggregates(num_features=1, n_thresholds=3, n_most_frequent=7)
    pipe = flow.Pipeline(dm, feature_learners=[learner], predictors=[predict.LinearRegression()])
    part = splits.split_random(["c_custkey"], train=0.7, test=0.3)
    told = pipe.fit(View(view.population.where(part == "train"), view.peripheral), ["y"]).predict(view)
    return told.select("c_custkey", (F.round("prediction__y", 3) + 0.0).alias("prediction"))


def dated(value):
    """Per order: the lines with `value` of the same customer's orders in the 200 days up to the day before."""
    return f"""SELECT a.o_orderkey, CAST(coalesce(sum({value}), 0) AS DOUBLE) AS feature FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey
        AND b.o_orderdate <= a.o_orderdate - INTERVAL 1 DAY AND b.o_orderdate > a.o_orderdate - INTERVAL 201 DAY LEFT JOIN lineitem ON l_orderkey = b.o_orderkey GROUP BY a.o_orderkey"""


@query("f4_inner_dated", dated(ACCEPTED))
def _(spark, d):
    # the outer join has a horizon and a memory, so the residuals go down through the same window
    data = load_dataset(spark, d, ["orders", "lineitem"])
    items, orders = data["lineitem"].select("l_orderkey", "l_linenumber", "l_returnflag"), data["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    mail = items.groupBy("l_orderkey").agg(F.sum(F.expr(ACCEPTED)).alias("m"))
    past = orders.join(mail, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("t"), "m")
    gap = F.unix_micros(F.col("o_orderdate").cast("timestamp")) - F.unix_micros(F.col("t").cast("timestamp"))
    near = (F.col("o_custkey") == F.col("k")) & (gap >= days(1)) & (gap < days(201))
    rows = orders.join(past, near, "left").groupBy("o_orderkey", "o_custkey", "o_orderdate").agg(F.coalesce(F.sum("m"), F.lit(0)).cast("double").alias("y"))
    rows = R.set_role(rows.select(*orders.columns, "y"), "y", R.TARGET)
    dm = DataModel(Placeholder("population", ("o_orderkey",))).add("orders", "lineitem")
    dm.population.join(dm.orders, on="o_custkey", time_stamps="o_orderdate", horizon=days(1), memory=days(200))
    dm.orders.join(dm.lineitem, on=("o_orderkey", "l_orderkey"))
    view = View(rows, {"orders": orders, "lineitem": items})
    learner = learners.ConditionSearch(num_features=2, aggregation=("SUM", "COUNT"), n_thresholds=2, n_most_frequent=7).fit(dm, view, "y")
    return learner.transform(dm, view).select("o_orderkey", F.col(learner.features()[0].name).cast("double").alias("feature"))
