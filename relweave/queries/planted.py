"""F7, F12-F14, E1-E7, E10-E12, G6 on targets planted in the tables, so that SQL knows what has to be learnt."""

from pyspark.sql import functions as F

from ..operators import graph, metrics
from ..operators import roles as R
from ..plans import flow, learners, predict, select
from ..plans.features import Propositionalizer
from ..plans.model import DataModel, Placeholder, View
from .preparation import SPLIT, random_split
from .registry import query, rounded, rounded_sql, table

# Highest line number and largest discount of every order; the targets are steps of them.
TOPS = """SELECT o_orderkey, max(o_totalprice) AS price, CAST(coalesce(max(l_linenumber), 0) AS DOUBLE) AS line,
    coalesce(max(l_discount), 0) AS discount FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey"""
LINE, QUANTITY, DISCOUNT = (f"lineitem__max__l_{c}" for c in ("linenumber", "quantity", "discount"))


def planted_orders(spark, d, target):
    """Orders whose target `y` is the SQL expression `target` of `price`, `line` and `discount`."""
    roles = {"l_orderkey": R.JOIN_KEY, "l_linenumber": R.NUMERICAL, "l_quantity": R.NUMERICAL, "l_discount": R.NUMERICAL}
    items = table(spark, d, "lineitem").select(*roles)
    for column, role in roles.items():
        items = R.set_role(items, column, role)
    top = items.groupBy("l_orderkey").agg(F.max("l_linenumber").cast("double").alias("line"), F.max("l_discount").alias("discount"))
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    rows = rows.join(top, rows.o_orderkey == top.l_orderkey, "left").fillna(0.0, ["line", "discount"])
    rows = rows.select("o_orderkey", F.expr(target).cast("double").alias("y"))
    dm = DataModel(Placeholder("population", ("o_orderkey",))).add("lineitem")
    dm.population.join(dm.lineitem, on=("o_orderkey", "l_orderkey"))
    split, tables = random_split(), {"lineitem": items}
    rows = R.set_role(rows, "y", R.TARGET)
    return dm, {s: View(rows.where(split == s), tables) for s in ("train", "validation", "test")} | {"full": View(rows, tables)}


def step_flow(spark, d, target, predictor, aggregation=("MAX",)):
    dm, v = planted_orders(spark, d, target)
    return flow.Pipeline(dm, feature_learners=[Propositionalizer(aggregation, compare_units=False)], predictors=[predictor]), v


def one_tree(kind, depth=1):
    """A single tree: it gives a step of one feature back exactly."""
    return kind({"n_estimators": 1, "max_depth": depth, "learning_rate": 1.0})


STEP = "CASE WHEN line > 3 THEN 10 ELSE 2 END"
CLASS = "CASE WHEN discount > 0.05 THEN 1 ELSE 0 END"


@query("e1_planted_step", f"SELECT o_orderkey, CAST({STEP} AS DOUBLE) AS prediction FROM ({TOPS})")
def _(spark, d):
    # learnt from the training rows, told for all
    pipe, v = step_flow(spark, d, STEP, one_tree(predict.GbtRegressor))
    predicted = pipe.fit(v["train"], ["y"]).predict(v["full"])
    return rounded(predicted.select("o_orderkey", F.col("prediction__y").alias("prediction")))


@query("e2_planted_classes", rounded_sql(f"SELECT o_orderkey, 1 / (1 + exp(-2 * (2 * {CLASS} - 1.0::DOUBLE))) AS probability FROM ({TOPS})", "o_orderkey", "probability"))
def _(spark, d):
    # the only tree has margins of 1 and -1, which count twice in the probability
    pipe, v = step_flow(spark, d, CLASS, one_tree(predict.GbtClassifier))
    predicted = pipe.fit(v["train"], ["y"]).predict(v["full"])
    return rounded(predicted.select("o_orderkey", F.col("prediction__y").alias("probability")))


@query("e3_planted_classes", f"SELECT o_orderkey, CAST({STEP} > 5 AS INTEGER) AS label FROM ({TOPS})")
def _(spark, d):
    # classes that a linear function of one feature keeps apart
    pipe, v = step_flow(spark, d, f"{STEP} > 5", predict.LogisticRegression())
    predicted = pipe.fit(v["train"], ["y"]).predict(v["full"])
    return predicted.select("o_orderkey", (F.col("prediction__y") > 0.5).cast("int").alias("label"))


@query("e4_planted_depth", "SELECT 2 AS max_depth, 1.0::DOUBLE AS score")
def _(spark, d):
    # three levels need two splits, one after the other
    pipe, v = step_flow(spark, d, "CAST(line > 2 AS INT) + CAST(line > 5 AS INT)", one_tree(predict.GbtRegressor))
    pipe.fit(v["train"], ["y"])
    found = flow.tune(pipe, v["train"], v["validation"], {"max_depth": [1, 2]})
    return spark.createDataFrame([(found["params"]["max_depth"], round(found["score"], 6))], "max_depth int, score double")


@query("e5_planted_aggregate", "SELECT 'MAX' AS aggregation, 1.0::DOUBLE AS accuracy")
def _(spark, d):
    # of three learners only one can see the planted step
    dm, v = planted_orders(spark, d, CLASS)

    def build(aggregation):
        return flow.Pipeline(dm, feature_learners=[Propositionalizer((aggregation,), compare_units=False)], predictors=[one_tree(predict.GbtClassifier)])

    found = flow.sweep(build, {"aggregation": ["COUNT", "MAX", "MIN"]}, v["train"], v["validation"], ["y"], lambda p, view: p.score(view).first()["accuracy"])
    return spark.createDataFrame([(found["params"]["aggregation"], found["score"])], "aggregation string, accuracy double")


@query("e6_planted_test_rows", f"SELECT o_orderkey, CAST({STEP} AS DOUBLE) AS prediction FROM (SELECT *, {SPLIT} AS split FROM ({TOPS})) WHERE split = 'test'")
def _(spark, d):
    pipe, v = step_flow(spark, d, STEP, one_tree(predict.GbtRegressor))
    return rounded(pipe.fit(v["train"], ["y"]).predict(v["test"]).select("o_orderkey", F.col("prediction__y").alias("prediction")))


@query(
    "e6_planted_score",
    rounded_sql(
        f"""SELECT avg(CAST((p > 0.5) = (y = 1) AS INTEGER)) AS accuracy, -avg(y * ln(p) + (1 - y) * ln(1 - p)) AS cross_entropy, 1.0::DOUBLE AS auc
        FROM (SELECT y, 1 / (1 + exp(-2 * (2 * y - 1.0::DOUBLE))) AS p FROM (SELECT {CLASS} AS y, {SPLIT} AS split FROM ({TOPS})) WHERE split = 'test')""",
        [],
        "accuracy cross_entropy auc",
    ),
)
def _(spark, d):
    pipe, v = step_flow(spark, d, CLASS, one_tree(predict.GbtClassifier))
    return rounded(pipe.fit(v["train"], ["y"]).score(v["test"]))


@query("e7_planted_classes", "SELECT o_orderkey, o_orderpriority AS label FROM orders")
def _(spark, d):
    # one classifier per priority, fed with the priorities as 0/1 inputs
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderpriority").alias("class"))
    rows, inputs = predict.IncludeCategorical(["o_orderpriority"]).fit(rows).transform(R.make_target_columns(rows, "class"))
    targets = R.roles(rows)[R.TARGET]
    scored = predict.LogisticRegression({"reg_lambda": 0.01}).fit(rows.where(random_split() == "train"), inputs, targets).predict(rows)
    label = metrics.argmax_label([f"`prediction__{t}`" for t in targets], [t.removeprefix("class=") for t in targets])
    return scored.select("o_orderkey", label.alias("label"))


@query("f7_planted_classes", "SELECT o_orderkey, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS label FROM orders")
def _(spark, d):
    # the learnt weight tells the urgent ones, the classifier puts its bound between them and the others
    both = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    details = R.set_role(R.set_role(both, "o_orderkey", R.JOIN_KEY), "o_orderpriority", R.CATEGORICAL)
    rows = R.set_role(both.select("o_orderkey", (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("y")), "y", R.TARGET)
    dm = DataModel(Placeholder("population", ("o_orderkey",))).add("details")
    dm.population.join(dm.details, on="o_orderkey")
    learner = learners.BoostedAggregates(num_features=1, loss=learners.CROSS_ENTROPY)
    pipe = flow.Pipeline(dm, feature_learners=[learner], predictors=[predict.LogisticRegression()])
    predicted = pipe.fit(View(rows.where(random_split() == "train"), {"details": details}), ["y"]).predict(View(rows, {"details": details}))
    return predicted.select("o_orderkey", (F.col("prediction__y") > 0.5).cast("int").alias("label"))


MEASURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
# Two-sided normal bounds of 0.05 * i / (4 * (1 + 1/2 + 1/3 + 1/4)); with thousands of rows the F test has the same.
BOUNDS = [2.7478, 2.5121, 2.3656, 2.2571]


@query(
    "f12_planted_relevance",
    f"""WITH r AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, corr({c}, l_extendedprice * l_quantity * (1 - l_discount)) AS r, count(*) AS n FROM lineitem" for c in MEASURES)}),
    t AS (SELECT feature, sqrt(r * r * (n - 2) / (1 - r * r)) AS t FROM r), o AS (SELECT *, row_number() OVER (ORDER BY t DESC) AS i FROM t)
    SELECT feature FROM o WHERE i <= (SELECT max(i) FROM o WHERE t >= CASE i {' '.join(f'WHEN {i + 1} THEN {b}' for i, b in enumerate(BOUNDS))} END)""",
)
def _(spark, d):
    items = table(spark, d, "lineitem").select(*[F.col(c).cast("double").alias(c) for c in MEASURES], F.expr("l_extendedprice * l_quantity * (1 - l_discount)").alias("paid"))
    return spark.createDataFrame([(c,) for c in select.select_relevant(items, MEASURES, "paid")], "feature string")


def flat_steps(spark, d):
    dm, v = planted_orders(spark, d, STEP)
    learner = Propositionalizer(("MAX",), compare_units=False).fit(dm, v["full"])
    flat = learner.transform(dm, v["full"]).join(v["full"].population.select("o_orderkey", "y"), "o_orderkey")
    return flat, [f.name for f in learner.features()], learner, v["full"]


@query("f13_planted_feature", "SELECT o_orderkey, CAST(max(l_linenumber) AS DOUBLE) AS feature FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def _(spark, d):
    flat, names, _, _ = flat_steps(spark, d)
    (kept,) = select.select_features(one_tree(predict.GbtRegressor), flat, names, ["y"], 0.3)
    return flat.select("o_orderkey", F.col(kept).cast("double").alias("feature"))


@query("f14_planted_column", "SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem")
def _(spark, d):
    flat, names, learner, view = flat_steps(spark, d)
    fitted = one_tree(predict.GbtRegressor).fit(flat, names, ["y"])
    dm = DataModel(Placeholder("population", ("o_orderkey",)))
    return select.select_columns(dm, view.peripheral, learner.features(), fitted.importances(), 0.3)["lineitem"]


PRIORITY = "CAST(substr(o_orderpriority, 1, 1) AS DOUBLE)"


@query(
    "f14_planted_population",
    f"SELECT o_orderkey, {PRIORITY} AS priority, CASE WHEN {PRIORITY} > 2 THEN 10.0::DOUBLE ELSE 2.0 END AS y FROM orders",
)
def _(spark, d):
    # the target hangs on a column of the population; its price and all columns of the lines go
    dm, v = planted_orders(spark, d, STEP)
    rows = table(spark, d, "orders").select("o_orderkey", F.expr(PRIORITY).alias("priority"), F.col("o_totalprice").alias("price"))
    rows = R.set_role(rows.withColumn("y", F.when(F.col("priority") > 2, 10.0).otherwise(2.0)), "y", R.TARGET)
    view = View(rows, v["full"].peripheral)
    learner = Propositionalizer(("MAX",), compare_units=False).fit(dm, view)
    flat = learner.transform(dm, view).join(rows, "o_orderkey")
    fitted = one_tree(predict.GbtRegressor).fit(flat, [*[f.name for f in learner.features()], "priority", "price"], ["y"])
    return select.select_columns(dm, view.peripheral, learner.features(), fitted.importances(), 0.2, rows)["population"]


@query(
    "e10_planted_importance",
    f"SELECT feature, CAST(feature = '{LINE}' AS DOUBLE) AS importance FROM (VALUES ('{LINE}'), ('{QUANTITY}'), ('{DISCOUNT}')) AS v(feature)",
)
def _(spark, d):
    pipe, v = step_flow(spark, d, STEP, one_tree(predict.GbtRegressor))
    return spark.createDataFrame(sorted(pipe.fit(v["train"], ["y"]).importances().items()), "feature string, importance double")


@query(
    "e11_planted_importance",
    "SELECT source, CAST(source = 'lineitem.l_linenumber' AS DOUBLE) AS importance FROM (VALUES ('lineitem.l_linenumber'), ('lineitem.l_quantity'), ('lineitem.l_discount')) AS v(source)",
)
def _(spark, d):
    pipe, v = step_flow(spark, d, STEP, one_tree(predict.GbtRegressor))
    return spark.createDataFrame(sorted(pipe.fit(v["train"], ["y"]).column_importances().items()), "source string, importance double")


@query(
    "e12_planted_catalogue",
    rounded_sql(
        f"""WITH t AS (SELECT *, {STEP} AS y FROM (SELECT o_orderkey, coalesce(max(l_linenumber), 0) AS line, coalesce(max(l_quantity), 0) AS quantity,
        coalesce(max(l_discount), 0) AS discount FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey)),
        s AS (SELECT * FROM (SELECT *, {SPLIT} AS split FROM t) WHERE split = 'train')
        SELECT '{LINE}' AS name, 1.0::DOUBLE AS importance, corr(line, y) AS correlation FROM s
        UNION ALL SELECT '{QUANTITY}', 0.0, corr(quantity, y) FROM s UNION ALL SELECT '{DISCOUNT}', 0.0, corr(discount, y) FROM s""",
        "name",
        "importance correlation",
    ),
)
def _(spark, d):
    pipe, v = step_flow(spark, d, STEP, one_tree(predict.GbtRegressor))
    pipe.fit(v["train"], ["y"])
    return rounded(pipe.catalogue(v["train"]).sort("correlation").table.select("name", "importance", "correlation"))


@query(
    "g6_planted_classes",
    """SELECT c_custkey AS id, CAST(n_regionkey AS BIGINT) AS label FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT -1 - n_nationkey, n_regionkey FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)""",
)
def _(spark, d):
    # customers know their region, nations only hear of it from them; learnt on customers, told for all
    nations = table(spark, d, "nation").select("n_nationkey", F.col("n_regionkey").cast("double").alias("region"))
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    edges = customers.select(F.col("c_custkey").cast("long").alias("src"), (-1 - F.col("n_nationkey")).cast("long").alias("dst"))
    regions = [f"region{i}" for i in range(table(spark, d, "region").count())]
    own = [(F.col("region") == i).cast("double").alias(c) for i, c in enumerate(regions)]
    known = customers.select(F.col("c_custkey").cast("long").alias("id"), "region", *own)
    heard = edges.select(F.col("dst").alias("id")).distinct().select("id", F.lit(None).cast("double").alias("region"), *[F.lit(0.0).alias(c) for c in regions])
    nodes = known.unionByName(heard)
    rows = graph.propagate(nodes, graph.symmetrise(edges, "src", "dst"), "id", "src", "dst", regions).join(nodes.select("id", "region"), "id")
    model = predict.MultinomialRegression(0.001).fit(rows.where("region IS NOT NULL"), regions, "region")
    return model.predict(rows).select("id", F.col("prediction").cast("long").alias("label"))
