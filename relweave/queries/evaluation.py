"""Scores, correlations and curves of a deterministic score."""

from pyspark.sql import functions as F

from ..operators import metrics
from .registry import query, rounded, rounded_sql, table

# score of a document: longer texts score higher
SCORED = """SELECT doc_id, quality AS y, n_chars / (n_chars + 1000.0::DOUBLE) AS p FROM documents JOIN labels USING (doc_id)"""


def scored(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id")
    return rows.select("doc_id", F.col("quality").alias("y"), (F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("p"), "toxic", "n_chars")


CLASSES = ", ".join(f"((n_chars * {i + 3}) % 101) / 101.0::DOUBLE AS p{i}" for i in range(3))
ARGMAX = f"""SELECT avg(CASE WHEN pick = actual THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM (SELECT actual,
CASE WHEN p0 >= p1 AND p0 >= p2 THEN '0' WHEN p1 >= p2 THEN '1' ELSE '2' END AS pick FROM
(SELECT CAST(quality AS VARCHAR) AS actual, {CLASSES} FROM documents JOIN labels USING (doc_id)) AS q) AS r"""


@query("e7_argmax_accuracy", ARGMAX)
def _(spark, d):
    rows = scored(spark, d).withColumns({f"p{i}": ((F.col("n_chars") * (i + 3)) % 101) / 101.0 for i in range(3)})
    rows = rows.withColumn("actual", F.col("y").cast("string"))
    return metrics.argmax_accuracy(rows, "actual", ["p0", "p1", "p2"], ["0", "1", "2"])


@query(
    "e8_regression_scores",
    rounded_sql(
        """SELECT avg(abs(a - b)) AS mae, sqrt(avg((a - b) * (a - b))) AS rmse, pow(corr(a, b), 2) AS rsquared
        FROM (SELECT l_extendedprice AS a, l_quantity * 1000 AS b FROM lineitem) AS q""",
        [],
        "mae rmse rsquared",
    ),
)
def _(spark, d):
    rows = table(spark, d, "lineitem").select("l_extendedprice", (F.col("l_quantity") * 1000).alias("guess"))
    return rounded(metrics.regression_scores(rows, "l_extendedprice", "guess"))


AUC = f"""SELECT sum(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END) / count(*)
FROM ({SCORED}) a JOIN ({SCORED}) b ON a.y = 1 AND b.y = 0"""


@query(
    "e8_classification_scores",
    rounded_sql(
        f"""SELECT avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0 ELSE 0 END) AS accuracy,
        -avg(y * ln(p) + (1 - y) * ln(1 - p)) AS cross_entropy, ({AUC}) AS auc FROM ({SCORED}) AS s""",
        [],
        "accuracy cross_entropy auc",
    ),
)
def _(spark, d):
    return rounded(metrics.classification_scores(scored(spark, d), "y", "p"))


@query(
    "e8_mean_over_targets",
    rounded_sql(
        f"""SELECT avg(mae) AS mae, avg(rmse) AS rmse, avg(rsquared) AS rsquared FROM (
        SELECT avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse, pow(corr(y, p), 2) AS rsquared FROM ({SCORED}) AS a
        UNION ALL SELECT avg(abs(toxic - p)), sqrt(avg((toxic - p) * (toxic - p))), pow(corr(toxic, p), 2)
        FROM ({SCORED}) AS b JOIN labels USING (doc_id)) AS q""",
        [],
        "mae rmse rsquared",
    ),
)
def _(spark, d):
    rows = scored(spark, d)
    return rounded(metrics.mean_over_targets([metrics.regression_scores(rows, t, "p") for t in ("y", "toxic")]))


CORR_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query(
    "e9_correlations",
    rounded_sql(
        " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, l_extendedprice) AS correlation FROM lineitem" for c in CORR_COLS),
        "feature",
        "correlation",
    ),
)
def _(spark, d):
    return rounded(metrics.correlation_table(table(spark, d, "lineitem"), CORR_COLS, "l_extendedprice"))


CURVE = f"""WITH s AS ({SCORED}), g AS (SELECT p AS score, count(*) AS n, sum(y) AS pos FROM s GROUP BY p),
c AS (SELECT score, sum(n) OVER w AS cn, sum(pos) OVER w AS cp, sum(n) OVER () AS an, sum(pos) OVER () AS ap FROM g WINDOW w AS (ORDER BY score DESC))
SELECT score, {{cols}} FROM c"""


@query("e13_roc_curve", rounded_sql(CURVE.format(cols="(cn - cp) / (an - ap) AS fpr, cp / ap AS tpr"), [], "score fpr tpr"))
def _(spark, d):
    return rounded(metrics.roc_curve(scored(spark, d), "y", "p"))


@query("e14_precision_recall", rounded_sql(CURVE.format(cols='cp / cn AS "precision", cp / ap AS recall'), [], ["score", '"precision"', "recall"]))
def _(spark, d):
    return rounded(metrics.precision_recall_curve(scored(spark, d), "y", "p"))


@query("e15_lift_curve", rounded_sql(CURVE.format(cols="cn / an AS proportion, (cp / cn) / (ap / an) AS lift"), [], "score proportion lift"))
def _(spark, d):
    return rounded(metrics.lift_curve(scored(spark, d), "y", "p"))
