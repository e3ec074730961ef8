"""F12 by the types of feature and target: statistics and p-values next to SQL."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dependence
from ..plans import select
from .registry import ORACLES, query, table

ERFC = """greatest(0, 1 - CASE WHEN {z} = 0 THEN 0 WHEN {z} > 8 THEN 1 ELSE 2 / sqrt(pi()) * exp(-{z} * {z} / 2) * list_sum(list_transform(range(0, 150),
    lambda k: exp(k * ln(4) + lgamma(k + 1) + (2 * k + 1) * ln({z} / sqrt(2)) - lgamma(2 * k + 2)))) END)"""


def normal(z: str) -> str:
    """Two-sided p-value of a normal variable: 1 - erf(z / sqrt 2) by a series of positive terms."""
    return ERFC.format(z=f"({z})")


def told(spark, rows) -> DataFrame:
    """One row a feature; p to nine digits, the statistic to a relative 1e-7."""
    out = spark.createDataFrame(rows, "feature string, test string, statistic double, p double")
    return out.select("feature", "test", (F.col("statistic") * (1 + 2.0**-26)).cast("float").cast("double").alias("statistic"), (F.round("p", 9) + 0.0).alias("p"))


def shown(test: str, inner: str) -> str:
    return f"SELECT feature, '{test}' AS test, CAST(CAST(statistic * (1 + pow(2, -26)) AS FLOAT) AS DOUBLE) AS statistic, round(p, 9) + 0.0::DOUBLE AS p FROM ({inner}) AS q"


# ---- real feature, real target

CUSTOMERS = """SELECT c_custkey, c_acctbal AS y, CAST(count(o_orderkey) AS DOUBLE) AS orders, coalesce(sum(o_totalprice), 0.0::DOUBLE) AS price, CAST(c_nationkey AS DOUBLE) AS nation,
    c_acctbal + 3 * c_nationkey * c_nationkey AS shifted FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal, c_nationkey"""
REAL = ["orders", "price", "nation", "shifted"]


def customers(spark, d):
    spent = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("orders"), F.sum("o_totalprice").alias("price"))
    own = table(spark, d, "customer").join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
    nation = F.col("c_nationkey").cast("double")
    return own.select("c_custkey", F.col("c_acctbal").alias("y"), "orders", "price", nation.alias("nation"), (F.col("c_acctbal") + 3 * nation * nation).alias("shifted"))


@query(
    "f12_kendall",
    shown(
        "kendall",
        f"""WITH c AS ({CUSTOMERS}), l AS ({' UNION ALL '.join(f"SELECT '{x}' AS feature, {x} AS x, y, c_custkey AS id FROM c" for x in REAL)}),
        d AS (SELECT a.feature, sum(sign(a.x - b.x) * sign(a.y - b.y)) AS s FROM l a JOIN l b ON a.feature = b.feature AND a.id < b.id GROUP BY a.feature),
        tx AS (SELECT feature, sum(t * (t - 1) / 2) AS a, sum(t * (t - 1) * (t - 2)) AS b, sum(t * (t - 1) * (2 * t + 5)) AS c FROM (SELECT feature, x, CAST(count(*) AS DOUBLE) AS t FROM l GROUP BY feature, x) GROUP BY feature),
        ty AS (SELECT feature, sum(t * (t - 1) / 2) AS a, sum(t * (t - 1) * (t - 2)) AS b, sum(t * (t - 1) * (2 * t + 5)) AS c FROM (SELECT feature, y, CAST(count(*) AS DOUBLE) AS t FROM l GROUP BY feature, y) GROUP BY feature),
        v AS (SELECT feature, s, n, n * (n - 1) / 2 AS pairs, tx.a AS xa, ty.a AS ya,
          (n * (n - 1) * (2 * n + 5) - tx.c - ty.c) / 18 + 2 * tx.a * ty.a / (n * (n - 1)) + tx.b * ty.b / (9 * n * (n - 1) * (n - 2)) AS var
          FROM d JOIN tx USING (feature) JOIN ty USING (feature), (SELECT CAST(count(*) AS DOUBLE) AS n FROM c))
        SELECT feature, s / sqrt((pairs - xa) * (pairs - ya)) AS statistic, {normal('abs(s) / sqrt(var)')} AS p FROM v""",
    ),
)
def _(spark, d):
    return told(spark, dependence.dependence(customers(spark, d), REAL, "y", pieces=16))


# ---- the other three pairs, on all line items

MEASURES = ["l_quantity", "l_discount", "l_extendedprice", "l_linenumber"]
FLAGS = {"returned": "l_returnflag = 'R'", "is_open": "l_linestatus = 'O'", "taxed": "l_tax > 0.04", "large": "l_quantity > 48", "cheap": "l_extendedprice < 20000"}


def items(spark, d, target):
    flags = [F.expr(f"CAST({sql} AS DOUBLE)").alias(n) for n, sql in FLAGS.items()]
    return table(spark, d, "lineitem").select(*[F.col(c).cast("double").alias(c) for c in MEASURES], *flags, F.expr(target).cast("double").alias("y"))


def melted(columns: dict[str, str], target: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS feature, CAST({sql} AS DOUBLE) AS x, CAST({target} AS DOUBLE) AS y FROM lineitem" for n, sql in columns.items())


HIGH = "l_returnflag = 'R' AND l_quantity > 10"


@query(
    "f12_mann_whitney",
    shown(
        "mann_whitney",
        f"""WITH l AS ({melted({c: c for c in MEASURES}, HIGH)}),
        g AS (SELECT feature, x, CAST(count(*) AS DOUBLE) AS t, sum(y) AS c FROM l GROUP BY feature, x),
        r AS (SELECT *, sum(t) OVER (PARTITION BY feature ORDER BY x) - t + (t + 1) / 2 AS rank FROM g),
        u AS (SELECT feature, sum(t) AS n, sum(c) AS n1, sum(c * rank) - sum(c) * (sum(c) + 1) / 2 AS statistic, sum(t * t * t - t) AS ties FROM r GROUP BY feature)
        SELECT feature, statistic, {normal('greatest(0, abs(statistic - n1 * (n - n1) / 2) - 0.5) / sqrt(n1 * (n - n1) / 12 * (n + 1 - ties / (n * (n - 1))))')} AS p FROM u""",
    ),
)
def _(spark, d):
    return told(spark, dependence.dependence(items(spark, d, HIGH), MEASURES, "y"))


@query(
    "f12_kolmogorov",
    shown(
        "kolmogorov_smirnov",
        f"""WITH l AS ({melted(FLAGS, 'l_extendedprice')}),
        g AS (SELECT feature, y, CAST(count(*) AS DOUBLE) AS t, sum(x) AS c FROM l GROUP BY feature, y),
        r AS (SELECT feature, sum(t) OVER w AS t, sum(c) OVER w AS c, sum(t) OVER (PARTITION BY feature) AS n, sum(c) OVER (PARTITION BY feature) AS n1 FROM g WINDOW w AS (PARTITION BY feature ORDER BY y)),
        s AS (SELECT feature, max(abs(c / n1 - (t - c) / (n - n1))) AS statistic, any_value(n1 * (n - n1) / n) AS m FROM r GROUP BY feature)
        SELECT feature, statistic, CASE WHEN statistic * sqrt(m) < 0.2 THEN 1 ELSE least(1, greatest(0, 2 * list_sum(list_transform(range(1, 101),
          lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * statistic * statistic * m))))) END AS p FROM s""",
    ),
)
def _(spark, d):
    return told(spark, dependence.dependence(items(spark, d, "l_extendedprice"), list(FLAGS), "y"))


@query(
    "f12_fisher",
    shown(
        "fisher",
        f"""WITH l AS ({melted({n: s for n, s in FLAGS.items() if n != 'cheap'}, FLAGS['cheap'])}),
        g AS (SELECT feature, CAST(sum(x * y) AS BIGINT) AS a, CAST(sum(x) AS BIGINT) AS r, CAST(sum(y) AS BIGINT) AS c, count(*) AS n FROM l GROUP BY feature),
        h AS (SELECT *, list_transform(range(greatest(0, c - (n - r)), least(r, c) + 1), lambda x: lgamma(r + 1) + lgamma(n - r + 1) + lgamma(c + 1) + lgamma(n - c + 1) - lgamma(n + 1)
          - lgamma(x + 1) - lgamma(r - x + 1) - lgamma(c - x + 1) - lgamma(n - r - c + x + 1)) AS logs, greatest(0, c - (n - r)) AS low FROM g)
        SELECT feature, CAST(a AS DOUBLE) AS statistic, least(1, list_sum(list_transform(logs, lambda v: CASE WHEN v <= logs[CAST(a - low + 1 AS INT)] + 1e-7 THEN exp(v) ELSE 0 END))) AS p FROM h""",
    ),
)
def _(spark, d):
    return told(spark, dependence.dependence(items(spark, d, FLAGS["cheap"]), [n for n in FLAGS if n != "cheap"], "y"))


def by_sql(parts: str, m: int, fdr: float) -> str:
    return f"""WITH p AS ({parts}), o AS (SELECT feature, p, row_number() OVER (ORDER BY p, feature) AS i FROM p)
        SELECT feature FROM o WHERE i <= (SELECT coalesce(max(i), 0) FROM o WHERE p <= i * {fdr} / ({m} * (SELECT sum(1.0::DOUBLE / k) FROM range(1, {m} + 1) AS r(k))))"""


@query("f12_typed_selection", by_sql(ORACLES["f12_mann_whitney"], len(MEASURES), 0.05))
def _(spark, d):
    return spark.createDataFrame([(c,) for c in select.select_dependent(items(spark, d, HIGH), MEASURES, "y")], "feature string")
