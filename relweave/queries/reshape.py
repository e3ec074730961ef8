"""W: windows, sorts, unions, reshaping; B: result tables of runs."""

from pyspark.sql import functions as F

from ..functions.aggregates import Agg
from ..functions.timecols import days, hours
from ..operators import reshape, splits, windows
from .registry import query, rounded, rounded_sql, scratch, table

WINDOW = """SELECT a.event_id, count(b.event_id) AS n, avg(b.value) AS mean, max(b.value) AS top FROM events a LEFT JOIN events b
ON a.user_id = b.user_id AND b.ts <= a.ts - INTERVAL {h} HOUR AND b.ts > a.ts - INTERVAL {hm} HOUR{more} GROUP BY a.event_id"""
AGGS = [Agg("COUNT", name="n"), Agg("AVG", "value", name="mean"), Agg("MAX", "value", name="top")]
OUT = ("event_id n", "mean top")


def _register_w1(tag, h, m):
    @query(f"w1_sliding_{tag}", rounded_sql(WINDOW.format(h=h, hm=h + m, more=""), *OUT))
    def _(spark, d):
        return rounded(windows.window_agg(table(spark, d, "events"), ["user_id"], "ts", ["event_id"], AGGS, hours(h), hours(m)))


_register_w1("1h", 0, 1)
_register_w1("1d", 1, 24)
_register_w1("7d", 1, 168)

SAME = {
    "weekday": (["weekday"], " AND dayofweek(a.ts) = dayofweek(b.ts)"),
    "hour": (["hour"], " AND hour(a.ts) = hour(b.ts)"),
    "weekday_hour": (["weekday", "hour"], " AND dayofweek(a.ts) = dayofweek(b.ts) AND hour(a.ts) = hour(b.ts)"),
}


def _register_w2(tag, parts, cond):
    @query(f"w2_seasonal_{tag}", rounded_sql(WINDOW.format(h=1, hm=24 * 28 + 1, more=cond), *OUT))
    def _(spark, d):
        events = table(spark, d, "events")
        return rounded(windows.seasonal_agg(events, ["user_id"], "ts", ["event_id"], AGGS, parts, hours(1), days(28)))


for _tag, (_parts, _cond) in SAME.items():
    _register_w2(_tag, _parts, _cond)


@query(
    "w3_value_ago",
    """SELECT a.event_id, arg_max(b.value, b.ts) AS ago FROM events a LEFT JOIN events b
    ON a.user_id = b.user_id AND b.ts <= a.ts - INTERVAL 24 HOUR GROUP BY a.event_id""",
)
def _(spark, d):
    return windows.lag_value(table(spark, d, "events"), ["user_id"], "ts", ["event_id"], "value", hours(24), "ago")


STANDINGS = """SELECT event_id, user_id, row_number() OVER w AS round, max(CAST(floor(value) AS BIGINT)) OVER w AS wins
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""


@query(
    "w4_difference",
    f"""WITH s AS ({STANDINGS}) SELECT a.event_id, coalesce(a.wins - b.wins, a.wins) AS win FROM s a
    LEFT JOIN s b ON a.user_id = b.user_id AND b.round = a.round - 1""",
)
def _(spark, d):
    from ..operators.ranks import group_row_number

    events = group_row_number(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "round")
    running = windows.window_agg(events, ["user_id"], "round", ["event_id"], [Agg("MAX", "floor(value)", name="wins")])
    standings = events.select("event_id", "user_id", "round").join(running, "event_id").withColumn("wins", F.col("wins").cast("bigint"))
    return windows.diff_prev(standings, ["user_id"], "round", "wins", "win").select("event_id", "win")


@query(
    "w5_next_is_cancelled",
    """WITH n AS (SELECT l_partkey, l_shipdate, min(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS flag FROM lineitem GROUP BY 1, 2),
    t AS (SELECT *, lead(flag) OVER (PARTITION BY l_partkey ORDER BY l_shipdate) AS nxt FROM n)
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, CAST(coalesce(nxt, 0) AS DOUBLE) AS cancelled
    FROM lineitem JOIN t USING (l_partkey, l_shipdate)""",
)
def _(spark, d):
    # (order, line) repeats in the test table: the row's contents identify it, copies agree
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice"]
    items = table(spark, d, "lineitem").withColumn("flag", (F.col("l_returnflag") == "R").cast("int"))
    moments = items.groupBy("l_partkey", "l_shipdate").agg(F.min("flag").alias("flag"))
    found = windows.next_is(moments, ["l_partkey"], "l_shipdate", ["l_partkey", "l_shipdate"], "flag", "cancelled")
    return items.select(*ids).join(found, ["l_partkey", "l_shipdate"]).drop("l_shipdate")


CHURN = """SELECT o_orderkey, CASE WHEN o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 180 DAY THEN NULL
WHEN EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND {cond}) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS churn FROM orders a"""


@query("w6_churn", CHURN.format(cond="b.o_orderdate > a.o_orderdate AND b.o_orderdate <= a.o_orderdate + INTERVAL 180 DAY"))
def _(spark, d):
    return windows.churn(table(spark, d, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"], 180).select("o_orderkey", "churn")


@query("w6_churn_later_than", CHURN.format(cond="b.o_orderdate > a.o_orderdate + INTERVAL 180 DAY"))
def _(spark, d):
    return windows.churn(table(spark, d, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"], 180, later_than=True).select("o_orderkey", "churn")


@query("w7_sort", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def _(spark, d):
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_custkey")


@query("w8_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(spark, d):
    return reshape.top_k(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 25, ["o_orderkey"])


@query("w9_shuffle", "SELECT o_orderkey, o_custkey FROM orders")
def _(spark, d):
    return reshape.shuffle(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 1234)


@query(
    "w10_union_with_origin",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'validation' ELSE 'test' END AS split FROM orders""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    parts = {n: orders.where(F.col("o_orderstatus") == s) for n, s in (("train", "F"), ("validation", "O"), ("test", "P"))}
    return splits.concat("split", **parts).select("o_orderkey", "split")


@query("w11_column_concat", "SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders")
def _(spark, d):
    orders = table(spark, d, "orders")
    left = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    right = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return reshape.column_concat([left, right], ["o_orderkey"], drop=["o_custkey"])


MELTED = "SELECT l_orderkey, l_linenumber, var, val FROM lineitem UNPIVOT (val FOR var IN (l_quantity, l_discount, l_tax))"


@query("w12_unpivot", MELTED)
def _(spark, d):
    items = table(spark, d, "lineitem")
    return reshape.melt(items, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "var", "val")


@query(
    "w13_pivot",
    rounded_sql(
        """SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS f,
        sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS o, sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS p
        FROM orders GROUP BY o_custkey""",
        "o_custkey",
        "f o p",
    ),
)
def _(spark, d):
    out = reshape.pivot(table(spark, d, "orders"), ["o_custkey"], "o_orderstatus", ["F", "O", "P"], [F.sum("o_totalprice")])
    return rounded(out.withColumnsRenamed({"F": "f", "O": "o", "P": "p"}))


SPLIT_SQL = """SELECT user_id, max(event_type) AS label, (SELECT count(*) FROM events) AS signals FROM events GROUP BY user_id"""


@query("w14_series_to_relational", SPLIT_SQL)
def _(spark, d):
    population, signals = reshape.series_to_relational(table(spark, d, "events"), "user_id", "event_type", "ts", "value")
    total = signals.agg(F.count(F.lit(1)).alias("signals"))
    return population.withColumnRenamed("event_type", "label").join(F.broadcast(total))


# every user stands for a dataset, every event type for a tool, values for seconds, counts for features
RUNS = "SELECT user_id, event_type AS tool, sum(value) AS runtime, count(*) AS num_features FROM events GROUP BY 1, 2"
BENCH = f"""WITH r AS ({RUNS}) SELECT r.user_id, r.tool, r.runtime, r.num_features, r.num_features / r.runtime AS features_per_second,
r.runtime / b.runtime AS normalized_runtime,
(r.runtime / r.num_features) / (b.runtime / b.num_features) AS normalized_runtime_per_feature
FROM r LEFT JOIN r b ON b.user_id = r.user_id AND b.tool = 'click'"""
BENCH_FLOATS = "runtime features_per_second normalized_runtime normalized_runtime_per_feature"


def _runs(spark, d):
    runs = table(spark, d, "events").groupBy("user_id", F.col("event_type").alias("tool"))
    return runs.agg(F.sum("value").alias("runtime"), F.count(F.lit(1)).alias("num_features"))


@query("b2_bench_table", rounded_sql(BENCH, "user_id tool num_features", BENCH_FLOATS))
def _(spark, d):
    return rounded(reshape.label_benchmark(_runs(spark, d), "user_id", "tool", "runtime", "num_features", "click"))


TOOLS = ["click", "error", "purchase", "signup", "view"]


@query(
    "b3_bench_summary",
    "SELECT dataset, "
    + ", ".join(f"max(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in TOOLS)
    + " FROM (SELECT CASE WHEN value < 10 THEN 'small' ELSE 'large' END AS dataset, event_type, value FROM events) AS q GROUP BY dataset",
)
def _(spark, d):
    path = scratch(spark, "b3")
    rows = table(spark, d, "events").select("event_type", "value")
    for name, cond in (("small", "value < 10"), ("large", "value >= 10")):
        rows.where(cond).write.option("header", True).csv(f"{path}/{name}.csv")
    paths = [f"{path}/small.csv", f"{path}/large.csv"]
    return reshape.read_benchmarks(spark, paths, "event_type STRING, value DOUBLE", "event_type", TOOLS, ["value"])
