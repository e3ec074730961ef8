"""A: aggregates, over whole groups (grp) and over time-bounded windows (win)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.aggregates import Agg
from ..functions.stats import line_fit
from ..functions.timecols import days, order_sql
from ..operators import grouping, ranks, windows
from ..plans.series import minimal_aggs
from .registry import query, rounded, rounded_sql, table


def by_user(spark, d, aggs, time="ts"):
    return rounded(grouping.group_aggregate(table(spark, d, "events"), ["user_id"], aggs, time))


def per_event(spark, d, aggs, memory=days(10)):
    return rounded(windows.window_agg(table(spark, d, "events"), ["user_id"], "ts", ["event_id"], aggs, 1, memory))


GRP = "SELECT user_id, {cols} FROM events GROUP BY user_id"
WIN = """SELECT a.event_id, {cols} FROM events a LEFT JOIN events b
ON a.user_id = b.user_id AND b.ts < a.ts AND b.ts >= a.ts - INTERVAL 10 DAY GROUP BY a.event_id, a.ts"""
GROUPED = GRP.format


def both(number, name, func, grp, win, keep=False, column="value", param=None):
    """Register one aggregate in its grouped and in its windowed form."""
    aggs = [Agg(func, column, name="x", param=param)]
    key = f"a{number}_{name}"
    for tag, ident, sql, run in (("grp", "user_id", grp and GRP.format(cols=f"{grp} AS x"), by_user), ("win", "event_id", win and WIN.format(cols=f"{win} AS x"), per_event)):
        if sql:
            text = sql if keep else rounded_sql(sql, ident, "x")
            query(f"{key}_{tag}", text)(lambda spark, d, run=run: run(spark, d, aggs))


SECONDS_B = "(epoch_us(b.ts) / 1000000.0)"
SECONDS_A = "(epoch_us(a.ts) / 1000000.0)"
both(1, "avg", "AVG", "avg(value)", "avg(b.value)")
both(2, "sum", "SUM", "sum(value)", "sum(b.value)")
both(3, "min", "MIN", "min(value)", "min(b.value)")
both(4, "max", "MAX", "max(value)", "max(b.value)")
both(5, "median", "MEDIAN", "median(value)", "median(b.value)")
both(6, "first", "FIRST", "arg_min(value, ts)", "arg_min(b.value, b.ts)")
both(7, "last", "LAST", "arg_max(value, ts)", "arg_max(b.value, b.ts)")
both(8, "var", "VAR", "var_pop(value)", "var_pop(b.value)")
both(9, "stddev", "STDDEV", "stddev_pop(value)", "stddev_pop(b.value)")
DECAY = f"pow(2, ({SECONDS_B} - {SECONDS_A}) / 172800.0)"
both(10, "ewma", "EWMA", None, f"sum(b.value * {DECAY}) / sum({DECAY})", param=172800.0)
for share in (0.01, 0.05, 0.10, 0.25, 0.75, 0.90, 0.95, 0.99):
    q = f"quantile_cont({{c}}, {share})"
    both(11, f"q{round(share * 100):02d}", "QUANTILE", q.format(c="value"), q.format(c="b.value"), param=share)


def moments(c: str) -> tuple[str, str]:
    m = f"avg({c})"
    m2, m3 = f"(avg({c}*{c}) - {m}*{m})", f"(avg({c}*{c}*{c}) - 3*{m}*avg({c}*{c}) + 2*{m}*{m}*{m})"
    skew = f"CASE WHEN min({c}) < max({c}) THEN {m3} / pow({m2}, 1.5) END"
    return skew, f"CASE WHEN min({c}) < max({c}) THEN kurtosis_pop({c}) END"


# two equal-sided values have skewness 0 up to cancellation: compare from three values on, to five digits
SKEW_GRP = """SELECT user_id, CASE WHEN n > 2 THEN round({x}, 5) + 0.0 END AS x FROM ({inner}) AS q"""


def _skew(df, ident):
    return df.select(ident, F.when(F.col("n") > 2, F.round("x", 5) + 0.0).alias("x"))


@query("a12_skew_grp", SKEW_GRP.format(x="x", inner=GRP.format(cols=f"{moments('value')[0]} AS x, count(value) AS n")))
def _(spark, d):
    aggs = [Agg("SKEW", "value", name="x"), Agg("COUNT", "value", name="n")]
    return _skew(grouping.group_aggregate(table(spark, d, "events"), ["user_id"], aggs), "user_id")


@query(
    "a12_skew_win",
    SKEW_GRP.replace("user_id", "event_id").format(x="x", inner=WIN.format(cols=f"{moments('b.value')[0]} AS x, count(b.value) AS n")),
)
def _(spark, d):
    aggs = [Agg("SKEW", "value", name="x"), Agg("COUNT", "value", name="n")]
    return _skew(windows.window_agg(table(spark, d, "events"), ["user_id"], "ts", ["event_id"], aggs, 1, days(10)), "event_id")


@query(
    "a13_trend_win",
    WIN.format(
        cols=f"CASE WHEN count(b.value) > 2 THEN round(regr_intercept(b.value, {SECONDS_B} - {SECONDS_A}), 4) + 0.0 END AS x"
    ),
)
def _(spark, d):
    # the line is a forecast for one tick before the row; at one microsecond the two agree to 4 digits
    aggs = [Agg("TREND", "value", name="x"), Agg("COUNT", "value", name="n")]
    out = windows.window_agg(table(spark, d, "events"), ["user_id"], "ts", ["event_id"], aggs, 1, days(10))
    return out.select("event_id", F.when(F.col("n") > 2, F.round("x", 4) + 0.0).alias("x"))


both(14, "count", "COUNT", "count(*)", "count(b.event_id)", keep=True, column=None)
both(15, "count_distinct", "COUNT_DISTINCT", "count(DISTINCT event_type)", "count(DISTINCT b.event_type)", True, "event_type")
both(
    16, "count_minus_distinct", "COUNT_MINUS_DISTINCT", "count(event_type) - count(DISTINCT event_type)",
    "count(b.event_type) - count(DISTINCT b.event_type)", True, "event_type",
)
both(
    17, "percent_unique", "PERCENT_UNIQUE", "count(DISTINCT event_type) / count(event_type)",
    "CASE WHEN count(b.event_type) > 0 THEN count(DISTINCT b.event_type) / count(b.event_type) END", column="event_type",
)


@query(
    "a15_count_distinct_as_of",
    """SELECT a.o_orderkey, count(DISTINCT b.o_orderpriority) AS x FROM orders a LEFT JOIN orders b
    ON a.o_custkey = b.o_custkey AND b.o_orderdate <= a.o_orderdate GROUP BY a.o_orderkey""",
)
def _(spark, d):
    aggs = [Agg("COUNT_DISTINCT", "o_orderpriority", name="x")]
    return windows.window_agg(table(spark, d, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"], aggs)


AS_OF = """SELECT a.o_orderkey, {x} AS x FROM orders a LEFT JOIN orders b
    ON a.o_custkey = b.o_custkey AND b.o_orderdate <= a.o_orderdate GROUP BY a.o_orderkey"""


def as_of(spark, d, agg):
    return rounded(windows.window_agg(table(spark, d, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"], [agg]))


@query("a5_median_as_of", rounded_sql(AS_OF.format(x="median(b.o_totalprice)"), "o_orderkey", "x"))
def _(spark, d):
    return as_of(spark, d, Agg("MEDIAN", "o_totalprice", name="x"))


@query("a11_q05_as_of", rounded_sql(AS_OF.format(x="quantile_cont(b.o_totalprice, 0.05)"), "o_orderkey", "x"))
def _(spark, d):
    return as_of(spark, d, Agg("QUANTILE", "o_totalprice", name="x", param=0.05))


@query(
    "a18_mode_as_of",
    """WITH p AS (SELECT a.o_orderkey, date_part('dayofyear', b.o_orderdate) AS v, count(*) AS k FROM orders a JOIN orders b
    ON a.o_custkey = b.o_custkey AND b.o_orderdate <= a.o_orderdate GROUP BY 1, 2)
    SELECT o_orderkey, CAST((array_agg(v ORDER BY k DESC, v))[1] AS INTEGER) AS x FROM p GROUP BY o_orderkey""",
)
def _(spark, d):
    return as_of(spark, d, Agg("MODE", "dayofyear(o_orderdate)", name="x"))


HALF_DAY = "pow(2, (epoch_us(b.o_orderdate) - epoch_us(a.o_orderdate)) / 1000000.0 / 43200.0)"


@query("a10_ewma_as_of", rounded_sql(AS_OF.format(x=f"sum(b.o_totalprice * {HALF_DAY}) / sum({HALF_DAY})"), "o_orderkey", "x"))
def _(spark, d):
    # half a day against years of orders: thousands of half-lives
    return as_of(spark, d, Agg("EWMA", "o_totalprice", name="x", param=43200.0))


MODE_SQL = """SELECT {id}, (array_agg(event_type ORDER BY k DESC, event_type))[1] AS x FROM
({inner}) AS q GROUP BY {id}"""


@query(
    "a18_mode_grp",
    MODE_SQL.format(id="user_id", inner="SELECT user_id, event_type, count(*) AS k FROM events GROUP BY user_id, event_type"),
)
def _(spark, d):
    return by_user(spark, d, [Agg("MODE", "event_type", name="x")])


@query(
    "a18_mode_win",
    "SELECT event_id, m.x FROM events LEFT JOIN ("
    + MODE_SQL.format(
        id="event_id",
        inner="""SELECT a.event_id, b.event_type, count(*) AS k FROM events a JOIN events b ON a.user_id = b.user_id
        AND b.ts < a.ts AND b.ts >= a.ts - INTERVAL 10 DAY GROUP BY a.event_id, b.event_type""",
    )
    + ") AS m USING (event_id)",
)
def _(spark, d):
    return per_event(spark, d, [Agg("MODE", "event_type", name="x")])


@query("a19_kurtosis_grp", rounded_sql(GRP.format(cols=f"{moments('value')[1]} AS x"), "user_id", "x"))
def _(spark, d):
    return by_user(spark, d, [Agg("KURTOSIS", "value", name="x")])


@query(
    "a19_kurtosis_win",
    SKEW_GRP.replace("user_id", "event_id").format(x="x", inner=WIN.format(cols=f"{moments('b.value')[1]} AS x, count(b.value) AS n")),
)
def _(spark, d):
    aggs = [Agg("KURTOSIS", "value", name="x"), Agg("COUNT", "value", name="n")]
    return _skew(windows.window_agg(table(spark, d, "events"), ["user_id"], "ts", ["event_id"], aggs, 1, days(10)), "event_id")


AROUND = """WITH m AS (SELECT o_custkey, avg(o_totalprice) AS mu, max(o_totalprice) AS hi, min(o_totalprice) AS lo FROM orders GROUP BY o_custkey)
SELECT o_custkey, {cols} FROM orders JOIN m USING (o_custkey) GROUP BY o_custkey"""


def _around(spark, d, aggs):
    return rounded(grouping.group_aggregate(table(spark, d, "orders"), ["o_custkey"], aggs))


@query("a20_around_mean_grp", AROUND.format(cols="count(CASE WHEN o_totalprice > mu THEN 1 END) AS above, count(CASE WHEN o_totalprice < mu THEN 1 END) AS below"))
def _(spark, d):
    out = _around(spark, d, [Agg("COUNT_ABOVE_MEAN", "o_totalprice", name="above"), Agg("COUNT_BELOW_MEAN", "o_totalprice", name="below")])
    return out.select("o_custkey", F.col("above").cast("bigint").alias("above"), F.col("below").cast("bigint").alias("below"))


PAIRS = """SELECT a.event_id, b.event_type, CAST(floor(b.value) AS INTEGER) AS v FROM events a LEFT JOIN events b
ON a.user_id = b.user_id AND b.ts < a.ts AND b.ts >= a.ts - INTERVAL 10 DAY"""
EXTREMES = f"""WITH p AS ({PAIRS}), m AS (SELECT event_id, max(v) AS hi, min(v) AS lo, avg(v) AS mu FROM p GROUP BY event_id)
SELECT event_id, {{cols}} FROM p JOIN m USING (event_id) GROUP BY event_id"""


@query(
    "a20_a21_extremes_win",
    EXTREMES.format(cols="count(CASE WHEN v = hi THEN 1 END) AS num_max, count(CASE WHEN v = lo THEN 1 END) AS num_min, count(CASE WHEN v > mu THEN 1 END) AS above, count(CASE WHEN v < mu THEN 1 END) AS below"),
)
def _(spark, d):
    v = "CAST(floor(value) AS INT)"
    aggs = [
        Agg("NUM_MAX", v, name="num_max"), Agg("NUM_MIN", v, name="num_min"),
        Agg("COUNT_ABOVE_MEAN", v, name="above"), Agg("COUNT_BELOW_MEAN", v, name="below"),
    ]
    return per_event(spark, d, aggs).select("event_id", *[F.col(c).cast("bigint").alias(c) for c in ("num_max", "num_min", "above", "below")])


@query(
    "a21_num_max_min_grp",
    """WITH m AS (SELECT l_orderkey, max(l_discount) AS hi, min(l_discount) AS lo FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, count(CASE WHEN l_discount = hi THEN 1 END) AS num_max, count(CASE WHEN l_discount = lo THEN 1 END) AS num_min
    FROM lineitem JOIN m USING (l_orderkey) GROUP BY l_orderkey""",
)
def _(spark, d):
    aggs = [Agg("NUM_MAX", "l_discount", name="num_max"), Agg("NUM_MIN", "l_discount", name="num_min")]
    return grouping.group_aggregate(table(spark, d, "lineitem"), ["l_orderkey"], aggs)


both(22, "variation_coefficient", "VARIATION_COEFFICIENT", "stddev_pop(value) / avg(value)", "stddev_pop(b.value) / nullif(avg(b.value), 0)")
SPAN = "CASE WHEN count({t}) > 1 THEN (epoch_us(max({t})) - epoch_us(min({t}))) / 1000000.0 / (count({t}) - 1) END"
both(23, "avg_time_between", "AVG_TIME_BETWEEN", SPAN.format(t="ts"), SPAN.format(t="b.ts"))
SINCE = {
    "first": "min(b.ts)",
    "last": "max(b.ts)",
    "first_max": "arg_min(b.ts, {'v': -b.value, 't': b.ts})",
    "last_max": "arg_max(b.ts, {'v': b.value, 't': b.ts})",
    "first_min": "arg_min(b.ts, {'v': b.value, 't': b.ts})",
    "last_min": "arg_max(b.ts, {'v': -b.value, 't': b.ts})",
}
for tag, at in SINCE.items():
    both(24, f"time_since_{tag}", f"TIME_SINCE_{tag.upper()}", None, f"(epoch_us(a.ts) - epoch_us({at})) / 1000000.0")

MINIMAL_NAMES = "sum_values mean median standard_deviation variance root_mean_square maximum absolute_maximum minimum".split()
MINIMAL_SQL = {
    "sum_values": "sum(v)", "mean": "avg(v)", "median": "median(v)", "standard_deviation": "stddev_pop(v)", "variance": "var_pop(v)",
    "root_mean_square": "sqrt(avg(v * v))", "maximum": "max(v)", "absolute_maximum": "max(abs(v))", "minimum": "min(v)",
}


@query(
    "a25_minimal_set",
    rounded_sql(
        "SELECT user_id, count(v) AS length, "
        + ", ".join(f"{s} AS {n}" for n, s in MINIMAL_SQL.items())
        + " FROM (SELECT user_id, value - 50 AS v FROM events) AS e GROUP BY user_id",
        "user_id length",
        MINIMAL_NAMES,
    ),
)
def _(spark, d):
    events = table(spark, d, "events").withColumn("v", F.col("value") - 50)
    out = grouping.group_aggregate(events, ["user_id"], minimal_aggs("v"))
    return rounded(out.withColumnsRenamed({c: c.removeprefix("v__") for c in out.columns}))


TREND_SQL = """WITH h AS (SELECT o_custkey, o_totalprice AS y,
  (epoch_us(o_orderdate) - epoch_us(min(o_orderdate) OVER (PARTITION BY o_custkey))) / 3600000000.0 AS x FROM orders),
f AS (SELECT o_custkey, count(*) AS n, CASE WHEN count(*) > 1 THEN regr_slope(y, x) END AS slope,
  CASE WHEN count(*) > 1 THEN regr_intercept(y, x) END AS intercept, CASE WHEN count(*) > 1 THEN corr(x, y) END AS r,
  CASE WHEN count(*) > 2 THEN sqrt((1 - corr(x, y) * corr(x, y)) * regr_syy(y, x) / regr_sxx(y, x) / (count(*) - 2)) WHEN count(*) = 2 THEN 0 END AS stderr
  FROM h GROUP BY o_custkey)
SELECT o_custkey, n, slope, intercept, r, stderr FROM f"""


@query("a26_linear_trend", rounded_sql(TREND_SQL, "o_custkey n", "slope intercept r stderr"))
def _(spark, d):
    orders = table(spark, d, "orders")
    hours = orders.select("o_custkey", (F.expr(order_sql(orders, "o_orderdate")) / 3.6e9).alias("t"), F.col("o_totalprice").alias("y"))
    start = hours.groupBy("o_custkey").agg(F.min("t").alias("t0"))
    h = hours.join(start, "o_custkey").withColumn("x", F.col("t") - F.col("t0"))
    # centred sums from the built-in moments keep all digits
    s = h.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"),
        F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"), F.covar_pop("x", "y").alias("c"),
    )
    n, zero = F.col("n"), F.lit(0.0)
    fit = line_fit(n, zero, zero, n * F.col("vx"), n * F.col("c"), n * F.col("vy"))
    intercept = F.col("my") - fit["slope"] * F.col("mx")
    out = s.select("o_custkey", "n", fit["slope"].alias("slope"), intercept.alias("intercept"), fit["r"].alias("r"), fit["stderr"].alias("stderr"))
    return rounded(out)


# the finite series of the t distribution, summed term by term: cosines of even or odd powers up to n - 4
P_SQL = """WITH RECURSIVE g AS (SELECT user_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) // 6 AS blk, value AS y,
  row_number() OVER (PARTITION BY user_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 6 ORDER BY ts, event_id) AS x FROM events),
f AS (SELECT user_id, blk, count(*) AS n, corr(x, y) AS r, var_pop(y) AS vy FROM g GROUP BY user_id, blk),
t AS (SELECT *, atan(abs(r) / sqrt((1 - r) * (1 + r))) AS a FROM f WHERE n > 2 AND vy > 0 AND abs(r) < 1),
s AS (SELECT user_id, blk, n, a, 1.0::DOUBLE AS term, 1.0::DOUBLE AS total, CAST(n % 2 AS BIGINT) AS i FROM t
  UNION ALL SELECT user_id, blk, n, a, term * (i + 1) / (i + 2) * cos(a) * cos(a), total + term * (i + 1) / (i + 2) * cos(a) * cos(a), i + 2
  FROM s WHERE i + 2 <= n - 4),
e AS (SELECT user_id, blk, n, a, arg_max(total, i) AS total FROM s GROUP BY user_id, blk, n, a),
p AS (SELECT user_id, blk, CASE WHEN n % 2 = 0 THEN 1 - sin(a) * total WHEN n = 3 THEN 1 - 2 / pi() * a
  ELSE 1 - 2 / pi() * (a + sin(a) * cos(a) * total) END AS p FROM e)
SELECT f.user_id, f.blk, CASE WHEN f.n < 2 THEN NULL WHEN f.n = 2 THEN (CASE WHEN vy > 0 THEN 0.0 ELSE 1.0 END)
  WHEN vy = 0 THEN 1.0 ELSE round(greatest(coalesce(p, 0.0), 0.0), 6) + 0.0 END AS p FROM f LEFT JOIN p USING (user_id, blk)"""


@query("a26_trend_p_value", P_SQL)
def _(spark, d):
    events = table(spark, d, "events").withColumn("blk", F.floor(F.datediff("ts", F.lit("2024-01-01")) / 6).cast("int"))
    numbered = ranks.group_row_number(events, ["user_id", "blk"], ["ts", "event_id"], "x")
    s = numbered.groupBy("user_id", "blk").agg(
        F.count(F.lit(1)).alias("n"), F.var_pop("x").alias("vx"), F.var_pop("value").alias("vy"), F.covar_pop("x", "value").alias("c")
    )
    n, zero = F.col("n"), F.lit(0.0)
    fit = line_fit(n, zero, zero, n * F.col("vx"), n * F.col("c"), n * F.col("vy"))
    return s.select("user_id", "blk", (F.round(fit["p"], 6) + 0.0).alias("p"))


@query("a27_percent_true", rounded_sql(GRP.format(cols="avg(CAST(event_type = 'click' AS DOUBLE)) AS x"), "user_id", "x"))
def _(spark, d):
    return by_user(spark, d, [Agg("AVG", "CAST(event_type = 'click' AS DOUBLE)", name="x")])


@query("a28_entropy_grp", rounded_sql(GRP.format(cols="entropy(event_type) * ln(2) AS x"), "user_id", "x"))
def _(spark, d):
    return by_user(spark, d, [Agg("ENTROPY", "event_type", name="x")])


@query(
    "a28_entropy_win",
    f"""WITH p AS ({PAIRS}), k AS (SELECT event_id, event_type, count(event_type) AS k FROM p GROUP BY ALL),
    s AS (SELECT event_id, sum(k) AS n, sum(CASE WHEN k > 0 THEN k * ln(k) END) AS q FROM k GROUP BY event_id)
    SELECT event_id, CASE WHEN n > 0 THEN round(greatest(ln(n) - q / n, 0), 6) + 0.0 END AS x FROM s""",
)
def _(spark, d):
    out = windows.window_agg(table(spark, d, "events"), ["user_id"], "ts", ["event_id"], [Agg("ENTROPY", "event_type", name="x")], 1, days(10))
    return out.select("event_id", (F.round("x", 6) + 0.0).alias("x"))


@query(
    "a29_most_common",
    """WITH k AS (SELECT o_custkey, o_orderpriority AS p, count(*) AS k FROM orders GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY k DESC, p) AS rn FROM k)
    SELECT o_custkey, string_agg(p, '|' ORDER BY rn) AS top FROM r WHERE rn <= 3 GROUP BY o_custkey""",
)
def _(spark, d):
    # counts first: what is ranked per customer is one row per category
    counts = table(spark, d, "orders").groupBy("o_custkey", F.col("o_orderpriority").alias("p")).agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy("o_custkey").orderBy(F.desc("k"), "p")
    top = counts.withColumn("rn", F.row_number().over(w)).where("rn <= 3")
    listed = top.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("rn", "p"))).alias("l"))
    return listed.select("o_custkey", F.array_join("l.p", "|").alias("top"))


@query(
    "a30_group_by",
    rounded_sql(
        """SELECT o_orderstatus, max(o_totalprice) AS top, stddev_samp(o_totalprice) AS spread,
        string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY o_orderstatus""",
        "o_orderstatus priorities",
        "top spread",
    ),
)
def _(spark, d):
    return rounded(
        table(spark, d, "orders").groupBy("o_orderstatus").agg(
            F.max("o_totalprice").alias("top"),
            F.stddev_samp("o_totalprice").alias("spread"),
            F.array_join(F.sort_array(F.collect_set("o_orderpriority")), ",").alias("priorities"),
        )
    )


@query("a31_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


DESCRIBE = "count mean std min q25 q50 q75 max".split()


@query(
    "a32_describe",
    rounded_sql(
        """SELECT event_type, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
        quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75, max(value) AS max
        FROM events GROUP BY event_type""",
        ["event_type", '"count"'],
        ["mean", "std", '"min"', "q25", "q50", "q75", '"max"'],
    ),
)
def _(spark, d):
    # event types are large groups: quantiles come from the value histogram
    aggs = [Agg("COUNT", "value", name="count"), Agg("AVG", "value", name="mean"), Agg("MIN", "value", name="min"), Agg("MAX", "value", name="max")]
    aggs += [Agg("QUANTILE", "value", name=f"q{p}", param=p / 100) for p in (25, 50, 75)]
    events = table(spark, d, "events")
    spread = events.groupBy("event_type").agg(F.stddev_samp("value").alias("std"))
    return rounded(grouping.group_aggregate(events, ["event_type"], aggs).join(spread, "event_type"))


@query(
    "a33_distinct",
    """SELECT l_returnflag, l_linestatus, (SELECT count(DISTINCT l_partkey) FROM lineitem) AS parts
    FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem) AS q""",
)
def _(spark, d):
    items = table(spark, d, "lineitem")
    parts = items.agg(F.count_distinct("l_partkey").alias("parts"))
    return items.select("l_returnflag", "l_linestatus").dropDuplicates().join(F.broadcast(parts))


@query("a34_global_max", "SELECT o_orderkey FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 180 DAY")
def _(spark, d):
    orders = table(spark, d, "orders")
    cut = orders.agg(F.max("o_orderdate").alias("__max"))
    return orders.join(F.broadcast(cut)).where(F.expr("o_orderdate >= __max - INTERVAL 180 DAY")).select("o_orderkey")
