"""P: projection, filter, scalar expressions."""

from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import timecols
from ..operators import ranks, windows
from ..operators import reshape as S
from ..plans import series
from .registry import query, rounded, rounded_sql, table


@query("p1_projection", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice")


@query("p2_drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, d):
    return table(spark, d, "orders").drop("o_orderstatus", "o_orderdate", "o_orderpriority")


@query("p3_rename", "SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation")
def _(spark, d):
    return table(spark, d, "nation").withColumnsRenamed({"n_nationkey": "key", "n_name": "name", "n_regionkey": "region"})


@query(
    "p4_row_filter",
    "SELECT o_orderkey FROM orders WHERE o_totalprice >= 100000 AND NOT (o_orderstatus = 'F') AND o_orderpriority <> '5-LOW'",
)
def _(spark, d):
    cond = (F.col("o_totalprice") >= 100000) & ~(F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW")
    return table(spark, d, "orders").where(cond).select("o_orderkey")


@query(
    "p5_time_range",
    "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'",
)
def _(spark, d):
    low, high = timecols.datetime_literal(1996, 1, 1), timecols.datetime_literal(1998, 7, 1)
    return table(spark, d, "orders").where(f"o_orderdate >= {low} AND o_orderdate < {high}").select("o_orderkey")


@query("p6_split_subset", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def _(spark, d):
    from ..operators.splits import split_time

    split = split_time("o_orderdate", F.expr(timecols.datetime_literal(2000, 1, 1)))
    return table(spark, d, "orders").where(split == "test").select("o_orderkey")


@query("p7_isin", "SELECT event_id FROM events WHERE event_type IN ('click', 'purchase')")
def _(spark, d):
    return S.where_in(table(spark, d, "events"), "event_type", ["click", "purchase"]).select("event_id")


@query("p8_slice", "SELECT event_id FROM events ORDER BY ts, event_id OFFSET 100 LIMIT 5000")
def _(spark, d):
    return ranks.slice_rows(table(spark, d, "events"), ["ts", "event_id"], 100, 5100).select("event_id")


@query("p8_head", "SELECT event_id FROM events ORDER BY ts, event_id LIMIT 50")
def _(spark, d):
    return ranks.slice_rows(table(spark, d, "events"), ["ts", "event_id"], 0, 50).select("event_id")


@query(
    "p9_derived_column",
    rounded_sql(
        "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue, 1 AS id, l_returnflag AS flag FROM lineitem",
        "l_orderkey l_linenumber id flag",
        "revenue",
    ),
)
def _(spark, d):
    df = table(spark, d, "lineitem").withColumns(
        {"revenue": F.col("l_extendedprice") * (1 - F.col("l_discount")), "id": F.lit(1), "flag": F.col("l_returnflag")}
    )
    return rounded(df.select("l_orderkey", "l_linenumber", "id", "flag", "revenue"))


@query(
    "p10_conditional_update",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_totalprice > 250000 THEN 250000 ELSE o_totalprice END AS price FROM orders",
)
def _(spark, d):
    price = E.update("o_totalprice", F.col("o_totalprice") > 250000, 250000.0)
    price = E.update(price, F.col("o_orderstatus") == "F", 0.0)
    return table(spark, d, "orders").select("o_orderkey", price.alias("price"))


@query("p11_boolean_target", "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS DOUBLE) AS target FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", E.equals_target("o_orderstatus", "F").alias("target"))


@query(
    "p12_missing_test",
    "SELECT event_id, CAST(value <= 0 OR value > 100 AS INTEGER) AS missing FROM events",
)
def _(spark, d):
    # zeros become NaN and large values null: both count as missing
    value = F.when(F.col("value") <= 0, float("nan")).when(F.col("value") > 100, None).otherwise(F.col("value"))
    return table(spark, d, "events").select("event_id", E.is_nan(value).cast("int").alias("missing"))


@query("p13_concat", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || '/' || o_orderstatus AS code FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", E.concat_cols("o_custkey", "o_orderstatus", sep="/").alias("code"))


@query("p14_parse_time", "SELECT o_orderkey, epoch_us(o_orderdate) AS micros FROM orders")
def _(spark, d):
    # two formats in one column: the parsers are tried in turn
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss")).otherwise(
        F.date_format("o_orderdate", "MM-dd-yyyy")
    )
    parsed = E.as_ts(text, ["%Y/%m/%d %H:%M:%S", "%m-%d-%Y"])
    return table(spark, d, "orders").select("o_orderkey", F.unix_micros(parsed).alias("micros"))


@query("p15_make_time", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS t FROM orders")
def _(spark, d):
    t = E.make_ts(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"), F.lit(0))
    return table(spark, d, "orders").select("o_orderkey", F.date_format(t, "yyyy-MM-dd HH:mm:ss").alias("t"))


@query(
    "p16_normalise_date",
    "SELECT event_id, strftime(ts, '%d-%m-%Y') || ' ' || CAST(hour(ts) AS VARCHAR) || strftime(ts, ':%M') AS t FROM events",
)
def _(spark, d):
    raw = F.date_format("ts", "d/M/yyyy H:mm")
    return table(spark, d, "events").select("event_id", E.normalise_date(raw).alias("t"))


@query("p17_cast", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, CAST(trunc(o_totalprice) AS INTEGER) AS price FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("cust"), F.col("o_totalprice").cast("int").alias("price")
    )


@query("p18_regex_digits", "SELECT c_custkey, CAST(regexp_extract(c_name, '([0-9]+)', 1) AS BIGINT) AS number FROM customer")
def _(spark, d):
    digits = E.regex_extract("c_name", "([0-9]+)").cast("bigint")
    return table(spark, d, "customer").select("c_custkey", digits.alias("number"))


@query("p19_suffix_int", "SELECT p_partkey, CAST(substr(p_brand, 7) AS INTEGER) AS brand FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", E.suffix_int("p_brand", 6).alias("brand"))


@query(
    "p20_remap",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status FROM orders",
)
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", E.remap("o_orderstatus", {"F": "finished", "O": "open"}).alias("status"))


@query(
    "p21_encode_category",
    """SELECT p_partkey, code FROM part JOIN
    (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS code FROM (SELECT DISTINCT p_name FROM part)) AS k USING (p_name)""",
)
def _(spark, d):
    coded, _ = ranks.encode_category(table(spark, d, "part"), "p_name", "code")
    return coded.select("p_partkey", "code")


@query(
    "p21_code_table",
    "SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS code FROM (SELECT DISTINCT p_name FROM part) AS q",
)
def _(spark, d):
    return ranks.encode_category(table(spark, d, "part"), "p_name", "code")[1]


@query(
    "p22_row_id",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS rowid FROM orders",
)
def _(spark, d):
    return ranks.with_row_id(table(spark, d, "orders"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "rowid")


HASH = """((((((7 * 48271 + (({k} % 2147483647) * 16807) + 11) % 2147483647) * 69621 + 7) % 2147483647)) / 2147483647.0)"""


@query("p23_random_filter", f"SELECT o_orderkey FROM orders WHERE {HASH.format(k='o_orderkey')} < 0.25")
def _(spark, d):
    return table(spark, d, "orders").where(E.hash_unit("o_orderkey", seed=7) < 0.25).select("o_orderkey")


@query(
    "p24_durations",
    "SELECT event_id, epoch_us(ts + INTERVAL 90 MINUTE - INTERVAL 2 DAY) AS micros FROM events",
)
def _(spark, d):
    events = table(spark, d, "events")
    shift = timecols.hours(1) + timecols.minutes(30) - timecols.days(2)
    return events.select("event_id", (F.expr(timecols.order_sql(events, "ts")) + shift).alias("micros"))


@query("p25_fill_non_finite", "SELECT event_id, CASE WHEN value < 5 THEN 0 ELSE value END AS value FROM events")
def _(spark, d):
    v = F.col("value")
    broken = F.when(v < 1, None).when(v < 2, float("nan")).when(v < 3, float("inf")).when(v < 5, float("-inf")).otherwise(v)
    return table(spark, d, "events").select("event_id", E.fill_non_finite(broken).alias("value"))


@query(
    "p26_coalesce",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE CAST(o_custkey AS DOUBLE) END AS value FROM orders",
)
def _(spark, d):
    first = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    return table(spark, d, "orders").select("o_orderkey", E.coalesce_cols(first, F.col("o_custkey").cast("double")).alias("value"))


@query(
    "p27_lag_target",
    "SELECT event_id, lag(value, 12) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS y_lagged FROM events",
)
def _(spark, d):
    return windows.lag_rows(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value", 12, "y_lagged").select(
        "event_id", "y_lagged"
    )


@query(
    "p28_add_original",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders""",
)
def _(spark, d):
    orders = table(spark, d, "orders").drop("o_orderdate")
    features = S.lookup(orders.select("o_orderkey", "o_custkey"), orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), ["o_custkey"])
    return series.add_original(series.drop_target(orders, "o_totalprice"), features.drop("o_custkey"), ["o_orderkey"])
