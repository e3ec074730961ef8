"""J: joins with aggregation, lookups, time bounds."""

from pyspark.sql import functions as F

from ..functions.aggregates import Agg
from ..functions.timecols import days, hours, minutes
from ..operators import grouping, interval, ranks, reshape, windows
from ..operators import roles as R
from ..plans.features import Propositionalizer, fold_lookup
from ..plans.flow import Pipeline
from ..plans.model import MANY_TO_ONE, ONE_TO_ONE, PROPOSITIONALIZATION, DataModel, Join, Placeholder, TimeSeries, View
from ..sources.tables import load_dataset
from .registry import query, rounded, rounded_sql, table


@query(
    "j1_many_to_many",
    rounded_sql(
        """SELECT c_custkey, count(o_orderkey) AS n, sum(o_totalprice) AS total, avg(o_totalprice) AS mean, max(o_totalprice) AS top
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
        "c_custkey n",
        "total mean top",
    ),
)
def _(spark, d):
    aggs = [
        Agg("COUNT", name="n"),
        Agg("SUM", "o_totalprice", name="total"),
        Agg("AVG", "o_totalprice", name="mean"),
        Agg("MAX", "o_totalprice", name="top"),
    ]
    out = grouping.join_aggregate(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders"), aggs, [("c_custkey", "o_custkey")])
    return rounded(out)


@query(
    "j2_key_pairs",
    "SELECT p_partkey, count(l_orderkey) AS n, max(l_quantity) AS top FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey",
)
def _(spark, d):
    aggs = [Agg("COUNT", name="n"), Agg("MAX", "l_quantity", name="top")]
    return grouping.join_aggregate(table(spark, d, "part").select("p_partkey"), table(spark, d, "lineitem"), aggs, [("p_partkey", "l_partkey")])


@query(
    "j3_composite_key",
    """SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, a.l_suppkey, b.n, b.top FROM lineitem a JOIN
    (SELECT l_partkey, l_suppkey, count(*) AS n, max(l_quantity) AS top FROM lineitem GROUP BY 1, 2) b
    ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey""",
)
def _(spark, d):
    items = table(spark, d, "lineitem")
    aggs = [Agg("COUNT", name="n"), Agg("MAX", "l_quantity", name="top")]
    left = items.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return grouping.join_aggregate(left, items, aggs, [("l_partkey", "l_partkey"), ("l_suppkey", "l_suppkey")])


@query(
    "j4_many_to_one",
    """SELECT l_orderkey, l_linenumber, p_brand AS part__p_brand, p_size AS part__p_size, s_nationkey AS supplier__s_nationkey
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def _(spark, d):
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = Join(Placeholder("part"), (("l_partkey", "p_partkey"),), relationship=MANY_TO_ONE)
    supplier = Join(Placeholder("supplier"), (("l_suppkey", "s_suppkey"),), relationship=MANY_TO_ONE)
    out, _ = fold_lookup(items, table(spark, d, "part").select("p_partkey", "p_brand", "p_size"), part)
    out, _ = fold_lookup(out, table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), supplier)
    return out.drop("l_partkey", "l_suppkey")


@query(
    "j5_one_to_one",
    "SELECT doc_id, lang, quality AS labels__quality FROM documents LEFT JOIN labels USING (doc_id)",
)
def _(spark, d):
    join = Join(Placeholder("labels"), (("doc_id", "doc_id"),), relationship=ONE_TO_ONE)
    return fold_lookup(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels").select("doc_id", "quality"), join)[0]


def _orders(spark, d, aggs, **bounds):
    orders = table(spark, d, "orders")
    return rounded(
        interval.range_aggregate(
            orders, orders, aggs, on=[("o_custkey", "o_custkey")], times=("o_orderdate", "o_orderdate"), row_id=["o_orderkey"], **bounds
        )
    )


STATS = [Agg("COUNT", name="n"), Agg("SUM", "o_totalprice", name="total"), Agg("AVG", "o_totalprice", name="mean")]
ORDERS_BEFORE = """SELECT a.o_orderkey, count(b.o_orderkey) AS n, sum(b.o_totalprice) AS total, avg(b.o_totalprice) AS mean
FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey AND {cond} GROUP BY a.o_orderkey"""


@query("j6_as_of", rounded_sql(ORDERS_BEFORE.format(cond="b.o_orderdate <= a.o_orderdate"), "o_orderkey n", "total mean"))
def _(spark, d):
    return _orders(spark, d, STATS)


@query(
    "j6_as_of_two_tables",
    rounded_sql(
        """SELECT a.event_id, count(b.event_id) AS n, sum(b.value) AS total, max(b.ts) IS NULL AS none
        FROM (SELECT * FROM events WHERE event_type = 'purchase') a
        LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') b ON a.user_id = b.user_id AND b.ts <= a.ts GROUP BY a.event_id""",
        "event_id n none",
        "total",
    ),
)
def _(spark, d):
    events = table(spark, d, "events")
    purchases = events.where("event_type = 'purchase'")
    views = events.where("event_type = 'view'").select(F.col("user_id").alias("uid"), F.col("ts").alias("seen"), "value")
    aggs = [Agg("COUNT", name="n"), Agg("SUM", "value", name="total")]
    out = interval.range_aggregate(purchases, views, aggs, on=[("user_id", "uid")], times=("ts", "seen"), row_id=["event_id"])
    return rounded(out.withColumn("none", F.col("n") == 0))


@query(
    "j7_horizon",
    rounded_sql(ORDERS_BEFORE.format(cond="b.o_orderdate + INTERVAL 30 DAY <= a.o_orderdate"), "o_orderkey n", "total mean"),
)
def _(spark, d):
    return _orders(spark, d, STATS, horizon=days(30))


@query(
    "j8_memory",
    rounded_sql(
        ORDERS_BEFORE.format(
            cond="b.o_orderdate <= a.o_orderdate - INTERVAL 10 DAY AND b.o_orderdate > a.o_orderdate - INTERVAL 410 DAY"
        ),
        "o_orderkey n",
        "total mean",
    ),
)
def _(spark, d):
    return _orders(spark, d, STATS, horizon=days(10), memory=days(400))


@query(
    "j9_row_window",
    rounded_sql(
        """SELECT event_id, count(value) OVER w AS n, sum(value) OVER w AS total, min(value) OVER w AS low FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
        "event_id n",
        "total low",
    ),
)
def _(spark, d):
    numbered = ranks.group_row_number(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "row")
    aggs = [Agg("COUNT", name="n"), Agg("SUM", "value", name="total"), Agg("MIN", "value", name="low")]
    return rounded(windows.row_window_agg(numbered, ["user_id"], "row", ["event_id"], aggs, 30))


KEYLESS = """SELECT a.event_id, count(b.event_id) AS n, sum(b.value) AS total, max(b.value) AS top
FROM events a LEFT JOIN events b ON b.ts <= a.ts - INTERVAL 1 HOUR AND b.ts > a.ts - INTERVAL 3 HOUR GROUP BY a.event_id"""


@query("j10_self_join_keyless", rounded_sql(KEYLESS, "event_id n", "total top"))
def _(spark, d):
    aggs = [Agg("COUNT", name="n"), Agg("SUM", "value", name="total"), Agg("MAX", "value", name="top")]
    return rounded(windows.window_agg(table(spark, d, "events"), [], "ts", ["event_id"], aggs, hours(1), hours(2)))


@query(
    "j10_time_series",
    rounded_sql(
        """SELECT a.event_id, count(b.event_id) AS population_history__count, avg(b.value) AS population_history__avg__value
        FROM events a LEFT JOIN events b ON a.user_id = b.user_id
        AND b.ts <= a.ts - INTERVAL 1 HOUR AND b.ts > a.ts - INTERVAL 73 HOUR GROUP BY a.event_id""",
        "event_id population_history__count",
        "population_history__avg__value",
    ),
)
def _(spark, d):
    events = load_dataset(spark, d, ["events"])["events"]
    series = TimeSeries(events, "ts", ["event_id"], on="user_id", horizon=hours(1), memory=days(3))
    learner = Propositionalizer(("COUNT", "AVG")).fit(series, series.full)
    return rounded(learner.transform(series, series.full))


def _lagged(spark, d, allowed: bool):
    events = R.set_role(load_dataset(spark, d, ["events"])["events"], "value", R.TARGET)
    series = TimeSeries(events, "ts", ["event_id"], on="user_id", horizon=hours(6), memory=days(5), lagged_targets=allowed)
    learner = Propositionalizer(("COUNT", "MAX")).fit(series, series.full)
    return rounded(learner.transform(series, series.full))


LAGGED = """SELECT a.event_id, count(b.event_id) AS population_history__count, max(b.value) AS population_history__max__value
FROM events a LEFT JOIN events b ON a.user_id = b.user_id
AND b.ts <= a.ts - INTERVAL 6 HOUR AND b.ts > a.ts - INTERVAL 126 HOUR GROUP BY a.event_id"""


@query("j11_lagged_targets", rounded_sql(LAGGED, "event_id population_history__count", "population_history__max__value"))
def _(spark, d):
    return _lagged(spark, d, True)


@query("j11_targets_hidden", f"SELECT event_id, population_history__count FROM ({LAGGED}) AS q")
def _(spark, d):
    return _lagged(spark, d, False)


@query(
    "j12_snowflake",
    rounded_sql(
        """WITH l AS (SELECT l_orderkey, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY l_orderkey),
        o AS (SELECT o_custkey, o_orderkey, coalesce(n, 0) AS n, q FROM orders LEFT JOIN l ON l_orderkey = o_orderkey)
        SELECT c_custkey, count(o_orderkey) AS orders__count, sum(n) AS orders__sum__orders__lineitem__count,
        avg(q) AS orders__avg__orders__lineitem__sum__l_quantity FROM customer LEFT JOIN o ON o_custkey = c_custkey GROUP BY c_custkey""",
        "c_custkey orders__count",
        "orders__sum__orders__lineitem__count orders__avg__orders__lineitem__sum__l_quantity",
    ),
)
def _(spark, d):
    data = load_dataset(spark, d, ["customer", "orders", "lineitem"])
    items = data["lineitem"].select("l_orderkey", "l_quantity")
    dm = DataModel(Placeholder("population", ("c_custkey",))).add("orders", "lineitem")
    dm.population.join(dm.orders, on=("c_custkey", "o_custkey"))
    dm.orders.join(dm.lineitem, on=("o_orderkey", "l_orderkey"))
    view = View(data["customer"], {"orders": data["orders"].select("o_orderkey", "o_custkey"), "lineitem": items})
    learner = Propositionalizer(("COUNT", "SUM", "AVG"), compare_units=False).fit(dm, view)
    cols = ["orders__count", "orders__sum__orders__lineitem__count", "orders__avg__orders__lineitem__sum__l_quantity"]
    return rounded(learner.transform(dm, view).select("c_custkey", *cols))


@query(
    "j13_role_playing",
    """SELECT n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS people__count,
    (SELECT count(*) FROM customer WHERE c_nationkey = n_regionkey) AS people_2__count FROM nation""",
)
def _(spark, d):
    nation = R.set_role(table(spark, d, "nation"), ["n_nationkey", "n_regionkey"], R.JOIN_KEY)
    people = table(spark, d, "customer").select("c_nationkey")
    dm = DataModel(Placeholder("population", ("n_nationkey",)))
    dm.add(first=Placeholder("people"), second=Placeholder("people"))
    dm.population.join(dm.first, on=("n_nationkey", "c_nationkey"))
    dm.population.join(dm.second, on=("n_regionkey", "c_nationkey"))
    view = View(nation, {"people": people})
    return Propositionalizer(("COUNT",)).fit(dm, view).transform(dm, view)


@query(
    "j14_plain_relation",
    rounded_sql(
        """SELECT o_orderkey, count(l_orderkey) AS lineitem__count, sum(l_quantity) AS lineitem__sum__l_quantity
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""",
        "o_orderkey lineitem__count",
        "lineitem__sum__l_quantity",
    ),
)
def _(spark, d):
    data = load_dataset(spark, d, ["orders", "lineitem"])
    dm = DataModel(Placeholder("population", ("o_orderkey",))).add("lineitem")
    dm.population.join(dm.lineitem, on=("o_orderkey", "l_orderkey"), relationship=PROPOSITIONALIZATION)
    view = View(data["orders"], {"lineitem": data["lineitem"].select("l_orderkey", "l_quantity")})
    return rounded(Propositionalizer(("COUNT", "SUM")).fit(dm, view).transform(dm, view))


@query(
    "j15_strictly_before",
    rounded_sql(ORDERS_BEFORE.format(cond="b.o_orderdate < a.o_orderdate"), "o_orderkey n", "total mean"),
)
def _(spark, d):
    # the pairs themselves are never written out: one tick of horizon makes the bound strict
    return _orders(spark, d, STATS, horizon=1)


@query(
    "j16_merge",
    """SELECT s_suppkey, s_acctbal, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, d):
    nation = table(spark, d, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    region = table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    out = reshape.lookup(table(spark, d, "supplier"), nation, ["s_nationkey"], "inner")
    return reshape.lookup(out, region, ["n_regionkey"]).select("s_suppkey", "s_acctbal", "n_name", "r_name")


AGAIN = """SELECT o_orderkey FROM orders a WHERE {no}EXISTS (SELECT 1 FROM orders b
WHERE b.o_custkey = a.o_custkey AND b.o_orderdate > a.o_orderdate AND b.o_orderdate <= a.o_orderdate + INTERVAL 180 DAY)"""


@query("j17_exists_within", AGAIN.format(no=""))
def _(spark, d):
    return windows.exists_within(table(spark, d, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"], 0, days(180)).select("o_orderkey")


@query("j17_not_exists_within", AGAIN.format(no="NOT "))
def _(spark, d):
    return windows.exists_within(table(spark, d, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"], 0, days(180), anti=True).select("o_orderkey")


@query(
    "j18_rolled_chunks",
    rounded_sql(
        """SELECT a.event_id, count(b.event_id) AS n, min(b.event_id) AS first_id, max(b.event_id) AS last_id, avg(b.value) AS mean,
        median(b.value) AS mid FROM events a LEFT JOIN events b ON a.user_id = b.user_id
        AND b.ts <= a.ts - INTERVAL 30 MINUTE AND b.ts > a.ts - INTERVAL 2910 MINUTE GROUP BY a.event_id""",
        "event_id n first_id last_id",
        "mean mid",
    ),
)
def _(spark, d):
    # a chunk per row is described, not copied
    aggs = [
        Agg("COUNT", name="n"), Agg("MIN", "event_id", name="first_id"), Agg("MAX", "event_id", name="last_id"),
        Agg("AVG", "value", name="mean"), Agg("MEDIAN", "value", name="mid"),
    ]
    out = windows.window_agg(table(spark, d, "events"), ["user_id"], "ts", ["event_id"], aggs, minutes(30), days(2))
    return rounded(out.withColumns({c: F.col(c).cast("bigint") for c in ("first_id", "last_id")}))


@query(
    "j19_rolled_rows",
    rounded_sql(
        """SELECT event_id, count(*) OVER w AS n, avg(value) OVER w AS mean, max(value) OVER w AS top FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 15 PRECEDING AND CURRENT ROW)""",
        "event_id n",
        "mean top",
    ),
)
def _(spark, d):
    aggs = [Agg("COUNT", name="n"), Agg("AVG", "value", name="mean"), Agg("MAX", "value", name="top")]
    return rounded(windows.roll_rows(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], ["event_id"], aggs, 15))


@query(
    "j12_nested_time",
    """WITH h AS (SELECT a.o_orderkey, a.o_custkey, count(b.o_orderkey) AS n FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey
      AND b.o_orderdate + INTERVAL 1 DAY <= a.o_orderdate AND b.o_orderdate + INTERVAL 91 DAY > a.o_orderdate GROUP BY a.o_orderkey, a.o_custkey)
    SELECT c_custkey, CAST(count(h.o_orderkey) AS BIGINT) AS orders, CAST(sum(n) AS DOUBLE) AS prior FROM customer LEFT JOIN h ON h.o_custkey = c_custkey GROUP BY c_custkey""",
)
def _(spark, d):
    # a time bound on an inner join: each order looks back 90 days, customers add up what their orders saw
    data = load_dataset(spark, d, ["customer", "orders"])
    slim = data["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    dm = DataModel(Placeholder("population", ("c_custkey",))).add(orders=Placeholder("orders", ("o_orderkey",)), history=Placeholder("history"))
    dm.population.join(dm.orders, on=("c_custkey", "o_custkey"))
    dm.orders.join(dm.history, on="o_custkey", time_stamps="o_orderdate", horizon=days(1), memory=days(90))
    view = View(data["customer"].select("c_custkey"), {"orders": slim, "history": slim})
    flat = Propositionalizer(("COUNT", "SUM")).fit(dm, view).transform(dm, view)
    return flat.select("c_custkey", F.col("orders__count").cast("long").alias("orders"), F.col("orders__sum__orders__history__count").cast("double").alias("prior"))


@query(
    "j12_lookup_chain",
    """WITH o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
    SELECT o_orderkey, c_mktsegment AS segment, CAST(n AS DOUBLE) AS orders_of_customer FROM orders
    LEFT JOIN customer ON c_custkey = orders.o_custkey LEFT JOIN o ON o.o_custkey = c_custkey""",
)
def _(spark, d):
    # a population lookup that has a join of its own
    data = load_dataset(spark, d, ["customer", "orders"])
    dm = DataModel(Placeholder("population", ("o_orderkey",))).add("customer", "orders")
    dm.population.join(dm.customer, on=("o_custkey", "c_custkey"), relationship=MANY_TO_ONE)
    dm.customer.join(dm.orders, on=("c_custkey", "o_custkey"))
    view = View(data["orders"].select("o_orderkey", "o_custkey"), {"customer": data["customer"].select("c_custkey", "c_mktsegment"), "orders": data["orders"].select("o_custkey")})
    rows = Pipeline(dm).prepared(view)
    return rows.select("o_orderkey", F.col("customer__c_mktsegment").alias("segment"), F.col("customer__customer__orders__count").cast("double").alias("orders_of_customer"))


REPEATED = """SELECT {form} AS form, CASE WHEN a.o_orderpriority <> '1-URGENT' THEN a.o_custkey END AS id, count(b.o_orderkey) AS n, sum(b.o_totalprice) AS total, max(b.o_totalprice) AS most
    FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate <= a.o_orderdate - INTERVAL 1 DAY AND b.o_orderdate > a.o_orderdate - INTERVAL 201 DAY GROUP BY a.o_orderkey, 2"""


@query("j8_repeated_row_ids", rounded_sql(f"{REPEATED.format(form=chr(39) + 'sliding' + chr(39))} UNION ALL {REPEATED.format(form=chr(39) + 'blocks' + chr(39))}", "form id n", "total most"))
def _(spark, d):
    # the row id is null for some rows and shared by others; both forms of the join keep every row
    orders = table(spark, d, "orders").withColumn("id", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")))
    aggs = [Agg("COUNT", name="n"), Agg("SUM", "o_totalprice", name="total"), Agg("MAX", "o_totalprice", name="most")]
    plan = interval.plan_interval(orders, orders, aggs, on=[("o_custkey", "o_custkey")], times=("o_orderdate", "o_orderdate"), row_id=["id"], horizon=days(1), memory=days(200))
    parts = [interval.interval_aggregate(orders, orders, plan, form).select(F.lit(form).alias("form"), "*") for form in ("sliding", "blocks")]
    return rounded(parts[0].unionByName(parts[1]))
