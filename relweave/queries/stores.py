"""S: sources, sinks, catalog."""

from pyspark.sql import functions as F

from ..functions.aggregates import Agg
from ..functions.timecols import days
from ..operators import interval
from ..plans.features import Propositionalizer
from ..plans.model import MANY_TO_ONE, DataModel, Placeholder, View
from ..sources import scripts, tables
from .registry import query, rounded, rounded_sql, scratch, table

ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
ORDER_SCHEMA = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"


@query("s1_csv_scan", ORDERS)
def _(spark, d):
    path = scratch(spark, "s1")
    part = table(spark, d, "orders").select(*ORDER_COLS)
    # two files without header and another separator, read together under given names
    part.where("o_orderstatus = 'F'").write.option("sep", ";").csv(f"{path}/a")
    part.where("o_orderstatus <> 'F'").write.option("sep", ";").csv(f"{path}/b")
    schema = "a BIGINT, b BIGINT, c STRING, d DOUBLE"
    return tables.read_csv(spark, [f"{path}/a", f"{path}/b"], sep=";", header=False, names=ORDER_COLS, schema=schema)


@query("s3_load_or_create", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def _(spark, d):
    name = f"counts_{abs(hash(d)) % 10**8}_{scratch(spark, 's3')[-12:]}"
    build = lambda: table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    tables.load_or_create(spark, name, build)
    return tables.load_or_create(spark, name, lambda: build().limit(0))  # the stored rows win


@query("s5_register", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def _(spark, d):
    tables.register(table(spark, d, "orders"), "registered_orders")
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM registered_orders GROUP BY o_orderstatus")


FEATURE_TABLE = """
SELECT c.c_custkey, count(o.o_orderkey) AS orders__count, avg(o.o_totalprice) AS orders__avg__o_totalprice
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey
"""


def _customer_model(spark, d):
    data = tables.load_dataset(spark, d, ["customer", "orders", "lineitem", "part"])
    dm = DataModel(Placeholder("population", ("c_custkey",))).add("orders", "lineitem", "part")
    dm.population.join(dm.orders, on=("c_custkey", "o_custkey"))
    return dm, View(data["customer"], {"orders": data["orders"]}), data


@query("s6_feature_table", rounded_sql(FEATURE_TABLE, "c_custkey orders__count", "orders__avg__o_totalprice"))
def _(spark, d):
    dm, view, _ = _customer_model(spark, d)
    learner = Propositionalizer(("COUNT", "AVG"), compare_units=False).fit(dm, view)
    name = f"features_{scratch(spark, 's6')[-12:]}"
    tables.save_table(learner.transform(dm, view), name)
    return rounded(spark.sql(f"SELECT c_custkey, orders__count, orders__avg__o_totalprice FROM {name}"))


SCRIPT_SQL = """
WITH l AS (
  SELECT l_orderkey, sum(l_quantity) AS q, count(*) AS n, avg(p_size) AS ps FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
o AS (SELECT orders.*, coalesce(l.n, 0) AS n, l.q, l.ps FROM orders LEFT JOIN l ON l_orderkey = o_orderkey)
SELECT c_custkey, count(o_orderkey) AS orders__count, avg(q) AS orders__avg__orders__lineitem__sum__l_quantity,
  avg(n) AS orders__avg__orders__lineitem__count, sum(ps) AS orders__sum__orders__lineitem__avg__part__p_size,
  median(o_totalprice) AS orders__median__o_totalprice
FROM customer LEFT JOIN o ON c_custkey = o_custkey GROUP BY c_custkey
"""
SCRIPT_COLS = [
    "orders__avg__orders__lineitem__sum__l_quantity",
    "orders__avg__orders__lineitem__count",
    "orders__sum__orders__lineitem__avg__part__p_size",
    "orders__median__o_totalprice",
]


@query("s7_s8_sql_scripts", rounded_sql(SCRIPT_SQL, ["c_custkey", "orders__count"], SCRIPT_COLS))
def _(spark, d):
    dm, view, data = _customer_model(spark, d)
    dm.orders.join(dm.lineitem, on=("o_orderkey", "l_orderkey"))
    dm.lineitem.join(dm.part, on=("l_partkey", "p_partkey"), relationship=MANY_TO_ONE)
    view = View(data["customer"], {k: data[k] for k in ("orders", "lineitem", "part")})
    # only the scripts are wanted: the inner features are theirs to compute, once they are read
    learner = Propositionalizer(("COUNT", "AVG", "SUM", "MEDIAN"), compare_units=False, shared=False).fit(dm, view)
    folder = scratch(spark, "scripts")
    statements = scripts.feature_scripts(learner, dm, view, "customer")
    scripts.save_scripts(spark, statements, folder, remove=True)
    with scripts.own_views(spark):
        for name, df in data.items():
            tables.register(df, name)
        scripts.run_sql_folder(spark, folder)
        return rounded(spark.table("FEATURES").select("c_custkey", "orders__count", *SCRIPT_COLS))


@query(
    "s7_window_scripts",
    rounded_sql(
        """SELECT a.o_orderkey, count(b.o_orderkey) AS orders__count, sum(b.o_totalprice) AS orders__sum__o_totalprice,
        median(b.o_totalprice) AS orders__median__o_totalprice
        FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey
        AND b.o_orderdate <= a.o_orderdate - INTERVAL 1 DAY AND b.o_orderdate > a.o_orderdate - INTERVAL 366 DAY
        GROUP BY a.o_orderkey""",
        "o_orderkey orders__count",
        "orders__sum__o_totalprice orders__median__o_totalprice",
    ),
)
def _(spark, d):
    data = tables.load_dataset(spark, d, ["orders"])
    dm = DataModel(Placeholder("population", ("o_orderkey",))).add("orders")
    dm.population.join(dm.orders, on="o_custkey", time_stamps="o_orderdate", horizon=days(1), memory=days(365))
    view = View(data["orders"], data)
    learner = Propositionalizer(("COUNT", "SUM", "MEDIAN"), compare_units=False).fit(dm, view)
    folder = scratch(spark, "scripts")
    scripts.save_scripts(spark, scripts.feature_scripts(learner, dm, view, "orders"), folder)
    with scripts.own_views(spark):
        tables.register(data["orders"], "orders")
        scripts.run_sql_folder(spark, folder)
        return rounded(
            spark.table("FEATURES").select("o_orderkey", "orders__count", "orders__sum__o_totalprice", "orders__median__o_totalprice")
        )


@query("s9_csv_sink", ORDERS)
def _(spark, d):
    path = scratch(spark, "s9")
    tables.write_csv(table(spark, d, "orders").select(*ORDER_COLS), path)
    return tables.read_csv(spark, path, schema=ORDER_SCHEMA)


@query("s10_project", "SELECT 'orders_copy' AS table_name, count(*) AS n FROM orders")
def _(spark, d):
    project = tables.Project(spark, f"project_{scratch(spark, 's10')[-12:]}")
    project.save(table(spark, d, "orders").select("o_orderkey"), "orders_copy")
    (name,) = project.tables()
    return spark.table(f"{project.name}.{name}").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))


@query(
    "s11_prepared_dataset",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
)
def _(spark, d):
    orders = tables.load_dataset(spark, d, ["orders"])["orders"]
    by_role = {f.name: f.metadata["role"] for f in orders.schema.fields}
    return orders.select("o_orderkey", *[c for c, r in by_role.items() if r in ("numerical",)], "o_orderpriority")


FLAGSHIP = """
SELECT a.o_orderkey, count(b.o_orderkey) AS n_prior, sum(b.o_totalprice) AS sum_prior, avg(b.o_totalprice) AS avg_prior
FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey
AND b.o_orderdate <= a.o_orderdate - INTERVAL 1 DAY AND b.o_orderdate > a.o_orderdate - INTERVAL 91 DAY
GROUP BY a.o_orderkey
"""


@query("flagship_prior_orders", rounded_sql(FLAGSHIP, "o_orderkey n_prior", "sum_prior avg_prior"))
def flagship(spark, d):
    orders = table(spark, d, "orders")
    aggs = [
        Agg("COUNT", name="n_prior"),
        Agg("SUM", "o_totalprice", name="sum_prior"),
        Agg("AVG", "o_totalprice", name="avg_prior"),
    ]
    return rounded(
        interval.range_aggregate(
            orders, orders, aggs, on=[("o_custkey", "o_custkey")], times=("o_orderdate", "o_orderdate"),
            row_id=["o_orderkey"], horizon=days(1), memory=days(90),
        )
    )
