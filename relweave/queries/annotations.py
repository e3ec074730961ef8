"""C: roles, units, logical types."""

from pyspark.sql import functions as F

from ..operators import roles as R
from .registry import query, table


@query(
    "c1_set_role",
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice, "
    "strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
)
def _(spark, d):
    text = table(spark, d, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "dd/MM/yyyy HH:mm"))
    df = R.set_role(text, "o_custkey", R.CATEGORICAL)
    df = R.set_role(df, ["o_totalprice"], R.NUMERICAL)
    df = R.set_role(df, "o_orderdate", R.TIME_STAMP, time_formats=["%Y-%m-%d", "%d/%m/%Y %H:%M"])
    return df.select("o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query(
    "c2_role_listing",
    """SELECT role, string_agg(col, ',' ORDER BY col) AS cols, (SELECT count(*) FROM orders) AS n FROM (VALUES
    ('join_key', 'o_orderkey'), ('numerical', 'o_totalprice'), ('unused_float', 'o_custkey'),
    ('unused_string', 'o_orderstatus'), ('unused_string', 'o_orderdate'), ('unused_string', 'o_orderpriority')) AS v(role, col)
    GROUP BY role""",
)
def _(spark, d):
    df = R.set_role(R.set_role(table(spark, d, "orders"), "o_orderkey", R.JOIN_KEY), "o_totalprice", R.NUMERICAL)
    listing = [(r, ",".join(sorted(c))) for r, c in R.roles(df).items() if c and r != "unused"]
    total = df.agg(F.count(F.lit(1)).alias("n"))
    return spark.createDataFrame(listing, "role string, cols string").join(F.broadcast(total))


@query("c3_set_unit", "SELECT o_orderkey, o_totalprice AS money FROM orders")
def _(spark, d):
    df = R.set_unit(table(spark, d, "orders"), ["o_totalprice"], "money")
    (column,) = R.units(df)["money"]
    return df.select("o_orderkey", F.col(column).alias("money"))


@query("c4_set_subrole", "SELECT p_partkey, p_type AS code FROM part")
def _(spark, d):
    df = R.set_subroles(table(spark, d, "part"), "p_type", ["include.substring"])
    (column,) = [f.name for f in df.schema.fields if "include.substring" in R.subroles(f)]
    return df.select("p_partkey", F.col(column).alias("code"))


@query(
    "c5_class_targets",
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS DOUBLE) AS "o_orderstatus=F",
    CAST(o_orderstatus = 'O' AS DOUBLE) AS "o_orderstatus=O", CAST(o_orderstatus = 'P' AS DOUBLE) AS "o_orderstatus=P" FROM orders""",
)
def _(spark, d):
    return R.make_target_columns(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus")


@query(
    "c6_logical_types",
    "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, l_tax FROM lineitem",
)
def _(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return R.apply_types(df, {"l_orderkey": "Categorical", "l_linenumber": "Integer", "l_quantity": "IntegerNullable", "l_tax": "Double"})

