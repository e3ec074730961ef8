"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import roles as R
from ..session import shared_dir


def read_csv(
    spark: SparkSession, paths, sep: str = ",", header: bool = True, names: list[str] | None = None, schema=None, nulls: str = "NULL"
) -> DataFrame:
    """One or several CSV files. A schema saves the extra pass that infers types."""
    reader = spark.read.options(header=header, sep=sep, nullValue=nulls)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(paths)
    return df.toDF(*names) if names else df


def read_jdbc(
    spark: SparkSession, url: str, table: str, props: dict[str, str], column: str | None = None, bounds=None, partitions: int = 64
) -> DataFrame:
    """Database table; with `column` and `bounds` read in parallel ranges."""
    if column is None:
        return spark.read.jdbc(url, table, properties=props)
    low, high = bounds
    return spark.read.jdbc(
        url, table, column=column, lowerBound=low, upperBound=high, numPartitions=partitions, properties=props
    )


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _named(project: str | None, name: str) -> str:
    return f"{project}.{name}" if project else name


def save_table(df: DataFrame, name: str, project: str | None = None) -> DataFrame:
    """Store rows as a catalog table in the shared folder and return the stored table."""
    spark = df.sparkSession
    full = _named(project, name)
    path = f"{shared_dir(spark)}/tables/{project or 'default'}/{name}"
    df.write.mode("overwrite").option("path", path).saveAsTable(full)
    return spark.table(full)


def load_or_create(spark: SparkSession, name: str, build: Callable[[], DataFrame], project: str | None = None) -> DataFrame:
    """The stored table if there is one; otherwise build, store and return it."""
    full = _named(project, name)
    if spark.catalog.tableExists(full):
        return spark.table(full)
    return save_table(build(), name, project)


def from_pandas(spark: SparkSession, pdf, roles: dict[str, str] | None = None) -> DataFrame:
    df = spark.createDataFrame(pdf)
    for column, role in (roles or {}).items():
        df = R.set_role(df, column, role)
    return df


def to_pandas(df: DataFrame, max_rows: int = 1_000_000):
    """Rows as a local frame (Arrow). Refused when there are too many for the driver."""
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows: aggregate first or write a table")
    return rows


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. `single_file` is for small result tables only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


class Project:
    """A namespace for stored tables."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{shared_dir(spark)}/tables/{name}.db'")

    def tables(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.name) if not t.isTemporary)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        return save_table(df, name, self.name)

    def load_or_create(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return load_or_create(self.spark, name, build, self.name)


# fixed values: roles and units of the prepared dataset
DATASET_ROLES = {
    "customer": {"c_custkey": R.JOIN_KEY, "c_nationkey": R.JOIN_KEY, "c_acctbal": R.NUMERICAL, "c_mktsegment": R.CATEGORICAL},
    "orders": {
        "o_orderkey": R.JOIN_KEY, "o_custkey": R.JOIN_KEY, "o_totalprice": R.NUMERICAL, "o_orderdate": R.TIME_STAMP,
        "o_orderstatus": R.CATEGORICAL, "o_orderpriority": R.CATEGORICAL,
    },
    "lineitem": {
        "l_orderkey": R.JOIN_KEY, "l_partkey": R.JOIN_KEY, "l_suppkey": R.JOIN_KEY, "l_quantity": R.NUMERICAL,
        "l_extendedprice": R.NUMERICAL, "l_discount": R.NUMERICAL, "l_tax": R.NUMERICAL, "l_returnflag": R.CATEGORICAL,
        "l_linestatus": R.CATEGORICAL, "l_shipdate": R.TIME_STAMP,
    },
    "part": {
        "p_partkey": R.JOIN_KEY, "p_brand": R.CATEGORICAL, "p_type": R.CATEGORICAL, "p_name": R.TEXT, "p_size": R.NUMERICAL,
        "p_retailprice": R.NUMERICAL,
    },
    "supplier": {"s_suppkey": R.JOIN_KEY, "s_nationkey": R.JOIN_KEY, "s_acctbal": R.NUMERICAL},
    "nation": {"n_nationkey": R.JOIN_KEY, "n_regionkey": R.JOIN_KEY, "n_name": R.CATEGORICAL},
    "region": {"r_regionkey": R.JOIN_KEY, "r_name": R.CATEGORICAL},
    "events": {
        "event_id": R.JOIN_KEY, "user_id": R.JOIN_KEY, "ts": R.TIME_STAMP, "event_type": R.CATEGORICAL, "value": R.NUMERICAL,
    },
    "documents": {"doc_id": R.JOIN_KEY, "text": R.TEXT, "lang": R.CATEGORICAL, "source": R.CATEGORICAL, "n_chars": R.NUMERICAL},
    "labels": {"doc_id": R.JOIN_KEY, "quality": R.TARGET, "toxic": R.TARGET},
}
DATASET_UNITS = {
    ("customer", "c_acctbal"): "money",
    ("orders", "o_totalprice"): "money",
    ("lineitem", "l_extendedprice"): "money",
    ("part", "p_retailprice"): "money",
    ("part", "p_type"): "code",
}


def load_dataset(spark: SparkSession, folder: str, tables=None, roles: bool = True, units: bool = True) -> dict[str, DataFrame]:
    """The tables of a folder, annotated with roles and units."""
    out = {}
    for name in tables or DATASET_ROLES:
        df = read_table(spark, folder, name)
        if roles:
            for column, role in DATASET_ROLES.get(name, {}).items():
                df = R.set_role(df, column, role)
        if units:
            for (table, column), unit in DATASET_UNITS.items():
                if table == name:
                    df = R.set_unit(df, column, unit)
        out[name] = df
    return out
