"""Filters by sets, lookups, unpivot / pivot, unions, sorts and top-n."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import skew

INLINE_VALUES = 1000


def where_in(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose value is listed; long lists become a semi join."""
    values = list(values)
    if len(values) <= INLINE_VALUES:
        return df.where(F.col(column).isin(values))
    listed = df.sparkSession.createDataFrame([(v,) for v in values], df.select(column).schema)
    return df.join(listed, column, "left_semi")


def lookup(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", check: bool = False) -> DataFrame:
    """many-to-one or one-to-one: `right` has at most one row per key."""
    if check and right.groupBy(*on).count().where("count > 1").limit(1).count():
        raise ValueError(f"the lookup key {on} is not unique")
    return skew.skew_join(left, right, on, how)


def melt(df: DataFrame, ids: list[str], values: list[str], variable: str, value: str) -> DataFrame:
    return df.unpivot(ids, values, variable, value)


def pivot(df: DataFrame, ids: list[str], column: str, values: list, aggregates) -> DataFrame:
    """Long -> wide. The new columns are named, so no job is needed to find them."""
    return df.groupBy(*ids).pivot(column, values).agg(*aggregates)


def top_k(df: DataFrame, column: str, k: int, ties: list[str]) -> DataFrame:
    """Largest k; `ties` make the choice among equals definite."""
    return df.orderBy(F.desc(column), *ties).limit(k)


def shuffle(df: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Repeatable random order by the hash of the key: a range-partitioned sort."""
    return df.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys)


def column_concat(frames: list[DataFrame], keys: list[str], drop: Iterable[str] = ()) -> DataFrame:
    """Tables over the same rows side by side, matched by key; later columns win."""
    dropped = set(drop)

    def merge(a: DataFrame, b: DataFrame) -> DataFrame:
        again = [c for c in b.columns if c in a.columns and c not in keys]
        return a.drop(*again).join(b, keys)

    return reduce(merge, [f.drop(*[c for c in dropped if c not in keys]) for f in frames])


def series_to_relational(long: DataFrame, key: str, label: str, order: str, value: str) -> tuple[DataFrame, DataFrame]:
    """One long table -> one row per series with its label, and the signal rows."""
    population = long.groupBy(key).agg(F.max(label).alias(label))
    return population, long.select(key, order, value)


def label_benchmark(df: DataFrame, group: str, tool: str, runtime: str, features: str, base: str) -> DataFrame:
    """Runtime table per group: features per second, and runtime relative to the base tool."""
    own = df.withColumn("features_per_second", F.try_divide(F.col(features), F.col(runtime)))
    own = own.withColumn("__per", F.try_divide(F.col(runtime), F.col(features)))
    ref = own.where(F.col(tool) == base).select(group, F.col(runtime).alias("__rt"), F.col("__per").alias("__rp"))
    both = lookup(own, ref, [group])
    return both.select(
        group,
        tool,
        runtime,
        features,
        "features_per_second",
        F.try_divide(F.col(runtime), F.col("__rt")).alias("normalized_runtime"),
        F.try_divide(F.col("__per"), F.col("__rp")).alias("normalized_runtime_per_feature"),
    )


def read_benchmarks(spark, paths, schema: str, tool: str, values: list[str], measures: list[str]) -> DataFrame:
    """Result files, tagged with the file's name, one column per tool and measure."""
    rows = spark.read.option("header", True).schema(schema).csv(paths)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.csv)?(?:/part-[^/]*)?$", 1)
    tagged = rows.withColumn("dataset", name)
    return pivot(tagged, ["dataset"], tool, values, [F.max(m).alias(m) for m in measures])
