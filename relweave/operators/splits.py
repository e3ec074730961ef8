"""Train / validation / test as a lazy string column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import hash_unit
from .ranks import with_row_id


def split_random(keys: list[str], train: float = 0.0, validation: float = 0.0, test: float = 0.0, seed: int = 0) -> Column:
    """Shares decided by a hash of the row's key: stable under repartition and retries."""
    if abs(train + validation + test - 1.0) > 1e-9:
        raise ValueError("the shares must add up to 1")
    u = hash_unit(*keys, seed=seed)
    return F.when(u < train, "train").when(u < train + validation, "validation").otherwise("test")


def split_time(ts: str, test, validation=None) -> Column:
    """Rows from `validation` on are validation, rows from `test` on are test."""
    c = F.col(ts)
    out = F.when(c >= test, "test")
    if validation is not None:
        out = out.when(c >= validation, "validation")
    return out.otherwise("train")


def split_by(col: str, mapping: Mapping) -> Column:
    out = None
    for value, name in mapping.items():
        hit = F.col(col) == F.lit(value)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def split_head(df: DataFrame, order: list[str], share: float, name: str = "split") -> DataFrame:
    """The first share of the ordered rows is train, the rest is test."""
    cut = int(df.count() * share)
    numbered = with_row_id(df, order, "__row")
    return numbered.withColumn(name, F.when(F.col("__row") < cut, "train").otherwise("test")).drop("__row")


def concat(tag: str = "split", **tables: DataFrame) -> DataFrame:
    """Union of named tables, each row tagged with its table's name."""
    out = None
    for name, df in tables.items():
        part = df.withColumn(tag, F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out
