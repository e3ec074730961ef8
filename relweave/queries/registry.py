"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir
from ..sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a survey id; without SQL only its rows are checked."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, folder, name)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to seven significant digits, so the order of summation does not show.

    Sums of cents can lie exactly between two such numbers; the factor 1 + 2^-26, far
    below the seventh digit, moves them off the middle in the same way on both sides.
    """
    off_middle = F.lit(1.0 + 2.0**-26)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append((c * off_middle).cast("float").cast("double").alias(f.name) if isinstance(f.dataType, T.DoubleType) else c)
    return df.select(*cols)


def rounded_sql(inner: str, keep: list[str] | str, floats: list[str] | str) -> str:
    """The same rounding for the oracle."""
    keep = keep.split() if isinstance(keep, str) else keep
    floats = floats.split() if isinstance(floats, str) else floats
    cols = [*keep, *[f"CAST(CAST({c} * (1 + pow(2, -26)) AS FLOAT) AS DOUBLE) AS {c}" for c in floats]]
    return f"SELECT {', '.join(cols)} FROM ({inner.strip()}) AS q"
