"""Sliding-window features and row-to-row comparisons of ordered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import Agg
from ..functions.timecols import MICROS, order_sql
from . import interval, ranks, skew


def window_agg(
    df: DataFrame, keys: list[str], ts: str, row_id: list[str], aggs: list[Agg], horizon: int = 0, memory: int | None = None
) -> DataFrame:
    """Aggregates of a row's own group over (t - h - m, t - h]."""
    return interval.range_aggregate(
        df, df, aggs, on=[(k, k) for k in keys], times=(ts, ts), row_id=row_id, horizon=horizon, memory=memory
    )


CALENDAR = {
    "weekday": "weekday(`{ts}`)",
    "hour": "hour(`{ts}`)",
    "month": "month(`{ts}`)",
    "minute": "minute(`{ts}`)",
    "year": "year(`{ts}`)",
}


def seasonal_agg(df: DataFrame, keys, ts, row_id, aggs, same: list[str], horizon: int = 0, memory: int | None = None) -> DataFrame:
    """As `window_agg`, over rows that share calendar parts (weekday, hour ...) only."""
    parts = {f"__{p}": F.expr(CALENDAR[p].format(ts=ts)) for p in same}
    return window_agg(df.withColumns(parts), [*keys, *parts], ts, row_id, aggs, horizon, memory)


def lag_value(df: DataFrame, keys, ts, row_id, col: str, delta: int, name: str) -> DataFrame:
    """The last known value `delta` ticks ago."""
    return window_agg(df, keys, ts, row_id, [Agg("LAST", f"`{col}`", name=name)], horizon=delta)


def row_window_agg(df: DataFrame, keys, row_number: str, row_id, aggs, rows: int, offset: int = 0) -> DataFrame:
    """The last `rows` rows by row number, counted back from `offset` rows ago."""
    return window_agg(df, keys, row_number, row_id, aggs, horizon=offset, memory=rows)


def roll_rows(df: DataFrame, keys, order: list[str], row_id, aggs, max_timeshift: int) -> DataFrame:
    """Aggregates of the last max_timeshift + 1 rows of each id."""
    numbered = ranks.group_row_number(df, keys, order, "__rn")
    return row_window_agg(numbered, keys, "__rn", row_id, aggs, max_timeshift + 1)


def lag_rows(df: DataFrame, keys: list[str], order: list[str], col: str, k: int, name: str) -> DataFrame:
    """Value `k` rows earlier in the group (k < 0: later).

    Groups that fit a task use a window. With hot groups, rows are numbered in
    segments and meet by (key, number), which spreads them.
    """
    keyed = df.select(*keys)
    hot, _ = skew.hot_groups(keyed, keys)
    if not hot:
        return df.withColumn(name, F.lag(col, k).over(Window.partitionBy(*keys).orderBy(*order)))
    numbered = ranks.group_row_number(df, keys, order, "__rn")
    earlier = numbered.select(*keys, (F.col("__rn") + k).alias("__rn"), F.col(col).alias(name))
    return numbered.join(earlier, [*keys, "__rn"], "left").drop("__rn")


def diff_prev(df: DataFrame, keys: list[str], order: str, col: str, name: str) -> DataFrame:
    """col - col of the row numbered order - 1; the value itself where that row is missing.

    (keys, order) is unique, so the equi-join has at most one partner and no hot key.
    """
    earlier = df.select(*keys, (F.col(order) + 1).alias(order), F.col(col).alias("__prev"))
    joined = df.join(earlier, [*keys, order], "left")
    return joined.withColumn(name, F.coalesce(F.col(col) - F.col("__prev"), F.col(col))).drop("__prev")


def next_event(df: DataFrame, keys: list[str], ts: str, row_id: list[str], col: str, name: str) -> DataFrame:
    """Smallest `col` among the group's earliest strictly later rows.

    One row per moment of a group knows the next one; hot groups are numbered in segments.
    """
    rows = df.withColumn("__at", F.expr(order_sql(df, ts)))
    first = rows.dropna(subset=[*keys, "__at"]).groupBy(*keys, "__at").agg(F.min(col).alias("__first"))
    following = lag_rows(first, keys, ["__at"], "__first", -1, name).select(*keys, "__at", name)
    return rows.select(*row_id, *[k for k in [*keys, "__at"] if k not in row_id]).join(following, [*keys, "__at"], "left").select(*row_id, name)


def next_is(df: DataFrame, keys, ts, row_id, flag: str, name: str) -> DataFrame:
    """1 where the next later event of the same item carries the 0/1 `flag`, else 0."""
    found = next_event(df, keys, ts, row_id, flag, "__next")
    return found.select(*row_id, F.coalesce(F.col("__next").cast("double"), F.lit(0.0)).alias(name))


def events_between(df: DataFrame, keys, ts, row_id, low: int, high: int, name: str) -> DataFrame:
    """How many rows of the same key lie in (t + low, t + high]."""
    count = [Agg("COUNT", name=name)]
    return window_agg(df, keys, ts, row_id, count, horizon=-high, memory=high - low)


def exists_within(df: DataFrame, keys, ts, row_id, low: int, high: int, anti: bool = False) -> DataFrame:
    """Rows with (or, as anti join, without) another row of the key in (t + low, t + high]."""
    found = events_between(df, keys, ts, row_id, low, high, "__n")
    keep = F.col("__n") == 0 if anti else F.col("__n") > 0
    return df.join(found.where(keep).select(*row_id), row_id, "left_semi")


def churn(df: DataFrame, key: str, ts: str, row_id: list[str], days: int, later_than: bool = False) -> DataFrame:
    """0/1 churn per row, null inside the last `days` of the table.

    Default: 0 when the key returns within `days`. With `later_than`, 0 when it is
    seen again more than `days` later (the two readings of the definition differ).
    """
    span = days * 86400 * MICROS
    order = order_sql(df, ts)
    cut = df.agg(F.expr(f"max({order})").alias("__max"))
    if later_than:
        last = df.groupBy(key).agg(F.expr(f"max({order})").alias("__last"))
        flagged = skew.skew_join(df.where(F.col(key).isNotNull()), last, [key], "left")
        again = F.col("__last") - F.expr(order) > span
    else:
        flagged = df.join(events_between(df, [key], ts, row_id, 0, span, "__n"), row_id, "left")
        again = F.col("__n") > 0
    # one-row table: the global maximum meets every row without a collect
    both = flagged.join(F.broadcast(cut))
    value = F.when(F.expr(order) >= F.col("__max") - span, None).when(again, 0.0).otherwise(1.0)
    return both.withColumn("churn", value).drop("__n", "__last", "__max")
