"""Many-to-many join without time bounds: aggregate the right side by its key first.

Mergeable aggregates are one GROUP BY with partial aggregation on the map side.
Holistic ones start from the value histogram ``(key, value, count)``, which is such a
GROUP BY too, so a hot key is spread over its values instead of one task.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.aggregates import COUNT_LIKE, HISTOGRAM, MERGEABLE, STATES, Agg
from ..functions.timecols import order_sql, ticks_per_unit
from ..session import plan_bytes
from . import skew

CHUNK = 200  # aggregate expressions per statement, keeps generated code compilable
ONE_SPLIT = 128 * 2**20
WIDE = 4  # states a row from which it is looked at what they cost


def grouped_sql(keys: list[str], aggs: list[Agg], order: str | None = None, unit: int = 1, source: str = "right_rows") -> str:
    """Spark SQL text of all mergeable aggregates of one relation."""
    values: dict[str, str] = {}
    states: dict[tuple, str] = {}
    finals = []
    for agg in aggs:
        spec = MERGEABLE[agg.func]
        if spec.needs_now:
            raise ValueError(f"{agg.func} compares with the time of the left row: join with time stamps")
        if spec.needs_time and order is None:
            raise ValueError(f"{agg.func} needs a time stamp on the right side")
        value = f"CAST({agg.value_sql} AS DOUBLE)" if spec.numeric else agg.value_sql
        x = values.setdefault(value, f"__x{len(values)}")
        if spec.grouped:
            name = states.setdefault((spec.grouped.format(x=x),), f"__s{len(states)}")
            finals.append(f"{name} AS `{agg.alias}`")
            continue
        names = {}
        for state in spec.states:
            rows = STATES[state][0].format(x=x, t="__o", c="0D", d="0D", p="1D")
            names[state] = states.setdefault((rows,), f"__s{len(states)}")
        finals.append(f"{spec.final.format(c='0D', u=f'{unit}D', now='NULL', **names)} AS `{agg.alias}`")
    cols = ", ".join(f"`{k}`" for k in keys)
    xs = "".join(f", {v} AS {x}" for v, x in values.items())
    o = f", {order} AS __o" if order else ""
    lead = f"{cols}, " if keys else ""
    present = " AND ".join(f"`{k}` IS NOT NULL" for k in keys) or "TRUE"
    group = f" GROUP BY {cols}" if keys else ""
    inner = f"SELECT {lead}{', '.join(f'{k[0]} AS {n}' for k, n in states.items())} FROM (SELECT {lead}{(xs + o)[2:]} FROM {source} WHERE {present}){group}"
    return f"SELECT {lead}{', '.join(finals)} FROM ({inner})"


def value_histogram(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, __cid, __v, __k): each distinct non-null value of column number cid and its count.

    All columns are counted in one pass over the rows.
    """
    cells = [F.struct(F.lit(i).alias("__cid"), F.expr(v).alias("__v")) for i, v in enumerate(values)]
    long = df.select(*keys, F.inline(F.array(*cells))).dropna(subset=[*keys, "__v"])
    return long.groupBy(*keys, "__cid", "__v").agg(F.count(F.lit(1)).alias("__k"))


def group_quantiles(hist: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group from a histogram.

    Ranks are cumulative counts. Large inputs are cut at global quantiles of the value,
    so that no (group, cut) piece holds more than a small share of all rows however
    the groups are sized; pieces then only exchange their totals.
    """
    cuts = _value_cuts(hist)
    if not cuts:
        w = _window(keys)
        ranked = hist.select(
            *keys,
            "__v",
            "__k",
            F.sum("__k").over(w.orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)).alias("__hi"),
            F.sum("__k").over(w).alias("__n"),
        )
    else:
        piece = F.array_size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("__v")))
        rows = hist.withColumn("__p", piece)
        wp = _window(keys)
        totals = rows.groupBy(*keys, "__p").agg(F.sum("__k").alias("__t"))
        totals = totals.select(
            *keys,
            "__p",
            (F.sum("__t").over(wp.orderBy("__p").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__t")).alias("__before"),
            F.sum("__t").over(wp).alias("__n"),
        )
        w = _window([*keys, "__p"])
        running = rows.withColumn("__hi", F.sum("__k").over(w.orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)))
        ranked = running.join(totals, [*keys, "__p"]).withColumn("__hi", F.col("__hi") + F.col("__before"))
    exprs = []
    for name, p in shares.items():
        pos = F.lit(float(p)) * (F.col("__n") - 1)
        for edge, rank in (("lo", F.floor(pos)), ("up", F.ceil(pos))):
            hit = (rank < F.col("__hi")) & (rank >= F.col("__hi") - F.col("__k"))
            exprs.append(F.max(F.when(hit, F.col("__v").cast("double"))).alias(f"{name}__{edge}"))
    found = ranked.groupBy(*keys).agg(F.max("__n").alias("__n"), *exprs)
    out = []
    for name, p in shares.items():
        pos = F.lit(float(p)) * (F.col("__n") - 1)
        low, up = F.col(f"{name}__lo"), F.col(f"{name}__up")
        out.append((low + (pos - F.floor(pos)) * (up - low)).alias(name))
    return found.select(*keys, *out)


def _window(cols: list[str]) -> WindowSpec:
    return Window.partitionBy(*cols)


def _value_cuts(hist: DataFrame) -> list:
    size, limit = plan_bytes(hist), skew.hot_rows(hist.sparkSession)
    if size <= limit:
        return []
    n = min(skew.MAX_SEGMENTS, -(-size // limit))
    grid = [i / n for i in range(1, n)]
    found = hist.agg(F.percentile_approx("__v", grid, 20000)).first()[0]
    return sorted(set(found or []))


def histogram_sql(keys: list[str], aggs: list[Agg], source: str, dtype: str, deal: bool = False) -> str:
    """All holistic aggregates over columns of one type, from one value histogram.

    With `deal`, rows are dealt by key before every column becomes a row of its own: all steps below
    find them in place, and nothing is shuffled per column and value.
    """
    cols = ", ".join(f"`{k}`" for k in keys)
    group = f"{cols}, __cid"
    values = list(dict.fromkeys(a.value_sql for a in aggs))
    stats: dict[str, str] = {}
    wide = []
    for a in aggs:
        p = _share(a)
        if p is not None:
            pos = f"({p!r}D * (__n - 1))"
            low = f"max(CASE WHEN floor{pos} < __hi AND floor{pos} >= __hi - __k THEN __v END)"
            up = f"max(CASE WHEN ceil{pos} < __hi AND ceil{pos} >= __hi - __k THEN __v END)"
            text = f"{low} + (max{pos} - floor(max{pos})) * ({up} - {low})"
        elif a.func in ("COUNT_ABOVE_MEAN", "COUNT_BELOW_MEAN"):
            text = f"sum(CASE WHEN __v {'>' if a.func == 'COUNT_ABOVE_MEAN' else '<'} __mean THEN __k ELSE 0 END)"
        else:
            text = HISTOGRAM[a.func]
        stat = stats.setdefault(text, f"__s{len(stats)}")
        wide.append(f"max(CASE WHEN __cid = {values.index(a.value_sql)} THEN {stat} END) AS `{a.alias}`")
    needs_mean = any(a.func in ("COUNT_ABOVE_MEAN", "COUNT_BELOW_MEAN") for a in aggs)
    whole = f"OVER (PARTITION BY {group})"
    mean = f", sum(__v * __k) {whole} / sum(__k) {whole} AS __mean" if needs_mean else ""
    cells = ", ".join(f"struct({i} AS __cid, CAST({v} AS {dtype}) AS __v)" for i, v in enumerate(values))
    if deal:
        own = ", ".join(f"{v} AS __w{i}" for i, v in enumerate(values))
        source = f"(SELECT /*+ REPARTITION({cols}) */ {cols}, {own} FROM {source} WHERE {' AND '.join(f'`{k}` IS NOT NULL' for k in keys)})"
        cells = ", ".join(f"struct({i} AS __cid, CAST(__w{i} AS {dtype}) AS __v)" for i in range(len(values)))
    hist = (
        f"SELECT {group}, __v, count(*) AS __k FROM (SELECT {cols}, inline(array({cells})) FROM {source})"
        f" WHERE __v IS NOT NULL GROUP BY {group}, __v"
    )
    ranked = (
        f"SELECT {group}, __v, __k, sum(__k) OVER (PARTITION BY {group} ORDER BY __v) AS __hi,\n"
        f"  sum(__k) {whole} AS __n{mean}\n  FROM ({hist})"
    )
    per_column = f"SELECT {group}, {', '.join(f'{t} AS {n}' for t, n in stats.items())}\n  FROM ({ranked}) GROUP BY {group}"
    return f"SELECT {cols}, {', '.join(wide)}\n  FROM ({per_column}) GROUP BY {cols}"


def group_aggregate(df: DataFrame, keys: list[str], aggs: list[Agg], time: str | None = None) -> DataFrame:
    """One row per key, one column per aggregate; at most a handful of passes over `df`."""
    order = order_sql(df, time) if time else None
    unit = ticks_per_unit(df, time) if time else 1
    parts = []
    mergeable = [a for a in aggs if a.mergeable]
    holistic = [a for a in aggs if not a.mergeable]
    if keys and plan_bytes(df) <= ONE_SPLIT:
        # possibly a single row group, read by one task: spread the rows, which also serves every grouping below
        used = _used_columns(df, [*[f"`{k}`" for k in keys], *[a.value_sql for a in aggs], *([order] if order else [])])
        df = df.select(*used).repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)
    rows = df
    if keys and plan_bytes(df) > ONE_SPLIT and len(mergeable) >= WIDE:
        used = _used_columns(df, [*[f"`{k}`" for k in keys], *[a.value_sql for a in mergeable], *([order] if order else [])])
        if _deal_first(df, keys, len(keys) + sum(len(MERGEABLE[a.func].states) for a in mergeable), len(used)):
            rows = df.select(*used).dropna(subset=keys).repartition(*[F.col(f"`{k}`") for k in keys])
    for start in range(0, len(mergeable), CHUNK):
        parts.append(_run(rows, grouped_sql(keys, mergeable[start : start + CHUNK], order, unit, "__rows__")))
    if holistic:
        if not mergeable:
            parts.append(df.select(*keys).dropna().distinct())
        types = df.select(*[F.expr(a.value_sql).alias(str(i)) for i, a in enumerate(holistic)]).schema.fields
        numeric = [a for a, f in zip(holistic, types) if isinstance(f.dataType, T.NumericType)]
        other = [a for a, f in zip(holistic, types) if not isinstance(f.dataType, T.NumericType)]
        if numeric:
            parts.append(_holistic(df, keys, numeric, "DOUBLE"))
        if other:
            parts.append(_holistic(df, keys, other, "STRING"))
    if not parts:
        parts.append(df.select(*keys).dropna().distinct())
    out = reduce(lambda a, b: a.join(b, keys, "left"), parts)
    counts = [a.alias for a in aggs if a.func in COUNT_LIKE]
    return out.fillna(0, subset=counts).select(*keys, *[F.col(f"`{a.alias}`") for a in aggs])


def _deal_first(df: DataFrame, keys: list[str], states: int, columns: int) -> bool:
    """Whether the rows themselves are less to shuffle than the states of the groups that tasks meet.

    Where keys repeat little within a task, partial aggregation leaves as many rows as before, each
    as wide as all states. Rows of hot keys are never dealt. Looked at once a frame.
    """
    known = df.__dict__.setdefault("_deal_first", {})
    if (*keys, states, columns) not in known:
        known[*keys, states, columns] = _rows_are_less(df, keys, states, columns)
    return known[*keys, states, columns]


def _rows_are_less(df: DataFrame, keys: list[str], states: int, columns: int) -> bool:
    keyed = df.select(*[F.col(f"`{k}`") for k in keys]).dropna()
    met = keyed.groupBy(F.spark_partition_id().alias("__p")).agg(F.count(F.lit(1)).alias("__n"), F.approx_count_distinct(F.xxhash64(*[F.col(f"`{k}`") for k in keys])).alias("__d"))
    row = met.agg(F.sum("__n"), F.sum("__d")).first()
    return (row[0] or 0) * columns < (row[1] or 0) * states and not skew.hot_groups(keyed, keys)[0]


def _run(df: DataFrame, text: str) -> DataFrame:
    text = text.replace("{", "{{").replace("}", "}}").replace("__rows__", "{rows}")
    return df.sparkSession.sql(text, rows=df)


def _used_columns(df: DataFrame, texts: list[str]) -> list[str]:
    """Columns that occur in SQL texts, quoted or as bare words."""
    words = {w for t in texts for w in re.findall(r"`([^`]+)`|(\w+)", t) for w in w if w}
    return [f"`{c}`" for c in df.columns if c in words]


def _holistic(df: DataFrame, keys: list[str], aggs: list[Agg], dtype: str) -> DataFrame:
    if plan_bytes(df) <= skew.hot_rows(df.sparkSession):
        return _run(df, histogram_sql(keys, aggs, "__rows__", dtype))  # no group can be hot
    values = list(dict.fromkeys(a.value_sql for a in aggs))
    hist = value_histogram(df, keys, [f"CAST({v} AS {dtype})" for v in values])
    group = [*keys, "__cid"]
    direct = sorted({a.func for a in aggs if HISTOGRAM[a.func]})
    parts = [hist.groupBy(*group).agg(*[F.expr(HISTOGRAM[f]).alias(f) for f in direct])] if direct else []
    shares = {_share_name(a): _share(a) for a in aggs if _share(a) is not None}
    if shares:
        parts.append(group_quantiles(hist, group, shares))
    around = sorted({a.func for a in aggs} & {"COUNT_ABOVE_MEAN", "COUNT_BELOW_MEAN"})
    if around:
        means = hist.groupBy(*group).agg((F.sum(F.col("__v") * F.col("__k")) / F.sum("__k")).alias("__mean"))
        exprs = []
        for func in around:
            side = F.col("__v") > F.col("__mean") if func == "COUNT_ABOVE_MEAN" else F.col("__v") < F.col("__mean")
            exprs.append(F.sum(F.when(side, F.col("__k")).otherwise(0)).alias(func))
        parts.append(skew.skew_join(hist, means, group, "inner").groupBy(*group).agg(*exprs))
    stats = reduce(lambda a, b: a.join(b, group, "left"), parts)
    wide = []
    for a in aggs:
        stat = a.func if _share(a) is None else _share_name(a)
        wide.append(F.max(F.when(F.col("__cid") == values.index(a.value_sql), F.col(stat))).alias(a.alias))
    return stats.groupBy(*keys).agg(*wide)


def _share(agg: Agg) -> float | None:
    return {"MEDIAN": 0.5, "QUANTILE": agg.param}.get(agg.func)


def _share_name(agg: Agg) -> str:
    return f"q{_share(agg)}".replace(".", "_")


def join_aggregate(left: DataFrame, right: DataFrame, aggs: list[Agg], on: list[tuple[str, str]], time: str | None = None) -> DataFrame:
    """Left rows with the aggregates of their partners; counts are 0 without any."""
    grouped = group_aggregate(right, [k for _, k in on], aggs, time)
    names = [(k, f"__{k}") for _, k in on]
    for old, new in names:
        grouped = grouped.withColumnRenamed(old, new)
    keyed = left.withColumns({new: F.col(lk) for (lk, _), (_, new) in zip(on, names)})
    joined = skew.skew_join(keyed, grouped, [new for _, new in names], "left").drop(*[new for _, new in names])
    return joined.fillna(0, subset=[a.alias for a in aggs if a.func in COUNT_LIKE])
