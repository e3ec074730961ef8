"""Exact holistic aggregates over long windows, from mergeable counts alone.

The distinct values of a column get dense codes in their order. A quantile is then found
from the top: how many rows of a window fall into each of 16 equal ranges of codes is a
set of conditional counts, which tells the range that holds the wanted rank, and only that
range is refined in the next turn. The rest follows from running numbers per value: the
c-th occurrence of a value adds c ln c - (c-1) ln (c-1) to the entropy sum, the first one
a distinct value, and the mode is the value whose running number is highest.

Each turn is a time-bounded join by (key, range) or (key, value), so no window is ever held
in one place and hot keys are cut as in any other such join. What is known of a left row
goes along as part of its row id, which saves joining it back. Turns are checkpointed: each
reads its input more than once, and a long chain of joins would be planned again every time.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import Agg
from ..session import checkpoint
from . import interval, ranks, skew

FAN = 16
RANKED = ("MEDIAN", "QUANTILE", "NUM_MAX", "NUM_MIN", "COUNT_ABOVE_MEAN", "COUNT_BELOW_MEAN")
DECAYED = 400  # half-lives after which a weight is below 2^-400 of the latest one


def splits(agg: Agg, join) -> bool:
    """Running numbers start with the column, so they serve windows without a memory only."""
    return agg.func in RANKED or join.memory is None


class Sides:
    """Both sides of a join in plain columns: keys k0.., time `tick`, ids i0.. and one value."""

    def __init__(self, left: DataFrame, right: DataFrame, join, value: str):
        self.join = join
        self.keys = [f"k{i}" for i in range(len(join.right_keys))]
        self.ids = [f"i{i}" for i in range(len(join.row_id))]
        named = [F.expr(k).alias(n) for k, n in zip(join.right_keys, self.keys)]
        rows = right.select(*named, F.expr(join.right_order).alias("tick"), F.expr(value).alias("v"))
        for c in rows.columns:
            rows = rows.where(F.col(c).isNotNull())
        self.right = rows
        named = [F.expr(k).alias(n) for k, n in zip(join.left_keys, self.keys)]
        named += [F.expr(c).alias(n) for c, n in zip(join.row_id, self.ids)]
        self.left = left.select(*named, F.expr(join.left_order).alias("tick"))

    def step(self, rows: DataFrame, right: DataFrame, aggs: list[Agg], match: tuple = (), time: str = "tick", **bounds) -> DataFrame:
        """`rows` with aggregates of the right rows in their windows; `match` pairs further keys."""
        part = replace(
            self.join, left_keys=(*self.keys, *[a for a, _ in match]), right_keys=(*self.keys, *[b for _, b in match]),
            left_order=time, right_order="tick", row_id=tuple(rows.columns), aggs=tuple(aggs), centers={}, span=0.0, **bounds,
        )
        return checkpoint(interval.interval_aggregate(rows, right, part, "blocks", told_apart=True))

    def named(self, rows: DataFrame, aggs) -> DataFrame:
        names = [c.strip("`") for c in self.join.row_id]
        return rows.select(*[F.col(i).alias(n) for i, n in zip(self.ids, names)], *[F.col(n).alias(a.alias) for n, a in aggs])


def _power(level: int) -> str:
    return f"{FAN**level}L"


def _digit_counts(code: str, level: int) -> list[Agg]:
    digit = f"({code} div {_power(level)}) % {FAN}"
    return [Agg("COUNT", condition=f"{digit} = {j}", name=f"c{j}") for j in range(FAN - 1)]


def _counts() -> Column:
    return F.array(*[F.col(f"c{j}") for j in range(FAN - 1)])


def _at_ranks(sides: Sides, rows: DataFrame, codes: DataFrame, table: DataFrame, levels: int, shares: dict[str, float]) -> DataFrame:
    """Quantiles, interpolated between the two ranks around their position."""
    held = rows.columns
    position = {name: F.lit(float(p)) * (F.col("n") - 1) for name, p in shares.items()}
    wanted = F.array_distinct(F.array(*[f(p) for p in position.values() for f in (F.floor, F.ceil)]))
    rows = rows.select("*", F.explode_outer(F.when(F.col("n") > 0, wanted)).alias("rank"))
    rows = rows.select("*", F.col("rank").alias("rest"), F.lit(0).cast("long").alias("node"))
    for level in reversed(range(levels)):
        found = sides.step(rows, codes, _digit_counts("code", level), (("node", f"(code div {_power(level + 1)})"),))
        start = F.struct(F.lit(0).cast("long").alias("digit"), F.col("rest").alias("rest"), F.lit(False).alias("done"))

        def walk(s: Column, c: Column) -> Column:
            stop = s["done"] | (s["rest"] < c)
            digit, rest = F.when(stop, s["digit"]).otherwise(s["digit"] + 1), F.when(stop, s["rest"]).otherwise(s["rest"] - c)
            return F.struct(digit.alias("digit"), rest.alias("rest"), F.coalesce(stop, F.lit(True)).alias("done"))

        found = found.withColumn("at", F.aggregate(_counts(), start, walk))
        rows = found.select(*held, "rank", F.col("at.rest").alias("rest"), (F.col("node") * FAN + F.col("at.digit")).alias("node"))
    values = table.select(F.col("code").alias("node"), F.col("v").cast("double").alias("v"))
    rows = skew.skew_join(rows, values, ["node"], "left")
    ends = {(name, f): F.max(F.when(F.col("rank") == edge(p), F.col("v"))) for name, p in position.items() for f, edge in (("low", F.floor), ("up", F.ceil))}
    rows = rows.groupBy(*held).agg(*[c.alias(f"{name}_{f}") for (name, f), c in ends.items()])
    low = {name: F.col(f"{name}_low") for name in shares}
    return rows.select(*held, *[(low[n] + (p - F.floor(p)) * (F.col(f"{n}_up") - low[n])).alias(n) for n, p in position.items()])


def _below(sides: Sides, rows: DataFrame, codes: DataFrame, table: DataFrame, levels: int, name: str, equal: bool) -> DataFrame:
    """Rows of the window with a value below (`equal`: at most) the column `mean`."""
    held = rows.columns
    marks = rows.select(F.col("mean").alias("v")).where("v IS NOT NULL").distinct()
    marks = marks.select("v", F.lit(2 if equal else 0).alias("side"), F.lit(0).alias("weight"))
    values = table.select(F.col("v").cast("double").alias("v"), F.lit(1).alias("side"), F.lit(1).alias("weight"))
    placed = ranks.running_total(checkpoint(marks.unionByName(values)), ["v", "side"], "weight", "until")
    marks = placed.where("side <> 1").select(F.col("v").alias("mean"), "until")
    rows = skew.skew_join(rows, marks, ["mean"], "left").select(*held, "until").withColumn(name, F.lit(0).cast("long"))
    for level in reversed(range(levels)):
        rows = rows.withColumn("node", F.expr(f"until div {_power(level + 1)}"))
        found = sides.step(rows, codes, _digit_counts("code", level), (("node", f"(code div {_power(level + 1)})"),))
        digit = F.coalesce(F.expr(f"(until div {_power(level)}) % {FAN}"), F.lit(0)).cast("int")
        less = F.aggregate(F.slice(_counts(), F.lit(1), digit), F.lit(0).cast("long"), lambda s, c: s + c)
        rows = found.select(*held, "until", (F.col(name) + less).alias(name))
    return rows.drop("until")


def _for_value(left: DataFrame, right: DataFrame, join, value: str, aggs: list[Agg]) -> DataFrame:
    sides = Sides(left, right, join, value)
    names = {a: f"a{i}" for i, a in enumerate(aggs)}
    funcs = {f: [names[a] for a in aggs if a.func == f] for f in {a.func for a in aggs}}
    shares = {names[a]: 0.5 if a.func == "MEDIAN" else a.param for a in aggs if a.func in ("MEDIAN", "QUANTILE")}
    table = checkpoint(ranks.with_row_id(sides.right.select("v").distinct(), ["v"], "code"))
    levels, total = 1, table.count()
    while FAN**levels <= total:
        levels += 1
    codes = checkpoint(skew.skew_join(sides.right, table, ["v"], "inner").select(*sides.keys, "tick", "v", "code"))
    first = [Agg("COUNT", name="n")]
    around = [f for f in ("COUNT_ABOVE_MEAN", "COUNT_BELOW_MEAN") if f in funcs]
    if around:
        first.append(Agg("AVG", "v", name="mean"))
    first += [Agg(f, "code", name=f.lower()) for f in ("MAX", "MIN") if f"NUM_{f}" in funcs]
    rows = sides.step(sides.left, codes, first)
    for extreme in ("max", "min"):
        if f"NUM_{extreme.upper()}" in funcs:
            rows = rows.withColumn(extreme, F.col(extreme).cast("long"))
            rows = sides.step(rows, codes, [Agg("COUNT", name=funcs[f"NUM_{extreme.upper()}"][0])], ((extreme, "code"),)).drop(extreme)
    for func in around:
        name, above = funcs[func][0], func == "COUNT_ABOVE_MEAN"
        rows = _below(sides, rows, codes, table, levels, name, above)
        if above:
            rows = rows.withColumn(name, F.col("n") - F.col(name))
    rows = rows.drop("mean")
    running = {"MODE", "ENTROPY", "COUNT_DISTINCT", "COUNT_MINUS_DISTINCT", "PERCENT_UNIQUE"} & set(funcs)
    if running:
        events = checkpoint(ranks.group_row_number(codes.drop("v"), [*sides.keys, "code"], ["tick"], "cnt"))
        delta = "CASE WHEN cnt > 1 THEN cnt * ln(cnt) - (cnt - 1) * ln(cnt - 1) ELSE 0D END"
        found = [Agg("COUNT", condition="cnt = 1", name="distinct"), Agg("SUM", delta, name="weighted"), Agg("MAX", "cnt", name="top")]
        rows = sides.step(rows, events, found).withColumn("top", F.col("top").cast("long"))
        n, d = F.col("n"), F.col("distinct")
        derived = {
            "COUNT_DISTINCT": d,
            "COUNT_MINUS_DISTINCT": n - d,
            "PERCENT_UNIQUE": F.try_divide(d, n),
            "ENTROPY": F.when(n > 0, F.greatest(F.ln(n) - F.try_divide("weighted", n), F.lit(0.0))),
        }
        for func in running - {"MODE"}:
            rows = rows.withColumn(funcs[func][0], derived[func])
        rows = rows.drop("distinct", "weighted")
        if "MODE" in funcs:
            rows = sides.step(rows, events, [Agg("MIN", "code", name="code")], (("top", "cnt"),)).withColumn("code", F.col("code").cast("long"))
            rows = skew.skew_join(rows, table.withColumnRenamed("v", funcs["MODE"][0]), ["code"], "left").drop("code")
        rows = rows.drop("top")
    if shares:
        rows = _at_ranks(sides, rows, codes, table, levels, shares)
    return sides.named(rows, [(funcs[a.func][0] if a.func not in ("MEDIAN", "QUANTILE") else names[a], a) for a in aggs])


def aggregate(left: DataFrame, right: DataFrame, join, aggs: list[Agg]) -> list[DataFrame]:
    """One table (row id, aggregates) per distinct value expression."""
    values = dict.fromkeys(a.value_sql for a in aggs)
    return [_for_value(left, right, join, v, [a for a in aggs if a.value_sql == v]) for v in values]


def decayed(left: DataFrame, right: DataFrame, join, agg: Agg) -> DataFrame:
    """EWMA over a window of very many half-lives, by a join over at most `DECAYED` of them.

    Weights relative to the latest row of a window decide the value, so the window may
    end there. Where fewer half-lives lie between the window's start and that row, it ends
    `DECAYED` half-lives after its start, which holds the same rows.
    """
    sides = Sides(left, right, join, agg.value_sql)
    reach = int(DECAYED * agg.param * join.unit) or 1
    rows = sides.step(sides.left, sides.right, [Agg("LAST", "tick", name="last")])
    end = F.col("last")
    if join.memory is not None:
        end = F.greatest(end, F.col("tick") - join.horizon - join.memory + reach)
    rows = rows.select(*sides.keys, *sides.ids, F.when(F.col("last").isNotNull(), end).alias("until"))
    rows = sides.step(rows, sides.right, [Agg("EWMA", "v", name="a0", param=agg.param)], time="until", horizon=0, memory=reach)
    return sides.named(rows, [("a0", agg)])
