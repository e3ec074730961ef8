"""Categories of peripheral tables as mean targets, at any depth of the data model.

A category of a table below the population stands for the population rows its rows join
to. Sums of targets and numbers of targets are carried down the joins like gradients (see
pushdown.py), so a category's mean is one ratio of sums, from training rows only.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import roles as R
from ..operators import skew
from . import pushdown
from .features import shared_rows
from .model import Join

FEW = 1000  # categories


def name_of(column: str, target: str, first: str) -> str:
    """The first target's means have the plain name."""
    return f"{column}__mean_target" if target == first else f"{column}__mean_target__{target}"


def fitted(population: DataFrame, tables: dict[str, DataFrame], joins: list[Join], targets: list[str], min_freq: int) -> dict[str, list[tuple[str, str, DataFrame]]]:
    """Table name ("" is the population) -> (category, new column, means of categories met `min_freq` times)."""
    names = {t: (f"__s{i}", f"__n{i}") for i, t in enumerate(targets)}
    columns = tuple(c for pair in names.values() for c in pair)
    sums: dict[tuple[str, str], list[DataFrame]] = {}
    held: list[DataFrame] = []

    def add(name: str, rows: DataFrame, categories: list[str]) -> None:
        for c in categories:
            part = rows.where(F.col(f"`{c}`").isNotNull()).groupBy(F.col(f"`{c}`").alias(c))
            sums.setdefault((name, c), []).append(part.agg(*[F.sum(x).alias(x) for x in columns]))

    def descend(rows: DataFrame, below: list[Join]) -> None:
        for join in below:
            right = tables[join.right.name]
            if any(l not in rows.columns for l, _ in join.on):  # a key that a lookup brings along
                continue
            keys = {r for _, r in join.on}
            categories = [c for c in R.roles(right)[R.CATEGORICAL] if c not in keys]
            if not categories and not join.right.joins:
                continue
            pushed = pushdown.carried(rows, join, right, columns)
            further = [c for j in join.right.joins for c in (*[l for l, _ in j.on], *(j.time_stamps or ())[:1])]
            wanted = dict.fromkeys([*categories, *[c for c in further if c in pushed.columns], *columns])
            pushed = pushed.select(*[F.col(f"`{c}`") for c in wanted]).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(pushed)
            add(join.right.name, pushed, categories)
            descend(pushed, join.right.joins)

    # all targets go down together; a row without a target counts for the others
    rows = population.withColumns({c: e for t, (s, n) in names.items() for c, e in ((s, F.col(f"`{t}`").cast("double")), (n, F.col(f"`{t}`").isNotNull().cast("double")))})
    add("", rows, R.roles(population)[R.CATEGORICAL])
    descend(rows, [j for j in joins if not j.is_lookup])  # columns of a lookup are the population's by now
    out: dict[str, list[tuple[str, str, DataFrame]]] = {}
    totals = {(name, c): _stored(reduce(DataFrame.unionByName, parts).groupBy(f"`{c}`").agg(*[F.sum(x).alias(x) for x in columns])) for (name, c), parts in sums.items()}
    for target, (s, n) in names.items():
        for (name, c), total in totals.items():
            new = name_of(c, target, targets[0])
            means = total.where((F.col(n) > 0) & (F.col(n) >= min_freq)).select(f"`{c}`", (F.col(s) / F.col(n)).alias(new))
            out.setdefault(name, []).append((c, new, means))
    for rows in held:
        rows.unpersist()
    return out


def _stored(total: DataFrame) -> DataFrame:
    """The sums of a column's categories, added up once. Few of them are constants of later plans, which need no shuffle then."""
    rows = shared_rows(total)
    few = rows.limit(FEW + 1).collect() if isinstance(total.schema.fields[0].dataType, T.StringType) else None
    return rows if few is None or len(few) > FEW else rows.sparkSession.createDataFrame(few, total.schema)


def mapped(df: DataFrame, entries: list[tuple[str, str, DataFrame]]) -> DataFrame:
    for c, new, means in entries:
        df = skew.skew_join(df, means, [c], "left").withMetadata(new, {"role": R.NUMERICAL})
    return df
