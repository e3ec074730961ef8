"""Search of conditions in inner tables by gradients that are carried down the joins.

A sum over inner rows reaches the target through the joins above it. Its covariance with
the residual is therefore a sum over the inner rows themselves, once every row knows the
summed residuals of the population rows it belongs to. Carrying those sums down costs one
aggregation by key and one join a level; after that, all conditions of an inner table are
scored by a single aggregation over its own rows, without any join per candidate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import Agg
from ..functions.timecols import order_sql
from ..operators import interval, skew
from ..operators import roles as R
from .features import Propositionalizer, Relation, shared_rows
from .model import Join, Placeholder

GRADIENT, WEIGHT = "__g", "__h"
CHUNK = 200


def carried(left: DataFrame, join: Join, right: DataFrame, columns: tuple[str, ...] = (GRADIENT, WEIGHT)) -> DataFrame:
    """`right` with the sums of the gradients and weights (or other `columns`, the last never null) of the left rows that each row joins to.

    With time bounds these are the left rows at least the horizon and less than horizon
    plus memory later: the same window, looked at from the other side, on reversed time.
    Right rows that no left row sees are left out.
    """
    right = right.drop(*columns)
    keys = [r for _, r in join.on]
    if join.time_stamps is None:
        sums = left.groupBy(*[F.col(f"`{l}`").alias(r) for l, r in join.on]).agg(*[F.sum(c).alias(c) for c in columns])
        return skew.skew_join(right, sums.dropna(subset=keys), keys, "inner")
    before, after = join.time_stamps
    held = shared_rows(right.withColumn("__row", F.monotonically_increasing_id()))
    later = left.select(*[F.col(f"`{l}`") for l in dict.fromkeys(l for l, _ in join.on)], F.expr(f"-({order_sql(left, before)})").alias("__t"), *columns)
    rows = held.select("__row", *[F.col(f"`{r}`") for r in dict.fromkeys(keys)], F.expr(f"-({order_sql(held, after)})").alias("__t"))
    sums = [Agg("SUM", f"`{c}`", None, c) for c in columns]
    found = interval.range_aggregate(
        rows, later, sums, on=[(r, l) for l, r in join.on], times=("__t", "__t"), row_id=["__row"], horizon=join.horizon, memory=join.memory
    )
    return held.join(found.where(F.col(columns[-1]).isNotNull()), "__row").drop("__row")


def gains(rows: DataFrame, conditions: list[str], values: list[str | None]) -> dict[tuple[str, str | None], float]:
    """How much of the residual's variance a split of the sum of each value by each condition explains.

    A value of None counts rows. Both parts of a split have weights of their own: squared
    gradient over squared weight, added up, less that of the whole.
    """
    def sums(value: str | None, match: Column | None) -> list[Column]:
        x = F.lit(1.0) if value is None else F.coalesce(F.nanvl(F.col(f"`{value}`").cast("double"), F.lit(None)), F.lit(0.0))
        parts = [x * F.col(GRADIENT), x * x * F.col(WEIGHT)]
        return [F.sum(p if match is None else F.when(match, p)) for p in parts]

    def read(wanted: list[tuple[str | None, str | None]]) -> list[tuple[float, float]]:
        out: list[tuple[float, float]] = []
        for i in range(0, len(wanted), CHUNK):
            some = [c.alias(f"s{j}") for j, c in enumerate(c for cond, v in wanted[i : i + CHUNK] for c in sums(v, None if cond is None else F.expr(f"coalesce({cond}, false)")))]
            row = rows.agg(*some).first()
            out += [(row[j] or 0.0, row[j + 1] or 0.0) for j in range(0, len(some), 2)]
        return out

    pairs = [(c, v) for c in conditions for v in values]
    total = dict(zip(values, read([(None, v) for v in values])))
    out = {}
    for (cond, v), (g, h) in zip(pairs, read(pairs)):
        all_g, all_h = total[v]
        if h > 0 and all_h - h > 1e-12 * all_h:
            out[cond, v] = g * g / h + (all_g - g) ** 2 / (all_h - h) - all_g**2 / all_h
    return out


def search(
    place: Placeholder, rows: DataFrame, spec: Propositionalizer, path: tuple[str, ...], conditions: Callable[[Relation], list[str]], keep: int, known: dict[tuple[str, ...], list[Agg]],
) -> dict[tuple[str, ...], list[Agg]]:
    """The best `keep` new conditional sums of every table below `place`, by path.

    `rows` are those of `place` with gradients and weights. Lookups are passed through.
    """
    out: dict[tuple[str, ...], list[Agg]] = {}
    for join in place.joins:
        below = (*path, join.right.name)
        if join.is_lookup and not join.right.joins:
            continue
        pushed = shared_rows(carried(rows, join, spec.rows[below]))
        if not join.is_lookup:
            relation = spec.nested[below]
            by_role = R.roles(relation.right)
            own = [f.name for f in relation.right.schema.fields if f.name in by_role[R.NUMERICAL] and not f.metadata.get("derived")]
            old = known.get(below, [])
            seen = {(a.condition, a.column) for a in old}
            found = gains(pushed, conditions(relation), [None, *own])
            ranked = sorted(((g, c, v) for (c, v), g in found.items() if (c, v if v is None else f"`{v}`") not in seen and g > 0), key=lambda x: (-x[0], x[1], x[2] or ""))
            for i, (_, cond, value) in enumerate(ranked[:keep], len(old)):
                agg = Agg("COUNT", None, cond, f"count__where{i}") if value is None else Agg("SUM", f"`{value}`", cond, f"sum__{value}__where{i}")
                out.setdefault(below, []).append(agg)
        for where, aggs in search(join.right, pushed, spec, below, conditions, keep, known).items():
            out.setdefault(where, []).extend(aggs)
    return out
