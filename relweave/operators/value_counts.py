"""Holistic aggregates of columns with few distinct values, from mergeable counts.

If a column takes at most 64 values, the number of times each value occurs in a window is
a set of conditional counts. Distinct counts, mode, entropy, quantiles and the like
follow exactly from those, so long windows and hot keys need no sliding frame.
"""

from __future__ import annotations

from math import isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.aggregates import Agg

FEW = 64


def few_values(df: DataFrame, value: str) -> list | None:
    """Sorted distinct values of an expression, or None when there are more than 64."""
    column = df.select(F.expr(value).alias("v"))
    if not isinstance(column.schema["v"].dataType, (T.StringType, T.IntegralType, T.DoubleType, T.BooleanType)):
        return None
    found = column.where("v IS NOT NULL").distinct().limit(FEW + 1).collect()
    return None if len(found) > FEW else sorted((r[0] for r in found), key=lambda v: (v != v, v))


def literal_sql(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, float) and not isfinite(v):
        return f"double('{v!r}')"
    return f"{v!r}D" if isinstance(v, float) else str(v)


def count_aggs(value: str, values: list, tag: str) -> list[Agg]:
    return [Agg("COUNT", None, f"({value}) = {literal_sql(v)}", f"__{tag}_{j}") for j, v in enumerate(values)]


def _sum(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def _at_rank(rank: Column, values: list, counts: list[Column]) -> Column:
    """Value at a rank, counted from 0 in ascending order."""
    out, below = None, None
    for v, c in zip(values, counts):
        below = c if below is None else below + c
        out = F.when(rank < below, F.lit(float(v))) if out is None else out.when(rank < below, F.lit(float(v)))
    return out


def final(agg: Agg, values: list, counts: list[Column]) -> Column:
    """The aggregate as an expression over the counts of the values."""
    if not values:
        zero = agg.func in ("COUNT_DISTINCT", "COUNT_MINUS_DISTINCT", "NUM_MAX", "NUM_MIN", "COUNT_ABOVE_MEAN", "COUNT_BELOW_MEAN")
        return F.lit(0).cast("bigint") if zero else F.lit(None)
    n = _sum(counts)
    distinct = _sum([(c > 0).cast("bigint") for c in counts])
    if agg.func == "COUNT_DISTINCT":
        return distinct
    if agg.func == "COUNT_MINUS_DISTINCT":
        return n - distinct
    if agg.func == "PERCENT_UNIQUE":
        return F.try_divide(distinct, n)
    if agg.func == "ENTROPY":
        weighted = _sum([F.when(c > 0, c * F.ln(c)).otherwise(0.0) for c in counts])
        return F.when(n > 0, F.greatest(F.ln(n) - F.try_divide(weighted, n), F.lit(0.0)))
    if agg.func == "MODE":
        top = F.greatest(*counts) if len(counts) > 1 else counts[0]
        out = F.when((counts[0] == top) & (top > 0), F.lit(values[0]))
        for v, c in list(zip(values, counts))[1:]:
            out = out.when((c == top) & (top > 0), F.lit(v))
        return out
    if agg.func in ("NUM_MAX", "NUM_MIN"):
        ordered = counts[::-1] if agg.func == "NUM_MAX" else counts
        return F.coalesce(*[F.when(c > 0, c) for c in ordered], F.lit(0).cast("bigint"))
    if agg.func in ("COUNT_ABOVE_MEAN", "COUNT_BELOW_MEAN"):
        mean = F.try_divide(_sum([F.when(c > 0, F.lit(float(v)) * c).otherwise(0.0) for v, c in zip(values, counts)]), n)
        sides = [F.lit(float(v)) > mean if agg.func == "COUNT_ABOVE_MEAN" else F.lit(float(v)) < mean for v in values]
        return _sum([F.when(side, c).otherwise(0).cast("bigint") for side, c in zip(sides, counts)])
    p = 0.5 if agg.func == "MEDIAN" else agg.param
    pos = F.lit(float(p)) * (n - 1)
    low, up = _at_rank(F.floor(pos), values, counts), _at_rank(F.ceil(pos), values, counts)
    return F.when(n > 0, low + (pos - F.floor(pos)) * (up - low))
