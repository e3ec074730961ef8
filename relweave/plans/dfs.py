"""Deep feature synthesis over a set of tables with parent-child relationships."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.aggregates import MERGEABLE, Agg
from ..operators import grouping

Tables = dict[str, tuple[DataFrame, str | None]]


def synthesise(
    tables: Tables,
    relationships: list[tuple[str, str, str, str]],
    target: str,
    primitives: tuple[str, ...],
    max_depth: int = 2,
    ignore: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Rows of `target` with features named like ``AVG(orders.SUM(lineitem.l_quantity))``.

    A relationship is (parent, parent key, child, child key). Children are aggregated
    before their parents, one grouping per relationship.
    """
    return _deepen(tables, relationships, target, primitives, max_depth, ignore or {})


def _deepen(tables, relationships, name, primitives, depth, ignore) -> DataFrame:
    df, index = tables[name]
    if depth == 0:
        return df
    for parent, parent_key, child, child_key in relationships:
        if parent != name:
            continue
        rows = _deepen(tables, relationships, child, primitives, depth - 1, ignore)
        links = {k for p, pk, c, ck in relationships for k, t in ((pk, p), (ck, c)) if t == child}
        skip = {*links, child_key, tables[child][1], *ignore.get(child, [])}
        inputs = [f.name for f in rows.schema.fields if f.name not in skip]
        # plain names inside, readable names outside
        short = {c: f"c{i}" for i, c in enumerate(inputs)}
        rows = rows.select(F.col(f"`{child_key}`").alias("__key"), *[F.col(f"`{c}`").alias(s) for c, s in short.items()])
        aggs, names = [], {}
        for func in primitives:
            if func == "COUNT":
                aggs.append(Agg("COUNT", name="n"))
                names["n"] = f"COUNT({child})"
                continue
            for c, s in short.items():
                spec = MERGEABLE.get(func)
                numeric = isinstance(rows.schema[s].dataType, T.NumericType)
                if (spec is None or spec.numeric) and not numeric and func not in ("MODE", "COUNT_DISTINCT", "ENTROPY"):
                    continue
                aggs.append(Agg(func, s, name=f"{func}_{s}"))
                names[f"{func}_{s}"] = f"{func}({child}.{c})"
        df = grouping.join_aggregate(df, rows, aggs, [(parent_key, "__key")]).withColumnsRenamed(names)
    return df
