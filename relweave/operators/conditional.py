"""Counts and sums of many values under many conditions: one array per left row.

A search for conditions asks for hundreds of sums over the same few columns. As columns of
a GROUP BY or of a window, each costs a buffer per key and a step per row. Here the narrow
rows of both sides are dealt and sorted by key (and block of time), and every task goes
through them once: numpy multiplies the conditions with the values and adds them up by key,
so that only the left rows, which come after the right rows of their key, get wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.aggregates import Agg
from ..session import shipped
from . import interval, skew

KEYS = (T.IntegralType, T.StringType, T.DateType, T.TimestampType)  # equal exactly if the join finds them equal
CELLS = 2_000_000  # numbers of one block of the work
PIECE = 400_000  # rows of both sides that a task sorts


def _pieces(left: DataFrame, right: DataFrame, aggs: list[Agg], on: list[tuple[str, str]], plan: interval.IntervalJoin | None) -> int:
    """Tasks for the rows of both sides; 0 where this form does not fit."""
    if any(a.func not in ("SUM", "COUNT") or (a.func == "COUNT") != (a.column is None) for a in aggs):
        return 0
    for l, r in on:
        if left.schema[l].dataType != right.schema[r].dataType or not isinstance(left.schema[l].dataType, KEYS):
            return 0
    if not on and plan is None:
        return 0
    pieces, rows = left.sparkSession.sparkContext.defaultParallelism, 0
    if plan is not None:  # the rows of a block are held by a task
        found = interval.profile(left, right, plan) if plan.memory is not None else None
        if found is None or not interval.is_small(found, plan, aggs):
            return 0
        # every right row visits one block or the next one as well
        return max(pieces, -(-(2 * found.rows + left.count()) // PIECE))
    cols = [l for l, _ in on], [r for _, r in on]
    for df, names in ((left.select(*cols[0]), cols[0]), (right.select(*cols[1]).dropna(), cols[1])):
        hot, _, counted = skew.counted_groups(df, names)
        if any(None not in group for group in hot):  # left rows without a key are spread
            return 0
        rows += counted
    return max(pieces, -(-rows // PIECE))


def sums(left: DataFrame, right: DataFrame, aggs: list[Agg], on: list[tuple[str, str]], name: str, plan: interval.IntervalJoin | None = None) -> tuple[DataFrame, DataFrame] | None:
    """Left rows with the array `name` of all counts and sums (0 without any), and the narrow rows it is computed from.

    None where this form does not fit: other aggregates, hot keys, long windows.
    """
    pieces = _pieces(left, right, aggs, on, plan)
    if not pieces:
        return None
    conditions, values = list(dict.fromkeys(a.condition for a in aggs)), list(dict.fromkeys(a.column for a in aggs))
    which = np.array([conditions.index(a.condition) for a in aggs]), np.array([values.index(a.column) for a in aggs])
    width, keys = len(aggs), [f"__k{i}" for i in range(len(on))]
    own = left.select(F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__l"), *_placed(left, [l for l, _ in on], plan, True))
    other = right.select(F.struct(*[F.col(f"`{c}`") for c in right.columns]).alias("__r"), *_placed(right, [r for _, r in on], plan, False))
    other = other.dropna(subset=keys)
    if plan is not None:
        block = interval._wide("__o", interval.WIDE_FACTOR * plan.memory), interval._wide(f"__o + {plan.memory - 1}L", interval.WIDE_FACTOR * plan.memory)
        own = own.withColumn("__b", F.expr(f"CASE WHEN {' OR '.join(f'{k} IS NULL' for k in keys)} THEN 0L ELSE {block[0]} END"))
        other = other.withColumn("__b", F.explode(F.expr(f"sequence({block[0]}, {block[1]})")))
        keys.append("__b")
    # left rows that match nothing are spread
    spread = F.when(F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)), F.pmod(F.xxhash64("__l"), F.lit(4096))).otherwise(0)
    both = own.withColumn("__side", F.lit(1)).withColumn("__spread", spread).unionByName(other.withColumn("__side", F.lit(0)).withColumn("__spread", F.lit(0).cast("long")), allowMissingColumns=True)
    held = both.repartition(pieces, *keys, "__spread").sortWithinPartitions(*keys, "__side", "__o").drop("__spread")
    bare = held.select("__l", *keys, "__o", "__side", "__r.*")
    met = [F.lit(True) if c is None else F.expr(f"coalesce({c}, false)") for c in conditions]
    cells = [F.lit(1.0) if v is None else F.coalesce(F.expr(f"CAST({v} AS DOUBLE)"), F.lit(0.0)) for v in values]
    rows = bare.select("__l", *keys, "__o", "__side", F.array(*met).alias("__met"), F.array(*cells).alias("__x"))
    memory = None if plan is None else plan.memory

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _by_key(batches, keys, which) if memory is None else _by_window(batches, keys, which, memory)
        for rows, found in parts:
            found[np.isnan(found)] = 0.0
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * width, type=pa.int32())
            yield pa.RecordBatch.from_arrays([*rows.flatten(), pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))], names=[*[f.name for f in rows.type], name])

    return shipped(rows).mapInArrow(fold, T.StructType([*left.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])), held


def _placed(df: DataFrame, keys: list[str], plan: interval.IntervalJoin | None, is_left: bool) -> list:
    """Keys and time of a side; rows without a time have no key."""
    cols = [F.col(f"`{k}`") for k in keys]
    if plan is None:
        return [*[c.alias(f"__k{i}") for i, c in enumerate(cols)], F.lit(0).cast("long").alias("__o")]
    order = F.expr(f"CAST(({plan.left_order}) - {plan.horizon} AS BIGINT)" if is_left else f"CAST({plan.right_order} AS BIGINT)")
    return [*[F.when(order.isNotNull(), c).alias(f"__k{i}") for i, c in enumerate(cols)], F.coalesce(order, F.lit(0).cast("long")).alias("__o")]


def _read(batches: Iterator[pa.RecordBatch], keys: list[str]):
    """Of every batch: its left structs, and group number, side, time, conditions met and values of its rows."""
    group, last = -1, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        first = np.zeros(n, dtype=bool)
        cols = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        now = [c[0].as_py() for c in cols]
        first[0] = last is None or None in now or now != last
        for c in cols:
            first[1:] |= pc.fill_null(pc.not_equal(c.slice(0, n - 1), c.slice(1)), True).to_numpy(zero_copy_only=False)
        last = [c[n - 1].as_py() for c in cols]
        groups = group + np.cumsum(first)
        group = groups[-1]
        column = lambda c: batch.column(batch.schema.get_field_index(c))
        met = column("__met").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        x = column("__x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        yield column("__l"), groups, column("__side").to_numpy() == 0, column("__o").to_numpy(), met, x


def _products(met: np.ndarray, x: np.ndarray, which) -> np.ndarray:
    """Value under its condition, for every aggregate."""
    out = x[:, which[1]]
    if np.isfinite(x).all():
        out *= met[:, which[0]]
    else:
        out[~met[:, which[0]]] = 0.0
    return out


def _by_key(batches, keys, which):
    """Left rows and their sums over all right rows of the key; a sum that goes on in the next block is carried."""
    step = max(1, CELLS // len(which[0]))
    carried, total = -1, np.zeros(len(which[0]))
    for left, groups, right, _, met, x in _read(batches, keys):
        for a in range(0, len(groups), step):
            at = slice(a, a + step)
            g, r = groups[at], right[at]
            out = np.zeros((int((~r).sum()), len(total)))
            lg = g[~r]
            out[lg == carried] = total
            if r.any():
                rg = g[r]
                starts = np.flatnonzero(np.r_[True, rg[1:] != rg[:-1]])
                found, known = np.add.reduceat(_products(met[at][r], x[at][r], which), starts, axis=0), rg[starts]
                if known[0] == carried:
                    found[0] += total
                place = np.minimum(np.searchsorted(known, lg), len(known) - 1)
                hit = known[place] == lg
                out[hit] = found[place[hit]]
                carried, total = known[-1], found[-1].copy()
            if len(lg):
                yield left.slice(a, step).filter(pa.array(~r)), out


def _by_window(batches, keys, which, memory: int):
    """Left rows and their sums over the right rows of the last `memory` ticks; the right rows of the last block are kept."""
    step = max(1, CELLS // len(which[0]))
    kept = None
    for left, groups, right, order, met, x in _read(batches, keys):
        rights = [groups[right], order[right], met[right], x[right]]
        if kept is not None:
            rights = [np.concatenate(p) for p in zip(kept, rights, strict=True)]
        rg, ro, rm, rx = rights
        lg, lo = groups[~right], order[~right]
        begin, end = _before(rg, ro, lg, lo - memory), _before(rg, ro, lg, lo)
        rows = left.filter(pa.array(~right))
        for a in range(0, len(lg), step):
            b, e = begin[a : a + step], end[a : a + step]
            low, high = b.min(), e.max()
            out = np.zeros((len(b), len(which[0])))
            if high > low:
                cells = np.vstack([_products(rm[low:high], rx[low:high], which), np.zeros((1, len(which[0])))])
                found = e > b
                out[found] = np.add.reduceat(cells, np.stack([b[found], e[found]], axis=1).ravel() - low, axis=0)[::2] if found.any() else 0.0
            yield rows.slice(a, step), out
        last = rg == groups[-1]
        kept = [p[last] for p in rights]


def _before(rg, ro, lg, lo) -> np.ndarray:
    """For every left row: right rows of earlier groups, and of its own up to its time."""
    kind = np.r_[np.zeros(len(rg), dtype=np.int64), np.ones(len(lg), dtype=np.int64)]
    order = np.lexsort((kind, np.r_[ro, lo], np.r_[rg, lg]))
    out = np.empty(len(kind), dtype=np.int64)
    out[order] = np.cumsum(1 - kind[order])
    return out[len(rg) :]
