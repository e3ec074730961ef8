"""First and second moments of many columns in one pass.

Hundreds of built-in aggregates in one statement outgrow code generation. Here each
task folds its Arrow batches into sums with numpy, keeps one small state, and the
partial sums are added up by a grouping over the column number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shipped


@dataclass(frozen=True)
class Moments:
    """Means and (co)variances of the population; `index` maps a column to its place."""

    n: int
    index: dict[str, int]
    mean: np.ndarray
    cov: np.ndarray

    def block(self, rows: list[str], cols: list[str]) -> np.ndarray:
        return self.cov[np.ix_([self.index[c] for c in rows], [self.index[c] for c in cols])]


def clean(c: str | Column) -> Column:
    x = F.col(f"`{c}`") if isinstance(c, str) else c
    x = x.cast("double")
    return F.when(x.isNull() | F.isnan(x), 0.0).otherwise(x)


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    ends = np.cumsum([0, *pc.list_value_length(column).to_pylist()])
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _merged(n: float, mean: np.ndarray, co: np.ndarray, m: float, other: np.ndarray, more: np.ndarray, with_y: bool = False):
    """Two states (count, means, co-moments about them) as one; `co` has one column for y if `with_y`."""
    total = n + m
    gap = other - mean
    return total, mean + gap * (m / total), co + more + np.outer(gap, gap[-1:] if with_y else gap) * (n * m / total)


def _state(x: np.ndarray, with_y: bool):
    mean = x.mean(axis=0)
    centred = x - mean
    return len(x), mean, centred.T @ (centred[:, -1:] if with_y else centred)


def _moments(rows: DataFrame, width: int, with_y: bool) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Count, means, variances (times count) and co-moments of `x`, with the last column only if `with_y`.

    Every task merges the states of its batches, each about its own means, so digits do
    not suffer from a far origin. A state travels as one row per column of the matrix
    (all columns in one row if only the last one counts) and rows are merged by number.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, co, square = 0.0, np.zeros(width), np.zeros((width, 1 if with_y else width)), np.zeros(width)
        for batch in batches:
            x = _matrix(batch, width)
            if not len(x):
                continue
            m, other, more = _state(x, with_y)
            squares = ((x - other) ** 2).sum(axis=0)
            square = square + squares + (other - mean) ** 2 * (n * m / (n + m))
            n, mean, co = _merged(n, mean, co, m, other, more, with_y=with_y)
        if n:
            # of the matrix, which is symmetric, only the part from the diagonal on
            parts = [(0, mean, square, co.ravel())] if with_y else [(i, mean[i:], square[i : i + 1], co[i, i:]) for i in range(width)]
            i, m, s, v = zip(*parts, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array([n] * len(parts)), *[pa.array(list(c)) for c in (m, s, v)]], ["i", "n", "m", "s", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple] = {}
        for batch in batches:
            wide = [_lists(batch.column(c)) for c in (2, 3, 4)]
            for i, m, other, squares, more in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *wide, strict=True):
                if i not in total:
                    total[i] = (m, other, squares, more)
                    continue
                n, mean, square, co = total[i]
                gap = other - mean
                share = n * m / (n + m)
                if with_y:
                    square, co = square + squares + gap**2 * share, co + more + gap * gap[-1] * share
                else:
                    square, co = square + squares + gap[:1] ** 2 * share, co + more + gap * gap[0] * share
                total[i] = (n + m, mean + gap * (m / (n + m)), square, co)
        if total:
            cols = list(zip(*total.values(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), *[pa.array(list(c)) for c in cols]], ["i", "n", "m", "s", "v"])

    kind = "i long, n double, m array<double>, s array<double>, v array<double>"
    # a row of the matrix is merged in one task; at most `width` rows result
    found = shipped(rows).mapInArrow(fold, kind).repartition("i").mapInArrow(add, kind).collect()
    if not found:
        return 0.0, np.zeros(width), np.zeros(width), np.zeros(width if with_y else (width, width))
    first = min(found, key=lambda r: r["i"])
    if with_y:
        return first["n"], np.array(first["m"]), np.array(first["s"]), np.array(first["v"])
    co, square = np.zeros((width, width)), np.zeros(width)
    for r in found:
        i = r["i"]
        co[i, i:] = co[i:, i] = r["v"]
        square[i] = r["s"][0]
    return first["n"], np.array(first["m"]), square, co


def covariances(df: DataFrame, columns: list[str], packed: Column | None = None) -> Moments:
    """Full covariance matrix; missing values count as 0. `packed` holds all columns as an array without missing values."""
    rows = df.select((F.array(*[clean(c) for c in columns]) if packed is None else packed).alias("x"))
    n, mean, _, co = _moments(rows, len(columns), with_y=False)
    return Moments(int(n), {c: i for i, c in enumerate(columns)}, mean, co / max(n, 1))


def cross_moments(df: DataFrame, columns: list[str], y: Column, packed: Column | None = None) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, float, float]:
    """n, column means, column variances, covariances with y, mean and variance of y; `packed` holds all columns and y as an array."""
    rows = df.select((F.array(*[clean(c) for c in columns], y.cast("double")) if packed is None else packed).alias("x")).where(F.element_at("x", -1).isNotNull())
    n, mean, square, co = _moments(rows, len(columns) + 1, with_y=True)
    var, cov = square / max(n, 1), co / max(n, 1)
    return int(n), mean[:-1], var[:-1], cov[:-1], float(mean[-1]), float(var[-1])


def pearson(var: np.ndarray, cov: np.ndarray, var_y: float) -> np.ndarray:
    """Correlations; 0 for constant columns."""
    scale = np.sqrt(var * var_y)
    return np.divide(cov, scale, out=np.zeros_like(cov), where=scale > 0)
