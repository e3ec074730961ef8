"""Feature and column selection."""

from __future__ import annotations

from pyspark.ml.feature import UnivariateFeatureSelector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dependence, moments
from ..operators import roles as R
from .features import Feature
from .model import DataModel
from .predict import INPUT, Predictor, assemble


def with_variance(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns that are not constant (missing values count as 0)."""
    _, _, var, _, _, _ = moments.cross_moments(df, columns, F.lit(0.0))
    return [c for c, v in zip(columns, var) if v > 0.0]


def top_correlated(df: DataFrame, columns: list[str], target: str, n: int) -> list[str]:
    """The n columns with the largest absolute Pearson correlation; constant ones are left out."""
    if not columns:
        return []
    _, _, var, cov, _, var_y = moments.cross_moments(df, columns, F.col(f"`{target}`"))
    r = moments.pearson(var, cov, var_y)
    ranked = sorted((-abs(v), c) for c, v, s in zip(columns, r, var) if s > 0.0)
    return [c for _, c in ranked[:n]]


def select_relevant(df: DataFrame, columns: list[str], target: str, fdr: float = 0.05, label_type: str = "continuous") -> list[str]:
    """F test per column with false-discovery control under dependence.

    The Benjamini-Yekutieli bound is Benjamini-Hochberg at fdr / (1 + 1/2 + ... + 1/m). For numbers
    all tests come from the moments of a single pass over the rows; classes are left to the built-in selector.
    """
    if label_type == "continuous":
        if not columns:
            return []
        n, _, var, cov, _, var_y = moments.cross_moments(df, columns, F.col(f"`{target}`"))
        usable = [i for i, v in enumerate(var) if v > 0.0]
        if not usable:
            return []
        r = moments.pearson(var, cov, var_y)
        below = df.sparkSession._jvm.org.apache.commons.math3.distribution.FDistribution(1.0, float(n - 2))  # as the built-in test
        p = [1.0 - below.cumulativeProbability(float(r[i] ** 2 / (1 - r[i] ** 2) * (n - 2))) if abs(r[i]) < 1 else 0.0 for i in usable]
        return [columns[usable[k]] for k in dependence.benjamini_yekutieli(p, fdr)]
    usable = with_variance(df, columns)
    if not usable:
        return []
    data = assemble(df.withColumn(target, F.col(target).cast("double")), usable).select(INPUT, target)
    bound = fdr / sum(1 / i for i in range(1, len(usable) + 1))
    selector = UnivariateFeatureSelector(featuresCol=INPUT, labelCol=target, outputCol="__out", selectionMode="fdr")
    selector = selector.setFeatureType("continuous").setLabelType(label_type).setSelectionThreshold(bound)
    return [usable[i] for i in sorted(selector.fit(data).selectedFeatures)]


def select_dependent(df: DataFrame, columns: list[str], target: str, fdr: float = 0.05) -> list[str]:
    """Columns on which the target depends by the test for the types of both, at a false-discovery rate under any dependence."""
    found = dependence.dependence(df, columns, target)
    return [found[i][0] for i in dependence.benjamini_yekutieli([p for *_, p in found], fdr)]


def keep_share(importances: dict[str, float], share: float) -> list[str]:
    """Most important first, at least one."""
    ranked = sorted(importances, key=lambda c: (-importances[c], c))
    return ranked[: max(1, round(len(ranked) * share))]


def select_features(predictor: Predictor, df: DataFrame, columns: list[str], targets: list[str], share: float) -> list[str]:
    """Fit a predictor on all columns and keep the share it relies on most."""
    fitted = predictor.copy().fit(df, columns, targets)
    total = {c: sum(fitted.importances(t)[c] for t in targets) for c in columns}
    return keep_share(total, share)


def column_importances(features: list[Feature], importances: dict[str, float]) -> dict[str, float]:
    """Importance of source columns: each feature's share is divided among its sources."""
    out: dict[str, float] = {}
    for f in features:
        for c in f.columns:
            out[c] = out.get(c, 0.0) + importances.get(f.name, 0.0) / len(f.columns)
    total = sum(out.values())
    return {c: v / total if total else 0.0 for c, v in out.items()}


def select_columns(
    model: DataModel, tables: dict[str, DataFrame], features: list[Feature], importances: dict[str, float], share: float, population: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Tables without the columns that matter least; row ids, keys, time stamps and targets stay.

    With `population`, its own columns are ranked along with the others and the rest of it
    comes back under the model's name of it. The model fits the smaller tables as it is.
    """
    tables, name_of = dict(tables), {}
    if population is not None:
        tables[model.population.name] = population
        name_of[model.population.name] = "population"
        features = [*features, *[Feature(c, (), c, (f"population.{c}",)) for c in population.columns if c in importances]]
    ranked = column_importances(features, importances)
    keep = set(keep_share(ranked, share)) if ranked else set()
    fixed = (R.JOIN_KEY, R.TIME_STAMP, R.TARGET)
    out = {}
    for name, df in tables.items():
        ids = model.population.row_id if name in name_of else ()
        cols = [f.name for f in df.schema.fields if R.role_of(f) in fixed or f.name in ids or f"{name_of.get(name, name)}.{f.name}" in keep]
        out[name] = df.select(*cols)
    return out
