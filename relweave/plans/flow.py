"""Preprocessors -> learners -> selection -> predictors, fitted on the training view only."""

from __future__ import annotations

import copy
from collections.abc import Callable
from dataclasses import replace
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import metrics, prep
from ..operators import roles as R
from . import mapping, select
from .features import Feature, Propositionalizer, combine, correlations, fold_lookup, resolve
from .model import DataModel, Join, Placeholder, View
from .predict import IncludeCategorical, Predictor


class Pipeline:
    """Learners in turn see the same view; their columns are put side by side by row id."""

    def __init__(
        self,
        data_model: DataModel,
        preprocessors=(),
        feature_learners=(),
        feature_selectors: tuple[Predictor, ...] = (),
        predictors: tuple[Predictor, ...] = (),
        share_selected_features: float = 1.0,
        include_categorical: bool = False,
    ):
        self.model, self.preprocessors, self.learners = data_model, list(preprocessors), list(feature_learners)
        self.selectors, self.predictors = list(feature_selectors), list(predictors)
        self.share, self.include_categorical = share_selected_features, include_categorical

    def check(self, view: View) -> list[tuple[str, str, float]]:
        return prep.check(view.population, view.peripheral, self.model.population.joins, self.model.population.row_id)

    def _prepare(self, view: View, targets: list[str], fit: bool) -> View:
        population, tables = view.population, dict(view.peripheral)
        if fit:
            self._folded: list[tuple[Join, Propositionalizer]] = []  # lookups of the population, for scripts
        for join in self.model.population.joins:
            if join.is_lookup:  # the columns of a lookup become columns of the population
                spec = Propositionalizer(compare_units=False)
                right, _ = resolve(join.right, tables, spec, (join.right.name,))
                population, _ = fold_lookup(population, right, join)
                if fit:
                    self._folded.append((join, spec))
        if fit:
            self._fitted = {}
            self._mapped: dict[int, dict] = {}  # means of categories by preprocessor and table
            self._model = self.model
        for i, step in enumerate(self.preprocessors):
            if isinstance(step, prep.Mapping):
                if fit:
                    self._mapped[i] = mapping.fitted(population, tables, self.model.population.joins, targets, step.min_freq) if targets else {}
                population = mapping.mapped(population, self._mapped[i].get("", []))
                tables.update({n: mapping.mapped(tables[n], entries) for n, entries in self._mapped[i].items() if n})
                continue
            if isinstance(step, prep.TextFieldSplitter):
                if fit:
                    step.fit(population)
                    self._model = _with_words(self._model, step)
                tables.update({words_table(c): words for c, words in step.transform(population).items()})
                continue
            for name, df in {"": population, **tables}.items():
                if fit:
                    # one fitted copy per table: columns are found by role and unit
                    copy = type(step)(**{k: v for k, v in vars(step).items() if k not in ("columns", "means", "tables")})
                    self._fitted[i, name] = copy.fit(df)
                done = self._fitted[i, name].transform(df)
                if name:
                    tables[name] = done
                else:
                    population = done
        return View(population, tables)

    def prepared(self, view: View) -> DataFrame:
        """The population with its lookups folded in, before anything is fitted."""
        return type(self)(self.model)._prepare(view, [], fit=True).population

    def _own(self, df: DataFrame, targets: list[str]) -> list[str]:
        return [c for c in R.roles(df)[R.NUMERICAL] if c not in targets]

    def fit(self, view: View, targets: list[str]) -> Pipeline:
        self.targets = list(targets)
        self._peripheral = view.peripheral
        prepared = self._prepare(view, targets, fit=True)
        self._tables = prepared.peripheral
        # with several targets, each gets learners of its own, unless they do not look at it
        self._learners = [(None if len(targets) == 1 else t, learner if t == targets[0] or not _looks(learner) else copy.deepcopy(learner)) for t in targets for learner in self.learners]
        fitted = set()
        for target, learner in self._learners:
            if id(learner) not in fitted:
                learner.fit(self._model, prepared, target or targets[0])
            fitted.add(id(learner))
        if self.include_categorical:
            self._categories = IncludeCategorical(R.roles(prepared.population)[R.CATEGORICAL]).fit(prepared.population)
        flat = self._flat(prepared)
        columns = self._columns(flat)
        self._own_columns = self._own(prepared.population, targets)
        if self.selectors:
            columns = select.select_features(self.selectors[0], flat, columns, targets, self.share)
        self.columns = columns
        for predictor in self.predictors:
            predictor.fit(flat, columns, targets)
        return self

    def _columns(self, flat: DataFrame) -> list[str]:
        skip = {*self.model.population.row_id, *self.targets}
        return [f.name for f in flat.schema.fields if f.name not in skip and isinstance(f.dataType, T.NumericType)]

    def _flat(self, view: View) -> DataFrame:
        rid = list(self.model.population.row_id)
        population = view.population
        extra: list[str] = []
        if self.include_categorical:
            population, extra = self._categories.transform(population)
        targets = [t for t in self.targets if t in population.columns]
        own = population.select(*dict.fromkeys([*rid, *targets, *self._own(population, targets), *extra]))
        parts = []
        for target, learner in self._learners:
            part = learner.transform(self._model, view)
            if target:
                part = part.withColumnsRenamed({c: f"{c}__for_{target}" for c in part.columns if c not in rid})
            parts.append(part)
        return combine([own, *parts], rid)

    def _view(self, view: View) -> View:
        prepared = self._prepare(view, self.targets, fit=False)
        same = view.peripheral.keys() == self._peripheral.keys() and all(view.peripheral[k] is v for k, v in self._peripheral.items())
        # words belong to the population of the view, all other tables to the container
        own = {k: v for k, v in prepared.peripheral.items() if k not in view.peripheral}
        return View(prepared.population, {**self._tables, **own} if same else prepared.peripheral)

    def transform(self, view: View, table: str | None = None) -> DataFrame:
        """The flat feature table; with `table`, also registered under that name."""
        flat = self._flat(self._view(view))
        if table:
            flat.createOrReplaceTempView(table)
        return flat

    def predict(self, view: View) -> DataFrame:
        return self.predictors[0].predict(self._flat(self._view(view)))

    def score(self, view: View) -> DataFrame:
        """One row of metrics, averaged over the targets."""
        predicted = self.predict(view)
        score = metrics.classification_scores if self.predictors[0].is_classifier else metrics.regression_scores
        return metrics.mean_over_targets([score(predicted, t, f"prediction__{t}") for t in self.targets])

    # ---- inspection -------------------------------------------------------------------

    def features(self) -> list[Feature]:
        return [replace(f, name=f"{f.name}__for_{t}") if t else f for t, learner in self._learners for f in learner.features()]

    def importances(self, target_num: int = 0) -> dict[str, float]:
        return self.predictors[0].importances(self.targets[target_num])

    def column_importances(self, target_num: int = 0) -> dict[str, float]:
        own = [Feature(c, (), c, (f"population.{c}",)) for c in self.columns if c not in {f.name for f in self.features()}]
        return select.column_importances([*self.features(), *own], self.importances(target_num))

    def correlations(self, view: View, target_num: int = 0) -> dict[str, float]:
        return correlations(self.transform(view), self.columns, self.targets[target_num])

    def catalogue(self, view: View, target_num: int = 0) -> Catalogue:
        known = {f.name: f for f in self.features()}
        corr, imp = self.correlations(view, target_num), self.importances(target_num) if self.predictors else {}
        rows = []
        for c in self.columns:
            f = known.get(c, Feature(c, (), c, (f"population.{c}",)))
            rows.append((c, f.sql, list(f.columns), imp.get(c), corr.get(c)))
        spark = view.population.sparkSession
        schema = "name string, sql string, columns array<string>, importance double, correlation double"
        return Catalogue(spark.createDataFrame(rows, schema))


def _looks(learner) -> bool:
    """Whether what a learner finds depends on the target."""
    return not isinstance(learner, Propositionalizer) or bool(learner.num_features or learner.num_subfeatures)


def words_table(column: str) -> str:
    return f"words_of_{column}"


def _with_words(model: DataModel, step: prep.TextFieldSplitter) -> DataModel:
    """The model with the words of each text column as a further many-to-many table."""
    population = Placeholder(model.population.name, model.population.row_id, list(model.population.joins))
    for c in step.columns:
        population.join(Placeholder(words_table(c)), on=list(step.row_id))
    return DataModel(population)


class Catalogue:
    """The features as a table: one row per feature, so small by construction."""

    def __init__(self, table: DataFrame):
        self.table = table

    def sort(self, by: str = "importance", descending: bool = True) -> Catalogue:
        key = F.abs(F.col(by)) if by == "correlation" else F.col(by)
        return Catalogue(self.table.orderBy(key.desc_nulls_last() if descending else key.asc_nulls_last(), "name"))

    def filter(self, condition: Callable | str) -> Catalogue:
        """A predicate over columns, or a piece of SQL text the feature must contain."""
        cond = F.col("sql").contains(condition) if isinstance(condition, str) else condition(self.table)
        return Catalogue(self.table.where(cond))

    def first(self, n: int) -> Catalogue:
        return Catalogue(self.table.limit(n))

    def find(self, name: str) -> DataFrame:
        return self.table.where(F.col("name") == name)


def tune(pipeline: Pipeline, train: View, validation: View, grid: dict[str, list]) -> dict:
    """Best predictor settings on the fixed validation split; features are computed once."""
    fit_rows = pipeline.transform(train).persist()
    check_rows = pipeline.transform(validation).persist()
    base = pipeline.predictors[0]
    results = []
    for values in product(*grid.values()):
        params = dict(zip(grid, values))
        fitted = base.copy(**params).fit(fit_rows, pipeline.columns, pipeline.targets)
        results.append((_quality(fitted, check_rows, pipeline.targets), params, fitted))
    fit_rows.unpersist()
    check_rows.unpersist()
    best = max(results, key=lambda r: r[0])
    pipeline.predictors[0] = best[2]
    return {"score": best[0], "params": best[1], "tried": [(s, p) for s, p, _ in results]}


def _quality(predictor: Predictor, rows: DataFrame, targets: list[str]) -> float:
    predicted = predictor.predict(rows)
    if predictor.is_classifier:
        parts = [metrics.auc(predicted, t, f"prediction__{t}") for t in targets]
        return metrics.mean_over_targets(parts).first()["auc"] or 0.0
    parts = [metrics.regression_scores(predicted, t, f"prediction__{t}") for t in targets]
    return metrics.mean_over_targets(parts).first()["rsquared"] or 0.0


def sweep(build: Callable[..., Pipeline], grid: dict[str, list], train: View, validation: View, targets: list[str], accuracy: Callable) -> dict:
    """Fit one pipeline per combination, keep the best by validation accuracy.

    `accuracy(pipeline, validation)` gives the number to maximise.
    """
    results = []
    held = [view.population.persist() for view in (train, validation) if not view.population.is_cached]  # every combination starts from them
    for values in product(*grid.values()):
        params = dict(zip(grid, values))
        pipe = build(**params).fit(train, targets)
        results.append((accuracy(pipe, validation), params, pipe))
    for rows in held:
        rows.unpersist()
    best = max(results, key=lambda r: r[0])
    return {"score": best[0], "params": best[1], "pipeline": best[2], "tried": [(s, p) for s, p, _ in results]}
