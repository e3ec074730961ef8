"""Feature learners that search for conditions instead of enumerating everything.

All three score every candidate of a level in a single aggregation over the
population; the driver only sees sums. The candidates themselves are conditional
aggregates compiled like any other feature, so time bounds and lookups work.
Conditions of inner tables are found by the residual of a first fit, carried down to
their rows (see pushdown.py), and join the candidates of the next.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import Agg
from ..operators import conditional, moments
from ..operators import roles as R
from ..session import checkpoint
from . import pushdown
from .features import Feature, Propositionalizer, Relation, _literal, attach, combine, feature_names, resolve
from .model import PROPOSITIONALIZATION, DataModel, Placeholder, View

SQUARE, CROSS_ENTROPY = "square", "cross_entropy"


def residual(target: str, score: Column, loss: str) -> Column:
    """Negative gradient of the loss at the current score."""
    y = F.col(target).cast("double")
    return y - score if loss == SQUARE else y - 1 / (1 + F.exp(-score))


class _Search:
    """Shared part: right sides, thresholds and candidate conditions."""

    def __init__(self, num_features: int, loss: str, n_thresholds: int, n_most_frequent: int, shrinkage: float, num_subfeatures: int):
        if loss not in (SQUARE, CROSS_ENTROPY):
            raise ValueError(f"unknown loss {loss}")
        self.num_features, self.loss, self.n_thresholds = num_features, loss, n_thresholds
        self.n_most_frequent, self.shrinkage, self.num_subfeatures = n_most_frequent, shrinkage, num_subfeatures
        self.extra: dict[tuple[str, ...], list[Agg]] = {}
        self._bounds: dict[int, dict[str, list[float]]] = {}  # thresholds by join and column
        self._tops: dict[tuple[int, str], list] = {}  # frequent categories

    subfeatures = ("COUNT", "AVG", "SUM", "MIN", "MAX")
    turns = 2

    def _relations(self, model: DataModel, view: View) -> list[Relation]:
        """Learnt relations; inner tables reach them as enumerated and learnt sub-features."""
        base = Propositionalizer(aggregation=(), compare_units=False)
        inner = Propositionalizer(aggregation=self.subfeatures, compare_units=False)
        inner.extra = self.extra
        base._row_id = inner._row_id = model.population.row_id
        out = []
        for join in model.population.joins:
            if join.is_lookup or join.relationship == PROPOSITIONALIZATION:
                continue
            rows, sources = resolve(join.right, view.peripheral, inner, (join.right.name,))
            probe = base.relation(view.population, join, rows, sources, (join.right.name,))
            out.append(probe)
        self.inner = inner
        return out

    def fit(self, model: DataModel, view: View, target: str) -> _Search:
        """Fit, then learn conditions of inner tables from what is left, and fit again with them."""
        self._fit_plain(model, view)
        self.extra, self._bounds, self._tops = {}, {}, {}
        self.relations = self._relations(model, view)
        # keys and target may hang on joins of their own: every turn starts from the same narrow rows
        rows = _needed(model, view, target).persist(StorageLevel.MEMORY_AND_DISK)
        rows.count()
        left = self._fit(model, rows, target)
        for _ in range(self.turns if self.num_subfeatures and any(_has_inner(r.join.right) for r in self.relations) else 0):
            if left is None:
                break
            found: dict[tuple[str, ...], list[Agg]] = {}
            for relation in self.relations:
                if not _has_inner(relation.join.right):
                    continue
                pushed = pushdown.carried(left, relation.join, relation.right)
                for path, aggs in pushdown.search(relation.join.right, pushed, self.inner, relation.path, self.conditions, self.num_subfeatures, self.extra).items():
                    found.setdefault(path, aggs)
            if not found:
                break
            self.extra = {p: [*self.extra.get(p, []), *found.get(p, [])] for p in {**self.extra, **found}}
            self.relations = self._relations(model, view)
            left = self._fit(model, rows, target)
        rows.unpersist()
        return self

    def _searches(self) -> bool:
        """Whether what a fit leaves is looked at again."""
        return bool(self.num_subfeatures) and any(_has_inner(r.join.right) for r in self.relations)

    def _left_over(self, model: DataModel, rows: DataFrame, score: _Score, target: str) -> DataFrame | None:
        """Keys of the population rows with their residual as gradient; None when (almost) nothing is left."""
        if not self._searches():
            return None
        if self.loss == SQUARE and score.gradient()[1] <= 1e-10 * score.moments.cov[-1, -1]:
            return None  # told by the sums alone
        gradient = residual(target, score.value(), self.loss).alias(pushdown.GRADIENT)
        left = checkpoint(rows.select(*_join_columns(model), gradient, F.lit(1.0).alias(pushdown.WEIGHT)))
        now, all_ = left.agg(F.var_pop(pushdown.GRADIENT)).first()[0], score.moments.cov[-1, -1] if self.loss == SQUARE else 0.25
        return None if not now or now <= 1e-9 * all_ else left

    def _fit_plain(self, model: DataModel, view: View) -> None:
        """Relations marked as plain are enumerated, not learnt."""
        joins = [j for j in model.population.joins if j.relationship == PROPOSITIONALIZATION]
        self._plain = DataModel(Placeholder(model.population.name, model.population.row_id, joins)) if joins else None
        self.plain = Propositionalizer().fit(self._plain, view) if joins else None

    def _with_plain(self, model: DataModel, view: View, learnt: DataFrame) -> DataFrame:
        if self.plain is None:
            return learnt
        return combine([learnt, self.plain.transform(self._plain, view)], model.population.row_id)

    def _plain_features(self) -> list[Feature]:
        return self.plain.features() if self.plain is not None else []

    def conditions(self, relation: Relation) -> list[str]:
        """Thresholds from approximate quantiles, and equality with frequent categories."""
        by_role = R.roles(relation.right)
        keys = {r for _, r in relation.join.on}
        numeric = by_role[R.NUMERICAL] + (by_role[R.TARGET] if relation.join.lagged_targets else [])
        out = []
        if numeric and self.n_thresholds:
            shares = [(i + 1) / (self.n_thresholds + 1) for i in range(self.n_thresholds)]
            known = self._bounds.setdefault(id(relation.join), {})  # later turns only add columns
            new = [c for c in numeric if c not in known]
            if new:
                row = relation.right.agg(*[F.percentile_approx(F.col(f"`{c}`"), shares, 10000).alias(c) for c in new]).first()
                known.update({c: sorted(set(row[c] or [])) for c in new})
            for c in numeric:
                out += [f"`{c}` > {v!r}" for v in known[c]]
        for c in by_role[R.CATEGORICAL]:
            if c in keys:
                continue
            if (id(relation.join), c) not in self._tops:
                counts = relation.right.where(F.col(f"`{c}`").isNotNull()).groupBy(f"`{c}`").count()
                top = counts.orderBy(F.desc("count"), F.asc(f"`{c}`")).limit(self.n_most_frequent).collect()
                self._tops[id(relation.join), c] = [r[0] for r in top]
            out += [f"`{c}` = {_literal(v)}" for v in self._tops[id(relation.join), c]]
        return out

    def _attach(self, model: DataModel, rows: DataFrame, relation: Relation, aggs: list[Agg]) -> tuple[DataFrame, list[str]]:
        rel = replace(relation, aggs=aggs)
        out = attach(rows, model.population.row_id, rel)
        names = [feature_names(rel)[a.alias] for a in aggs]
        return out.fillna(0.0, subset=names), names

    def _attach_array(self, model: DataModel, rows: DataFrame, relation: Relation, aggs: list[Agg], name: str) -> tuple[DataFrame, DataFrame, list[str]]:
        """All aggregates as one array column, and the rows that are worth keeping for another pass."""
        plan = relation.plan and replace(relation.plan, aggs=tuple(aggs))
        found = conditional.sums(rows, relation.right, aggs, list(relation.join.on), name, plan)
        if found is not None:
            names = feature_names(replace(relation, aggs=aggs))
            return *found, [names[a.alias] for a in aggs]
        out, names = self._attach(model, rows, relation, aggs)
        out = out.select(*[F.col(f"`{c}`") for c in rows.columns], F.array(*[moments.clean(c) for c in names]).alias(name))
        return out, out, names


class ConditionSearch(_Search):
    """AGG(column) WHERE condition; the best absolute correlation with the residual wins."""

    def __init__(self, num_features: int = 5, loss: str = SQUARE, aggregation=("AVG", "SUM", "COUNT", "MIN", "MAX"),
                 n_thresholds: int = 7, n_most_frequent: int = 5, shrinkage: float = 1.0, num_subfeatures: int = 3):
        super().__init__(num_features, loss, n_thresholds, n_most_frequent, shrinkage, num_subfeatures)
        self.aggregation = aggregation

    def _fit(self, model: DataModel, rows: DataFrame, target: str) -> DataFrame | None:
        self.chosen: list[tuple[int, Agg]] = []
        if not self.relations:
            return None
        candidates: dict[str, tuple[int, Agg]] = {}
        parts: list[tuple[str, list[str]]] = []
        for i, relation in enumerate(self.relations):
            aggs = self._candidates(relation)
            rows, held, names = self._attach_array(model, rows, relation, aggs, f"__a{i}")
            parts.append((f"__a{i}", names))
            candidates.update({n: (i, a) for n, a in zip(names, aggs)})
        held.persist(StorageLevel.MEMORY_AND_DISK)
        names = list(candidates)
        fitted = _Score(rows, parts, target, self.loss)
        for _ in range(min(self.num_features, len(names))):
            gradient, var_r = fitted.gradient()
            r = np.abs(moments.pearson(fitted.var, gradient, var_r))
            r[[names.index(n) for n in fitted.used]] = 0.0
            best = int(np.argmax(r))
            if r[best] <= 1e-6:
                break
            self.chosen.append(candidates[names[best]])
            fitted.add({names[best]: gradient[best] / fitted.var[best]}, self.shrinkage)
        left = self._left_over(model, rows, fitted, target)
        held.unpersist()
        return left

    def _candidates(self, relation: Relation) -> list[Agg]:
        by_role = R.roles(relation.right)
        numeric = by_role[R.NUMERICAL] + (by_role[R.TARGET] if relation.join.lagged_targets else [])
        out, conditions = [], self.conditions(relation)
        for k, cond in enumerate([None, *[c for base in conditions for c in (base, f"NOT ({base})")]]):
            for func in self.aggregation:
                if func == "COUNT":
                    out.append(Agg("COUNT", None, cond, f"count__c{k}"))
                else:
                    out += [Agg(func, f"`{c}`", cond, f"{func.lower()}__{c}__c{k}") for c in numeric]
        return out

    def features(self) -> list[Feature]:
        return [*self.learnt_features(), *self._plain_features()]

    def learnt_features(self) -> list[Feature]:
        out = []
        for i, agg in self.chosen:
            relation = self.relations[i]
            cols = tuple(s for c in _names(agg) for s in relation.sources.get(c, ()))
            out.append(Feature(f"{relation.prefix}__{agg.alias}", relation.path, agg.describe(), cols))
        return out

    def pieces(self) -> list[tuple[Relation, list[Agg], dict[str, list[tuple[str, float]]]]]:
        """Relations, their aggregates, and the features as weighted sums of the attached columns."""
        out = []
        for i, relation in enumerate(self.relations):
            aggs = [a for j, a in self.chosen if j == i]
            if aggs:
                names = feature_names(replace(relation, aggs=aggs))
                out.append((relation, aggs, {names[a.alias]: [(names[a.alias], 1.0)] for a in aggs}))
        return out

    def transform(self, model: DataModel, view: View) -> DataFrame:
        rows = view.population
        for relation, aggs, _ in self.pieces():
            rows, _ = self._attach(model, rows, relation, aggs)
        learnt = rows.select(*model.population.row_id, *[F.col(f"`{f.name}`") for f in self.learnt_features()])
        return self._with_plain(model, view, learnt)


def _has_inner(place: Placeholder) -> bool:
    """Whether a table has tables below it that are aggregated."""
    return any(not j.is_lookup or _has_inner(j.right) for j in place.joins)


def _join_columns(model: DataModel) -> list[str]:
    """Row id and the columns of the population that the joins use."""
    joins = model.population.joins
    used = {l for j in joins for l, _ in j.on} | {j.time_stamps[0] for j in joins if j.time_stamps}
    return list(dict.fromkeys([*model.population.row_id, *sorted(used)]))


def _needed(model: DataModel, view: View, target: str) -> DataFrame:
    """Row id, target and the columns the joins use."""
    rows = view.population.select(*dict.fromkeys([*_join_columns(model), target]))
    return rows.where(F.col(target).isNotNull())


def _names(agg: Agg) -> list[str]:
    text = f"{agg.column or ''} {agg.condition or ''}"
    return [p for i, p in enumerate(text.split("`")) if i % 2]


class _Score:
    """Current score as a linear function of candidate columns, and its gradient.

    The covariances of all candidates are summed once. With the square loss every
    later residual is linear in them, so no further pass over the rows is needed; the
    cross entropy needs one pass per round, for the covariances with the residual.
    """

    def __init__(self, rows: DataFrame, parts: list[tuple[str, list[str]]], target: str, loss: str):
        """`parts` are the array columns of `rows` with the names of their items."""
        self.rows, self.parts, self.target, self.loss = rows, parts, target, loss
        names = self.names = [n for _, part in parts for n in part]
        self.moments = moments.covariances(rows, [*names, target], F.concat(*self.arrays(), F.array(moments.clean(target))))
        self.var = np.maximum(np.diag(self.moments.cov)[:-1], 0.0)
        self.weights = np.zeros(len(names))
        mean = float(self.moments.mean[-1])
        self.constant = mean if loss == SQUARE else 0.0
        self.used: list[str] = []

    def arrays(self) -> list[Column]:
        return [F.col(c) for c, _ in self.parts]

    def value(self) -> Column:
        """The current score of a row."""
        return _total([x * F.lit(float(w)) for x, w in zip(self.items().values(), self.weights) if w]) + F.lit(self.constant)

    def items(self) -> dict[str, Column]:
        return {n: F.col(c)[i] for c, part in self.parts for i, n in enumerate(part)}

    def gradient(self) -> tuple[np.ndarray, float]:
        """Covariance of each candidate with the residual, and the residual's variance."""
        if self.loss == SQUARE:
            full = np.append(-self.weights, 1.0)
            cov = self.moments.cov @ full
            return cov[:-1], float(max(full @ cov, 0.0))
        y = residual(self.target, self.value(), self.loss)
        _, _, _, cov, mean, var = moments.cross_moments(self.rows, self.names, y, F.concat(*self.arrays(), F.array(y)))
        self.constant += 4.0 * mean
        return cov, var

    def add(self, weights: dict[str, float], shrinkage: float) -> None:
        scale = shrinkage if self.loss == SQUARE else 4.0 * shrinkage
        for name, w in weights.items():
            i = self.names.index(name)
            self.weights[i] += scale * w
            self.constant -= scale * w * float(self.moments.mean[i])
            self.used.append(name)


@dataclass
class Leaf:
    """A part of the right rows and the weights of its atoms."""

    condition: str | None
    weights: np.ndarray


class BoostedAggregates(_Search):
    """Boosted sums of learnt weights over the right rows.

    A tree splits the right rows by conditions; a leaf contributes, per right row, a
    constant (`linear=False`) or a linear function of the numerical columns
    (`linear=True`). Summed over the right rows a leaf is weights x (count, sum x1,
    sum x2 ...), so the best weights for a split solve small normal equations whose
    entries are sums over the population: no pass per weight, and linear in the number
    of columns. Each tree fits the residual of the trees before it.
    """

    def __init__(self, num_features: int = 5, loss: str = SQUARE, linear: bool = False, max_depth: int = 1, min_num_samples: int = 1,
                 n_thresholds: int = 7, n_most_frequent: int = 5, shrinkage: float = 1.0, reg_lambda: float = 0.0, num_subfeatures: int = 3):
        super().__init__(num_features, loss, n_thresholds, n_most_frequent, shrinkage, num_subfeatures)
        self.linear, self.max_depth, self.min_num_samples, self.reg_lambda = linear, max_depth, min_num_samples, reg_lambda

    def _atoms(self, relation: Relation, condition: str | None, tag: str) -> list[Agg]:
        atoms = [Agg("COUNT", None, condition, f"n__{tag}")]
        by_role = R.roles(relation.right)
        if self.linear:
            numeric = by_role[R.NUMERICAL] + (by_role[R.TARGET] if relation.join.lagged_targets else [])
        else:  # inner rows that meet a learnt condition have weights of their own
            numeric = [c for c in by_role[R.NUMERICAL] if relation.right.schema[c].metadata.get("learnt")]
        return atoms + [Agg("SUM", f"`{c}`", condition, f"s_{c}__{tag}") for c in numeric]

    def _fit(self, model: DataModel, rows: DataFrame, target: str) -> DataFrame | None:
        self.trees: list[tuple[int, list[Leaf]]] = []
        if not self.relations:
            return None
        base, splits, parts, searched, narrow = {}, {}, [], [], rows
        conditions = [self.conditions(r) for r in self.relations]
        for i, relation in enumerate(self.relations):
            groups = [("all", None)] + [(f"c{k}", c) for k, c in enumerate(conditions[i])]
            aggs = [a for tag, cond in groups for a in self._atoms(relation, cond, tag)]
            rows, held, names = self._attach_array(model, rows, relation, aggs, f"__a{i}")
            parts.append((f"__a{i}", names))
            searched.append(aggs)
            width = len(aggs) // len(groups)
            base[i] = names[:width]
            splits[i] = {c: names[width * (k + 1) : width * (k + 2)] for k, c in enumerate(conditions[i])}
        held.persist(StorageLevel.MEMORY_AND_DISK)
        score = _Score(rows, parts, target, self.loss)
        deep: list[tuple[int, list[Leaf], dict[str, float]]] = []
        for number in range(self.num_features):
            gradient, _ = score.gradient()
            slopes = dict(zip(score.names, gradient))
            found = [(i, self._best(score.moments, base[i], splits[i], slopes)) for i in base]
            found = [(i, f) for i, f in found if f is not None]
            if not found:
                break
            i, (_, cond, weights) = max(found, key=lambda p: p[1][0])
            columns = [*base[i], *splits[i][cond]]
            score.add(dict(zip(columns, weights)), self.shrinkage)
            width = len(base[i])
            # atoms of the split and of its parent: matched rows get both weights, the others the parent's
            leaves = [Leaf(cond, weights[:width] + weights[width:]), Leaf(f"NOT coalesce({cond}, false)", weights[:width])]
            for depth in range(1, self.max_depth):
                leaves = self._deepen(model, rows, i, leaves, conditions[i], target, score, depth)
            self.trees.append((i, leaves))
            if self.max_depth > 1 and len(leaves) > 2 and (number + 1 < self.num_features or self._searches()):
                deep.append((i, leaves, dict(zip(columns, weights))))
                held.unpersist()
                rows, held, score = self._rebase(model, narrow, searched, deep, target, score)
        left = self._left_over(model, rows, score, target)
        held.unpersist()
        return left

    def _deepen(self, model, rows, i, leaves, conditions, target, score, depth) -> list[Leaf]:
        """Split every leaf again; one aggregation and one pass for all leaves of a level."""
        relation = self.relations[i]
        aggs, parts = [], []
        for number, leaf in enumerate(leaves):
            parts.append((leaf, None, len(aggs)))
            aggs += self._atoms(relation, leaf.condition, f"d{depth}_{number}")
            for k, c in enumerate(conditions):
                parts.append((leaf, c, len(aggs)))
                aggs += self._atoms(relation, f"({leaf.condition}) AND ({c})", f"d{depth}_{number}_{k}")
        # only the residual of the rows goes along
        rows = rows.select(*_join_columns(model), residual(target, score.value(), self.loss).alias("__r")).persist(StorageLevel.MEMORY_AND_DISK)
        wide, _, names = self._attach_array(model, rows, relation, aggs, "__d")
        found = moments.covariances(wide, [*names, "__r"], F.concat("__d", F.array(moments.clean("__r"))))
        rows.unpersist()
        slopes = dict(zip(names, found.cov[:-1, -1]))
        width = len(leaves[0].weights)
        at = {(id(leaf), c): names[p : p + width] for leaf, c, p in parts}
        out = []
        for leaf in leaves:
            best = self._best(found, at[id(leaf), None], {c: at[id(leaf), c] for c in conditions}, slopes)
            if best is None:
                out.append(leaf)
                continue
            _, c, w = best
            out.append(Leaf(f"({leaf.condition}) AND ({c})", leaf.weights + w[:width] + w[width:]))
            out.append(Leaf(f"({leaf.condition}) AND NOT coalesce({c}, false)", leaf.weights + w[:width]))
        return out

    def _rebase(self, model, rows, searched, deep, target, score):
        """Bring the values of deep trees to the rows: later trees must fit what they leave.

        `rows` are narrow; what was `searched` is summed again along with the leaves, so that no
        array goes through a shuffle.
        """
        parts, starts = [], {}
        for i, relation in enumerate(self.relations):
            aggs = list(searched[i])
            for t, (j, leaves, _) in enumerate(deep):
                if j == i:
                    starts[t] = len(aggs)
                    aggs += [a for k, leaf in enumerate(leaves) for a in self._atoms(relation, leaf.condition, f"t{t}_{k}")]
            rows, held, _ = self._attach_array(model, rows, relation, aggs, f"__a{i}")
        held.persist(StorageLevel.MEMORY_AND_DISK)
        items = score.items()
        for t, (i, leaves, replaced) in enumerate(deep):
            weights = np.concatenate([leaf.weights for leaf in leaves])
            value = _total([F.col(f"__a{i}")[starts[t] + k] * F.lit(float(w)) for k, w in enumerate(weights) if w])
            value = value - _total([items[c] * F.lit(float(w)) for c, w in replaced.items() if w])
            rows = rows.withColumn(f"__t{t}", F.array(moments.clean(value)))
            parts.append((f"__t{t}", [f"__t{t}"]))
        rows = rows.withColumns({f"__a{i}": F.slice(f"__a{i}", 1, len(aggs)) for i, aggs in enumerate(searched)})
        renewed = _Score(rows, [*score.parts[: len(searched)], *parts], target, self.loss)
        renewed.weights[: len(score.names)] = score.weights
        renewed.constant, renewed.used = score.constant, score.used
        renewed.add({f"__t{len(deep) - 1}": 1.0}, self.shrinkage)
        return rows, held, renewed

    def _best(self, stats: moments.Moments, base: list[str], splits: dict[str, list[str]], slopes: dict[str, float]):
        """Condition whose normal equations explain most of the residual, and its weights."""
        best = None
        total = stats.mean[stats.index[base[0]]] * stats.n
        for cond, names in splits.items():
            matched = stats.mean[stats.index[names[0]]] * stats.n
            if min(matched, total - matched) < self.min_num_samples:
                continue
            columns = [*base, *names]
            gram = stats.block(columns, columns) + np.eye(len(columns)) * self.reg_lambda / max(stats.n, 1)
            rhs = np.array([slopes[c] for c in columns])
            size = np.sqrt(np.maximum(np.diag(gram), 0.0))
            scale = np.divide(1.0, size, out=np.zeros_like(size), where=size > 0)  # columns differ by many orders of magnitude
            weights = scale * np.linalg.lstsq(gram * np.outer(scale, scale), rhs * scale, rcond=1e-10)[0]
            gain = float(weights @ rhs)
            if np.isfinite(gain) and gain > 1e-9 and (best is None or gain > best[0]):
                best = (gain, cond, weights)
        return best

    def features(self) -> list[Feature]:
        return [*self.learnt_features(), *self._plain_features()]

    def learnt_features(self) -> list[Feature]:
        out = []
        for number, (i, leaves) in enumerate(self.trees):
            relation = self.relations[i]
            atoms = [a for a in self._atoms(relation, None, "x")]
            arms = []
            for leaf in leaves:
                terms = [f"{w:.6g}" if a.func == "COUNT" else f"{w:.6g} * {a.column}" for a, w in zip(atoms, leaf.weights)]
                arms.append(f"WHEN {leaf.condition} THEN {' + '.join(terms)}")
            sql = f"SUM(CASE {' '.join(arms)} END)"
            used = {c for part in [sql] for j, c in enumerate(part.split("`")) if j % 2}
            cols = tuple(s for c in sorted(used) for s in relation.sources.get(c, ()))
            out.append(Feature(f"{relation.prefix}__boosted_{number + 1}", relation.path, sql, cols))
        return out

    def pieces(self) -> list[tuple[Relation, list[Agg], dict[str, list[tuple[str, float]]]]]:
        """Relations, their aggregates, and the features as weighted sums of the attached columns."""
        out, named = [], [f.name for f in self.learnt_features()]
        for i, relation in enumerate(self.relations):
            aggs, parts = [], {}
            for number, (j, leaves) in enumerate(self.trees):
                for k, leaf in enumerate(leaves if j == i else []):
                    atoms = self._atoms(relation, leaf.condition, f"t{number}_{k}")
                    parts.setdefault(named[number], []).extend((a.alias, float(w)) for a, w in zip(atoms, leaf.weights))
                    aggs += atoms
            if aggs:
                names = feature_names(replace(relation, aggs=aggs))
                out.append((relation, aggs, {f: [(names[a], w) for a, w in terms] for f, terms in parts.items()}))
        return out

    def transform(self, model: DataModel, view: View) -> DataFrame:
        rows = view.population
        weights: dict[str, Column] = {}
        for relation, aggs, features in self.pieces():
            rows, _ = self._attach(model, rows, relation, aggs)
            weights.update({f: _linear([c for c, _ in terms], [w for _, w in terms]) for f, terms in features.items()})
        learnt = rows.select(*model.population.row_id, *[weights[f.name].alias(f.name) for f in self.learnt_features()])
        return self._with_plain(model, view, learnt)


def _linear(columns: list[str], weights) -> Column:
    return _total([F.col(f"`{c}`") * F.lit(float(w)) for c, w in zip(columns, weights) if w])


def _total(terms: list[Column]) -> Column:
    terms = terms or [F.lit(0.0)]
    while len(terms) > 1:  # a balanced sum: long chains are too deep for the code generator
        terms = [reduce(operator.add, terms[i : i + 2]) for i in range(0, len(terms), 2)]
    return terms[0]
