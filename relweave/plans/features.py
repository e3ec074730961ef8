"""Feature compiler: data model -> a few aggregations -> one flat table.

All features of one relation and time bound come from one statement. Lookups are
folded into their parent, inner tables are aggregated before outer ones, and the
results meet the population by key or by row id. Nothing is computed per feature.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import aggregates as A
from ..functions.aggregates import MERGEABLE, Agg
from ..operators import grouping, interval, moments, skew
from ..operators import roles as R
from ..session import checkpoint
from .model import DataModel, Join, Placeholder, View

LINEAR = ("AVG", "MIN", "MAX", "FIRST", "LAST")  # left - AGG(right) equals AGG(left - right) up to min/max


@dataclass(frozen=True)
class Feature:
    """A feature and where it comes from."""

    name: str
    path: tuple[str, ...]
    sql: str
    columns: tuple[str, ...]  # "table.column" of every source


@dataclass
class Relation:
    """One compiled join: its right side, bounds and aggregates."""

    join: Join
    path: tuple[str, ...]
    right: DataFrame
    aggs: list[Agg]
    sources: dict[str, tuple[str, ...]]
    plan: interval.IntervalJoin | None = None
    comparisons: list[tuple[str, str, str]] = field(default_factory=list)  # (name, left column, feature)
    equal: tuple[str, str] | None = None  # left and right category that must agree

    @property
    def prefix(self) -> str:
        return "__".join(self.path)


def resolve(place: Placeholder, tables: dict[str, DataFrame], spec: Propositionalizer, path: tuple[str, ...]):
    """A placeholder's rows with lookups folded in and inner tables as sub-features."""
    df = tables[place.name]
    sources = {c: (f"{place.name}.{c}",) for c in df.columns}
    for join in place.joins:
        right, inner = resolve(join.right, tables, spec, (*path, join.right.name))
        if join.is_lookup:
            df, added = fold_lookup(df, right, join)
            sources.update({new: inner[old] for old, new in added.items()})
        else:
            relation = spec.relation(df, join, right, inner, (*path, join.right.name), row_id=place.row_id)
            kept = spec.kept.get(relation.path)
            if kept is not None:
                relation.aggs = [a for a in relation.aggs if a.alias in kept]
            spec.nested[(*path, join.right.name)] = relation
            df = attach(df, place.row_id, relation)
            names = feature_names(relation)
            for agg in relation.aggs:
                sources[names[agg.alias]] = tuple(s for c in _used(agg) for s in relation.sources.get(c, ()))
            learnt = {a.alias for a in spec.extra.get(relation.path, ())}
            learnt |= {a.alias for a in relation.aggs if learnt and a.func == "COUNT" and a.condition is None}  # the rows outside a condition
            for agg in relation.aggs:
                above = agg.func == "SUM" and any(right.schema[c].metadata.get("learnt") for c in _used(agg))
                df = df.withMetadata(names[agg.alias], {"role": R.NUMERICAL, "derived": True, "learnt": above or agg.alias in learnt})
    if spec.shared and any(not j.is_lookup for j in place.joins):
        # several statements read these rows; compute the inner aggregates once
        df = shared_rows(df)
    spec.columns[path], spec.rows[path] = df.columns, df
    return df, sources


def shared_rows(df: DataFrame) -> DataFrame:
    out = checkpoint(df)
    for f in df.schema.fields:
        if f.metadata:
            out = out.withMetadata(f.name, f.metadata)
    return out


def fold_lookup(left: DataFrame, right: DataFrame, join: Join) -> tuple[DataFrame, dict[str, str]]:
    """many-to-one / one-to-one: the columns of the right table move to the left one.

    The rows of a key are counted on the way; a second one fails the job, as every row of the left
    table would be there twice.
    """
    keys = [r for _, r in join.on]
    names = {c: f"{join.right.name}__{c}" for c in right.columns if c not in keys}
    keyed = [F.col(f"`{r}`").alias(l) for l, r in join.on]
    whole = F.struct(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]) if names else F.struct(F.lit(True))
    grouped = right.select(*keyed, whole.alias("__row")).dropna(subset=[l for l, _ in join.on]).groupBy(*[F.col(f"`{l}`") for l, _ in join.on])
    text = F.concat(F.lit(f"{join.right.name}: several rows of the lookup have the key "), F.to_json(F.struct(*[F.col(f"`{l}`") for l, _ in join.on])))
    one = grouped.agg(F.count(F.lit(1)).alias("__n"), F.first("__row").alias("__row")).withColumn("__row", F.when(F.col("__n") > 1, F.raise_error(text)).otherwise(F.col("__row")))
    moved = one.select(*[F.col(f"`{l}`") for l, _ in join.on], *[F.col("__row")[n].alias(n, metadata=right.schema[c].metadata) for c, n in names.items()])
    return skew.skew_join(left, moved, [l for l, _ in join.on], "left"), names


def feature_names(relation: Relation) -> dict[str, str]:
    return {a.alias: f"{relation.prefix}__{a.alias}" for a in relation.aggs}


def _used(agg: Agg) -> list[str]:
    text = f"{agg.column or ''} {agg.condition or ''}"
    return [part for i, part in enumerate(text.split("`")) if i % 2]


def aggregate(left: DataFrame, relation: Relation) -> DataFrame:
    """Row id + features of a time-bounded relation."""
    plan = replace(relation.plan, aggs=tuple(relation.aggs))
    return interval.interval_aggregate(left, relation.right, plan)


def attach(left: DataFrame, row_id, relation: Relation, base: DataFrame | None = None) -> DataFrame:
    """Left rows with the relation's features appended; rows that share a row id stay rows of their own.

    `base` holds the same rows before anything was appended: plans of several relations then
    do not contain each other.
    """
    base = left if base is None else base
    names = feature_names(relation)
    if relation.plan is None:
        return grouping.join_aggregate(left, relation.right, relation.aggs, list(relation.join.on)).withColumnsRenamed(names)
    if not interval.unique_ids(base, row_id):
        held = interval.with_handle(left)
        plan = replace(relation.plan, aggs=tuple(relation.aggs), row_id=(f"`{interval.HANDLE}`",))
        found = interval.interval_aggregate(held, relation.right, plan, told_apart=True)
        return held.join(found, interval.HANDLE, "left").drop(interval.HANDLE).withColumnsRenamed(names)
    out = left.join(aggregate(base, relation), list(row_id), "left").withColumnsRenamed(names)
    out.__dict__["_unique_ids"] = dict(base.__dict__["_unique_ids"])  # the same rows
    return out


def compare(out: DataFrame, relation: Relation) -> DataFrame:
    """Same-unit comparisons: left value minus the aggregate of the right values."""
    return out.withColumns({n: F.col(f"`{l}`") - F.col(f"`{f}`") for n, l, f in relation.comparisons})


class Propositionalizer:
    """Every aggregate x column x relation, optionally under category conditions.

    `aggregation` names the aggregates, `n_most_frequent` adds conditions for the most
    frequent categories, `num_features` keeps those with the highest correlation to
    the target on a key-hash sample of share `sampling_factor`. `num_subfeatures` keeps, for
    each inner table, the aggregates whose outer features correlate most; both need a
    target to rank by, without one everything is kept. Targets of the right
    table are only used where the join allows lagged targets.
    """

    def __init__(
        self,
        aggregation: tuple[str, ...] = A.DEFAULT,
        num_features: int | None = None,
        n_most_frequent: int = 0,
        sampling_factor: float = 1.0,
        num_subfeatures: int | None = None,
        quantiles: tuple[float, ...] = (),
        half_lives: tuple[float, ...] = (),
        compare_units: bool = True,
        shared: bool = True,
    ):
        self.aggregation, self.num_features, self.n_most_frequent = aggregation, num_features, n_most_frequent
        self.sampling_factor, self.num_subfeatures = sampling_factor, num_subfeatures
        self.quantiles, self.half_lives, self.compare_units = quantiles, half_lives, compare_units
        self.shared = shared
        self._compiled: tuple | None = None
        self.nested: dict[tuple[str, ...], Relation] = {}  # inner relations by path
        self.kept: dict[tuple[str, ...], set[str]] = {}  # aggregates of inner relations, where they were ranked
        self.columns: dict[tuple[str, ...], list[str]] = {}  # columns of resolved tables by path
        self.rows: dict[tuple[str, ...], DataFrame] = {}  # resolved tables by path
        self.extra: dict[tuple[str, ...], list[Agg]] = {}  # learnt aggregates of inner relations by path
        self.relations: list[Relation] | None = None
        self.selected: list[str] | None = None
        self._categories: dict[tuple, list] = {}

    # ---- building -------------------------------------------------------------------

    def _numeric(self, column: str, condition: str | None, timed: bool, bounded: bool, tag: str = "") -> list[Agg]:
        out = []
        for func in self.aggregation:
            spec = MERGEABLE.get(func)
            if func in ("EWMA", "QUANTILE") or (func == "COUNT" and not condition):
                continue
            if spec and (spec.needs_time or spec.needs_now) and not timed:
                continue
            if not spec and timed and not bounded and func != "COUNT_DISTINCT":
                continue  # exact without a memory only for few distinct values
            out.append(Agg(func, f"`{column}`", condition, f"{func.lower()}__{column}{tag}"))
        if timed:
            out += [Agg("EWMA", f"`{column}`", condition, f"ewma_{h:g}__{column}{tag}", h) for h in self.half_lives]
        if bounded or not timed:
            for q in self.quantiles:
                out.append(Agg("QUANTILE", f"`{column}`", condition, f"q{q * 100:g}__{column}{tag}".replace(".", "_"), q))
        return out

    def relation(self, left: DataFrame, join: Join, right: DataFrame, sources, path, row_id=None) -> Relation:
        by_role = R.roles(right)
        keys = {r for _, r in join.on}
        timed, bounded = join.time_stamps is not None, join.memory is not None
        numeric = list(by_role[R.NUMERICAL])
        if join.lagged_targets:
            numeric += by_role[R.TARGET]
        aggs = [Agg("COUNT", name="count")] if "COUNT" in self.aggregation else []
        for c in numeric:
            aggs += self._numeric(c, None, timed, bounded)
        categorical = [c for c in by_role[R.CATEGORICAL] if c not in keys]
        inner = {f.name for f in right.schema.fields if f.metadata.get("derived")}
        for c in categorical:
            for func in A.CATEGORICAL:
                if func in self.aggregation and (not timed or bounded or func == "COUNT_DISTINCT"):
                    aggs.append(Agg(func, f"`{c}`", None, f"{func.lower()}__{c}"))
            for i, value in enumerate(self._frequent(right, c, path)):
                cond = f"`{c}` = {_literal(value)}"
                aggs.append(Agg("COUNT", None, cond, f"count__{c}_is{i}"))
                for x in numeric:
                    if x not in inner:
                        aggs += self._numeric(x, cond, timed, bounded, f"__{c}_is{i}")
        aggs += self.extra.get(path, [])
        relation = Relation(join, path, right, aggs, sources)
        if timed:
            rid = self._row_id if row_id is None else row_id
            relation.plan = interval.plan_interval(
                left, right, aggs, on=list(join.on), times=join.time_stamps, row_id=list(rid),
                horizon=join.horizon, memory=join.memory,
            )
        if self.compare_units:
            lu, ru = R.units(left), R.units(right)
            names = feature_names(relation)
            for unit in lu.keys() & ru.keys():
                for lc in lu[unit]:
                    for agg in aggs:
                        if agg.func in LINEAR and agg.condition is None and agg.column.strip("`") in ru[unit]:
                            if isinstance(left.schema[lc].dataType, T.NumericType):
                                relation.comparisons.append((f"{names[agg.alias]}__diff_{lc}", lc, names[agg.alias]))
        return relation

    def equalities(self, left: DataFrame, join: Join, right: DataFrame, sources, path) -> list[Relation]:
        """Same-unit categories: how many right rows have the left row's category. The categories are a further key of the join."""
        out = []
        lu, ru, keys = R.units(left), R.units(right), set(join.on)
        for unit in lu.keys() & ru.keys():
            for l in lu[unit]:
                for r in ru[unit]:
                    fields = left.schema[l], right.schema[r]
                    if (l, r) in keys or any(R.role_of(f) != R.CATEGORICAL for f in fields):
                        continue
                    relation = Relation(replace(join, on=(*join.on, (l, r))), (*path, f"equal_{l}_{r}"), right, [Agg("COUNT", name="count")], sources)
                    if join.time_stamps is not None:
                        relation.plan = interval.plan_interval(
                            left, right, relation.aggs, on=list(relation.join.on), times=join.time_stamps, row_id=list(self._row_id), horizon=join.horizon, memory=join.memory
                        )
                    relation.equal = (l, r)
                    out.append(relation)
        return out

    def _frequent(self, right: DataFrame, column: str, path) -> list:
        """Most frequent categories, learnt once: a distributed count and a bounded top-n."""
        if not self.n_most_frequent:
            return []
        key = (path, column)
        if key not in self._categories:
            counts = right.where(F.col(f"`{column}`").isNotNull()).groupBy(f"`{column}`").count()
            top = counts.orderBy(F.desc("count"), F.asc(f"`{column}`")).limit(self.n_most_frequent).collect()
            self._categories[key] = [r[0] for r in top]
        return self._categories[key]

    def _compile(self, model: DataModel, view: View) -> list[Relation]:
        """Relations of the model; the right sides are the same for every subset of a container."""
        tables = tuple(view.peripheral.items())
        if self._compiled is not None and self._compiled[0] is model and _same(self._compiled[1], tables):
            return self._compiled[2]
        out = []
        self._row_id = model.population.row_id
        for i, join in enumerate(model.population.joins):
            if join.is_lookup:
                continue
            rows, sources = resolve(join.right, view.peripheral, self, (join.right.name,))
            name = join.right.name
            same = sum(j.right.name == name for j in model.population.joins[:i])
            path = (f"{name}_{same + 1}" if same else name,)
            out.append(self.relation(view.population, join, rows, sources, path))
            if self.compare_units:
                out += self.equalities(view.population, join, rows, sources, path)
        self._compiled = (model, tables, out)
        return out

    # ---- fit / transform -----------------------------------------------------------

    def fit(self, model: DataModel, view: View, target: str | None = None) -> Propositionalizer:
        self._compiled, self.nested, self.kept = None, {}, {}
        self.relations = self._compile(model, view)
        self.selected = [f.name for f in self.features()]
        few = self.num_subfeatures
        if few and target and any(len(r.aggs) > few for r in self.nested.values()):
            self.kept = self._ranked_inner(self._merits(model, view, target), few)
            self._compiled, self.nested = None, {}
            self.relations = self._compile(model, view)
            self.selected = [f.name for f in self.features()]
        if self.num_features and target and len(self.selected) > self.num_features:
            ranked = self._merits(model, view, target)
            self.selected = [n for n, _ in sorted(ranked.items(), key=lambda p: (-p[1], p[0]))][: self.num_features]
        return self

    def _merits(self, model: DataModel, view: View, target: str) -> dict[str, float]:
        """Absolute correlation of every selected feature with the target."""
        rows = view.population
        if self.sampling_factor < 1:
            rows = sample_by_key(rows, model.population.row_id, self.sampling_factor)
        flat = self._features(model, View(rows, view.peripheral), [target])
        return {n: abs(r) for n, r in correlations(flat, self.selected, target).items()}

    def _ranked_inner(self, merits: dict[str, float], few: int) -> dict[tuple[str, ...], set[str]]:
        """The best aggregates of each inner relation; one is as good as the best feature made of it."""
        merits = dict(merits)
        inwards = [r for _, r in sorted(self.nested.items(), key=lambda p: len(p[0]))]
        for relation in [*self.relations, *inwards]:
            names = feature_names(relation)
            for agg in relation.aggs:
                for c in _used(agg):
                    merits[c] = max(merits.get(c, 0.0), merits.get(names[agg.alias], 0.0))
        out = {}
        for relation in inwards:
            names = feature_names(relation)
            order = sorted(relation.aggs, key=lambda a: -merits.get(names[a.alias], 0.0))
            out[relation.path] = {a.alias for a in order[:few]}
        return out

    def features(self) -> list[Feature]:
        out = []
        for relation in self.relations or []:
            names = feature_names(relation)
            for agg in relation.aggs:
                cols, sql = tuple(s for c in _used(agg) for s in relation.sources.get(c, ())), agg.describe()
                if relation.equal:
                    cols, sql = (*cols, f"population.{relation.equal[0]}", *relation.sources.get(relation.equal[1], ())), f"{sql} WHERE t1.{relation.equal[0]} = t2.{relation.equal[1]}"
                out.append(Feature(names[agg.alias], relation.path, sql, cols))
            for name, left, base in relation.comparisons:
                out.append(Feature(name, relation.path, f"t1.{left} - {base}", (f"population.{left}",)))
        return out

    def _features(self, model: DataModel, view: View, keep: list[str]) -> DataFrame:
        out = view.population
        wanted = set(self.selected)
        relations = self._compile(model, view)
        row_id = list(model.population.row_id)
        if relations and keep == row_id and all(r.plan is not None and not r.comparisons for r in relations) and interval.unique_ids(out, row_id):
            # every part has one row per population row already: no join with the population
            parts = []
            for relation in relations:
                names = feature_names(relation)
                used = [a for a in relation.aggs if names[a.alias] in wanted]
                if used:
                    parts.append(aggregate(out, replace(relation, aggs=used)).withColumnsRenamed(names))
            if parts:
                return combine(parts, row_id).select(*keep, *[F.col(f"`{c}`") for c in self.selected])
        for relation in relations:
            names = feature_names(relation)
            needed = wanted | {f for n, _, f in relation.comparisons if n in wanted}
            used = [a for a in relation.aggs if names[a.alias] in needed]
            if used:
                out = compare(attach(out, model.population.row_id, replace(relation, aggs=used), view.population), replace(
                    relation, comparisons=[c for c in relation.comparisons if c[0] in wanted]))
        return out.select(*keep, *[F.col(f"`{c}`") for c in self.selected])

    def transform(self, model: DataModel, view: View) -> DataFrame:
        """Row id and one column per selected feature, one row per population row."""
        return self._features(model, view, list(model.population.row_id))


def _same(a: tuple, b: tuple) -> bool:
    return len(a) == len(b) and all(x[0] == y[0] and x[1] is y[1] for x, y in zip(a, b))


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def sample_by_key(df: DataFrame, keys, share: float, seed: int = 1) -> DataFrame:
    """Rows whose key hash falls below `share`: the same rows in every run."""
    return df.where(F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000))


def correlations(df: DataFrame, columns: list[str], target: str) -> dict[str, float]:
    """Pearson correlation of every column with the target in one pass; missing values count as 0."""
    _, _, var, cov, _, var_y = moments.cross_moments(df, columns, F.col(f"`{target}`"))
    return dict(zip(columns, moments.pearson(var, cov, var_y).tolist()))


def combine(parts: list[DataFrame], row_id) -> DataFrame:
    """Outputs of several learners side by side, matched by row id."""
    return reduce(lambda a, b: a.join(b, list(row_id), "left"), parts)
