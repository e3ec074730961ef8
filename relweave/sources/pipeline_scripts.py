"""A fitted pipeline as Spark SQL files: preparation, features, selection and predictions.

What was learnt becomes text: thresholds, weights, means, trees. Only mappings stay tables,
as they may have many rows; they are stored beside the scripts. The population and the
peripheral tables must be registered under their names; the views FEATURES and
PREDICTIONS are what `transform` and `predict` give.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from ..operators import prep
from ..plans import mapping, predict
from ..plans.features import Propositionalizer, _literal
from ..plans.flow import Pipeline, words_table
from ..plans.model import View
from .scripts import _Writer, save_scripts


def total(terms: list[str]) -> str:
    """A balanced sum: long chains are too deep for the parser."""
    if len(terms) <= 2:
        return " + ".join(terms) or "0D"
    half = len(terms) // 2
    return f"({total(terms[:half])}) + ({total(terms[half:])})"


def number(x: float) -> str:
    return f"{float(x)!r}D" if abs(x) != float("inf") else f"CAST('{'-' if x < 0 else ''}Infinity' AS DOUBLE)"


def present(column: str) -> str:
    """A number as the predictors see it: missing values count as 0."""
    return f"coalesce(nanvl(CAST(`{column}` AS DOUBLE), NULL), 0D)"


# ---- preparation


def prepared_columns(step, df: DataFrame) -> dict[str, str]:
    """New or replaced columns of a fitted preprocessor as SQL; `df` is the table before it."""
    if isinstance(step, prep.Seasonal):
        return {f"{p}__{c}": f"CAST({p}(`{c}`) AS STRING)" for c in step.columns for p in step.parts}
    if isinstance(step, prep.Substring):
        return {f"{c}__{step.begin}_{step.begin + step.length}": f"substring(`{c}`, {step.begin + 1}, {step.length})" for c in step.columns}
    if isinstance(step, prep.Imputation):
        out = {}
        for c, mean in step.means.items():
            x = f"nanvl(CAST(`{c}` AS DOUBLE), NULL)"
            out[c] = x if mean is None else f"coalesce({x}, {number(mean)})"
            if step.add_dummies:
                out[f"{c}__missing"] = f"CAST({x} IS NULL AS DOUBLE)"
        return out
    raise TypeError(f"{type(step).__name__} has no SQL form")


def replaced(source: str, columns: list[str], new: dict[str, str]) -> str:
    parts = [f"{new[c]} AS `{c}`" if c in new else f"`{c}`" for c in columns]
    parts += [f"{sql} AS `{c}`" for c, sql in new.items() if c not in columns]
    return f"SELECT {', '.join(parts)}\nFROM {source}"


class _PipelineWriter(_Writer):
    """Statements of a fitted pipeline; `stored` collects tables to be saved beside them."""

    def __init__(self, pipe: Pipeline, view: View, folder: str):
        super().__init__(None, view.peripheral)
        self.pipe, self.data, self.folder = pipe, view, folder
        self.stored: dict[str, DataFrame] = {}

    def table(self, name: str, df: DataFrame) -> str:
        """A view that is resolved once; a path in a query would be read again by every statement above it."""
        self.stored[name] = df
        name, path = f"{self.tag}{name}", f"{self.folder}/{name}".replace("\\", "\\\\").replace("'", "\\'")
        self.statements.append((name, f"CREATE OR REPLACE TEMP VIEW {name} USING parquet OPTIONS (path '{path}')"))
        return name

    def prepare(self, source: str) -> str:
        """The population after lookups and preprocessors; prepared tables get a view each."""
        for i, (join, spec) in enumerate(self.pipe._folded):
            self.spec, self.tag = spec, f"lookup{i}__"
            inner = self.stage(join.right, (join.right.name,))
            source = self.lookup(source, inner, join, "population", ())
        self.spec, self.tag = None, ""
        frames = {"": self.pipe.prepared(self.data), **self.data.peripheral}
        for i, step in enumerate(self.pipe.preprocessors):
            if isinstance(step, prep.Mapping):
                for place, entries in self.pipe._mapped[i].items():
                    for k, (c, new, means) in enumerate(entries):
                        tag = f"{i}__{place or 'population'}__{k}"
                        name = self.table(f"mapping{tag}", means)
                        before = self.names.get(place, place) if place else source
                        done = self.view(f"mapped{tag}", f"SELECT t.*, m.`{new}`\nFROM {before} t LEFT JOIN {name} m ON t.`{c}` = m.`{c}`")
                        if place:
                            self.names[place] = done
                        else:
                            source = done
                    frames[place] = mapping.mapped(frames[place], entries)
                continue
            if isinstance(step, prep.TextFieldSplitter):
                ids = ", ".join(f"`{c}`" for c in step.row_id)
                for c in step.columns:
                    words = f"filter(split(lower(`{c}`), '{prep.WORD_BREAK}'), w -> w <> '')".replace("\\", "\\\\")
                    self.names[words_table(c)] = self.view(f"split{i}__{c}", f"SELECT {ids}, explode({words}) AS word\nFROM {source}")
                continue
            for name, df in frames.items():
                fitted = self.pipe._fitted[i, name]
                new = prepared_columns(fitted, df)
                if new:
                    sql = replaced(self.names.get(name, name) if name else source, df.columns, new)
                    done = self.view(f"prepared{i}__{name or 'population'}", sql)
                    if name:
                        self.names[name] = done
                    else:
                        source = done
                    frames[name] = fitted.transform(df)
        self.population = frames[""]
        return source

    def enumerated(self, learner: Propositionalizer, source: str) -> dict[str, str]:
        """Attach all relations of a propositionalizer; feature -> expression over the last view."""
        self.spec, self.source = learner, source
        for relation in learner.relations:
            right = self.stage(relation.join.right, (relation.join.right.name,))
            self.source = self.attach(self.source, right, relation, list(self.row_id), f"joined__{relation.prefix}")
        comparisons = {n: f"`{l}` - `{f}`" for r in learner.relations for n, l, f in r.comparisons}
        return {c: comparisons.get(c, f"`{c}`") for c in learner.selected}

    def learnt(self, learner, source: str) -> dict[str, str]:
        """The same for a searching learner: weighted sums, empty aggregates count as 0."""
        self.spec, self.source = learner.inner, source
        out: dict[str, str] = {}
        for relation, aggs, features in learner.pieces():
            right = self.stage(relation.join.right, (relation.join.right.name,))
            self.source = self.attach(self.source, right, replace(relation, aggs=aggs), list(self.row_id), f"joined__{relation.prefix}")
            for name, terms in features.items():
                single = len(terms) == 1 and terms[0][1] == 1.0
                out[name] = f"coalesce(`{terms[0][0]}`, 0)" if single else total([f"coalesce(`{c}`, 0) * {number(w)}" for c, w in terms])
        return {f.name: out[f.name] for f in learner.learnt_features()}

    def learner(self, learner, source: str, suffix: str) -> str:
        """View of row id and the features of one learner."""
        ids = ", ".join(f"`{c}`" for c in self.row_id)
        tag = self.tag
        if isinstance(learner, Propositionalizer):
            parts = [(self.enumerated(learner, source), self.source)]
        else:
            parts = [(self.learnt(learner, source), self.source)]
            if learner.plain is not None:
                self.tag = f"{tag}plain__"
                parts.append((self.enumerated(learner.plain, source), self.source))
        views = []
        for k, (features, last) in enumerate(parts):
            columns = "".join(f", {sql} AS `{name}{suffix}`" for name, sql in features.items())
            self.tag = tag
            views.append(self.view(f"learnt{k}", f"SELECT {ids}{columns}\nFROM {last}"))
        if len(views) == 1:
            return views[0]
        return self.view("learnt", f"SELECT * FROM {views[0]} LEFT JOIN {views[1]} USING ({ids})")

    def write(self, source: str) -> list[tuple[str, str]]:
        pipe: Pipeline = self.pipe
        self.row_id = pipe.model.population.row_id
        ids = ", ".join(f"`{c}`" for c in self.row_id)
        source = self.prepare(source)
        own = [f"`{c}`" for c in dict.fromkeys([*[t for t in pipe.targets if t in self.population.columns], *pipe._own_columns])]
        if pipe.include_categorical:
            for c, values in pipe._categories.values.items():
                own += [f"coalesce(CAST(`{c}` = {_literal(v)} AS DOUBLE), 0D) AS `{c}__is{i}`" for i, v in enumerate(values)]
        joined = self.view("own_columns", "SELECT " + ", ".join([ids, *own]) + f"\nFROM {source}")
        for j, (target, learner) in enumerate(pipe._learners):
            self.tag = f"learner{j}__"
            part = self.learner(learner, source, f"__for_{target}" if target else "")
            self.tag = ""
            joined = self.view(f"with_learner{j}", f"SELECT * FROM {joined} LEFT JOIN {part} USING ({ids})")
        self.view("FEATURES", f"SELECT * FROM {joined}")
        if pipe.predictors:
            told = ", ".join(f"{sql} AS `prediction__{t}`" for t, sql in predictor_sql(pipe.predictors[0]).items())
            self.view("PREDICTIONS", f"SELECT {ids}, {told}\nFROM FEATURES")
        return self.statements


# ---- models


def tree_sql(node, columns: list[str]) -> str:
    """A fitted tree as nested cases."""
    if node.subtreeDepth() == 0:
        return number(node.prediction())
    split = node.split()
    left, right = tree_sql(node.leftChild(), columns), tree_sql(node.rightChild(), columns)
    return f"CASE WHEN {present(columns[split.featureIndex()])} <= {number(split.threshold())} THEN {left} ELSE {right} END"


def predictor_sql(fitted: predict.Predictor) -> dict[str, str]:
    """Target -> prediction of a fitted predictor: probabilities for classifiers."""
    out = {}
    for target, model in fitted.models.items():
        if hasattr(model, "trees"):
            trees = zip(model.trees, model.treeWeights, strict=True)
            value = total([f"{number(w)} * ({tree_sql(t._call_java('rootNode'), fitted.columns)})" for t, w in trees])
            out[target] = f"1D / (1D + exp(-2D * ({value})))" if fitted.is_classifier else value
        else:
            weights = zip(model.coefficients.toArray().tolist(), fitted.columns, strict=True)
            value = total([number(model.intercept), *[f"{present(c)} * {number(w)}" for w, c in weights if w]])
            out[target] = f"1D / (1D + exp(-({value})))" if fitted.is_classifier else value
    return out


def pipeline_scripts(pipe: Pipeline, view: View, folder: str, population: str = "population") -> tuple[list[tuple[str, str]], dict[str, DataFrame]]:
    """(name, statement) of every stage, and the tables they read from `folder`."""
    writer = _PipelineWriter(pipe, view, folder.rstrip("/"))
    return writer.write(population), writer.stored


def save_pipeline(pipe: Pipeline, view: View, folder: str, remove: bool = False, population: str = "population") -> list[str]:
    """Write the scripts to `folder` and the tables they need to the folder beside it, `<folder>-tables`."""
    spark = view.population.sparkSession
    tables = f"{folder.rstrip('/')}-tables"
    statements, stored = pipeline_scripts(pipe, view, tables, population)
    names = save_scripts(spark, statements, folder, remove)
    for name, df in stored.items():
        df.write.mode("overwrite" if remove else "errorifexists").parquet(f"{tables}/{name}")
    return names
