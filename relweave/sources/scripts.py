"""Features as Spark SQL files: one statement per file, run in file order."""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.aggregates import COUNT_LIKE
from ..operators import grouping, interval
from ..plans.features import Propositionalizer, Relation, feature_names
from ..plans.model import DataModel, Join, Placeholder, View
from .files import list_files, read_text, write_text


class _Writer:
    def __init__(self, spec: Propositionalizer | None, tables: dict[str, DataFrame]):
        self.spec, self.tables = spec, tables
        self.statements: list[tuple[str, str]] = []
        self.names: dict[str, str] = {}  # views that stand for a table after preparation
        self.tag = ""

    def view(self, name: str, sql: str) -> str:
        name = f"{self.tag}{name}"
        self.statements.append((name, f"CREATE OR REPLACE TEMP VIEW {name} AS\n{sql}"))
        return name

    def stage(self, place: Placeholder, path: tuple[str, ...]) -> str:
        """View of a table with its lookups and sub-features."""
        source = self.names.get(place.name, place.name)
        for number, join in enumerate(place.joins):
            inner = self.stage(join.right, (*path, join.right.name))
            name = f"staged__{'__'.join(path)}__{number + 1}"
            if join.is_lookup:
                source = self.lookup(source, inner, join, name, path)
            else:
                relation = self.spec.nested[(*path, join.right.name)]
                # a plain view: each statement above computes the columns it reads, not all features of the inner table
                source = self.attach(source, inner, relation, list(place.row_id), name)
        return source

    def lookup(self, source: str, inner: str, join: Join, name: str, path) -> str:
        keys = [r for _, r in join.on]
        columns = self.spec.columns[(*path, join.right.name)]
        moved = ", ".join(f"d.`{c}` AS `{join.right.name}__{c}`" for c in columns if c not in keys)
        match = " AND ".join(f"t.`{l}` = d.`{r}`" for l, r in join.on)
        return self.view(name, f"SELECT t.*, {moved}\nFROM {source} t LEFT JOIN {inner} d ON {match}")

    def attach(self, source: str, right: str, relation: Relation, row_id: list[str], name: str) -> str:
        names = feature_names(relation)
        joins, columns = [], []
        for i, (view, keys, aggs) in enumerate(self.parts(source, right, relation, row_id)):
            a = f"f{i}"
            match = " AND ".join(f"t.`{l}` = {a}.`{r}`" for l, r in keys)
            joins.append(f"LEFT JOIN {view} {a} ON {match}")
            for agg in aggs:
                value = f"{a}.`{agg.alias}`"
                if agg.func in COUNT_LIKE:
                    value = f"coalesce({value}, 0)"
                columns.append(f"{value} AS `{names[agg.alias]}`")
        return self.view(name, f"SELECT t.*, {', '.join(columns)}\nFROM {source} t " + "\n".join(joins))

    def parts(self, source: str, right: str, relation: Relation, row_id: list[str]):
        """(view, key pairs, aggregates) of each statement of a relation."""
        mergeable = [a for a in relation.aggs if a.mergeable]
        holistic = [a for a in relation.aggs if not a.mergeable]
        prefix = f"features__{relation.prefix}"
        out = []
        if relation.plan is not None:
            plan = replace(relation.plan, aggs=tuple(relation.aggs))
            if any(interval.too_long(a, plan) for a in mergeable):
                raise ValueError(f"an EWMA over more than {interval.HALF_LIVES} half-lives is not one statement")
            keys = [(c, c) for c in row_id]
            texts = []
            if mergeable:
                texts.append((interval.mergeable_sql(plan, mergeable, hot=False), mergeable))
            if holistic:
                texts.append((interval.sliding_sql(plan, holistic), holistic))
            for i, (sql, aggs) in enumerate(texts):
                sql = re.sub(r"\bleft_rows\b", source, re.sub(r"\bright_rows\b", right, sql))
                out.append((self.view(f"{prefix}__{i + 1}", sql), keys, aggs))
            return out
        rkeys = [r for _, r in relation.join.on]
        for i in range(0, len(mergeable), grouping.CHUNK):
            aggs = mergeable[i : i + grouping.CHUNK]
            sql = grouping.grouped_sql(rkeys, aggs, source=right)
            out.append((self.view(f"{prefix}__g{i // grouping.CHUNK + 1}", sql), list(relation.join.on), aggs))
        if holistic:
            types = relation.right.select(*[F.expr(a.value_sql).alias(str(i)) for i, a in enumerate(holistic)]).schema.fields
            for tag, dtype in (("n", "DOUBLE"), ("s", "STRING")):
                aggs = [a for a, f in zip(holistic, types) if isinstance(f.dataType, T.NumericType) == (dtype == "DOUBLE")]
                if aggs:
                    view = self.view(f"{prefix}__{tag}", grouping.histogram_sql(rkeys, aggs, right, dtype, deal=True))
                    out.append((view, list(relation.join.on), aggs))
        return out


def feature_scripts(spec: Propositionalizer, model: DataModel, view: View, population: str = "population") -> list[tuple[str, str]]:
    """(name, statement) of every stage; the last one defines the view FEATURES.

    The population and the peripheral tables must be registered under their names.
    """
    writer = _Writer(spec, view.peripheral)
    source = population
    for relation in spec.relations:
        right = writer.stage(relation.join.right, (relation.join.right.name,))
        source = writer.attach(source, right, relation, list(model.population.row_id), f"joined__{relation.prefix}")
    ids = ", ".join(f"`{c}`" for c in model.population.row_id)
    comparisons = {n: f"`{l}` - `{f}` AS `{n}`" for r in spec.relations for n, l, f in r.comparisons}
    columns = "".join(f", {comparisons.get(c, f'`{c}`')}" for c in spec.selected)
    writer.view("FEATURES", f"SELECT {ids}{columns}\nFROM {source}")
    return writer.statements


def save_scripts(spark: SparkSession, statements: list[tuple[str, str]], folder: str, remove: bool = False) -> list[str]:
    """One numbered file per statement. An existing folder is only replaced with `remove`."""
    if list_files(spark, folder):
        if not remove:
            raise FileExistsError(folder)
    names = []
    width = len(str(len(statements)))
    for i, (name, sql) in enumerate(statements):
        names.append(f"{folder.rstrip('/')}/{i:0{width}d}_{name.lower()}.sql")
    write_text(spark, dict(zip(names, [sql + ";\n" for _, sql in statements])), folder, remove)
    return names


@contextlib.contextmanager
def own_views(spark: SparkSession) -> Iterator[None]:
    """Temporary views made inside go afterwards, and those that were replaced come back.

    Views hold the text of their statement, so a view that is left behind breaks when another
    folder of scripts replaces what it reads. Tables taken from views inside stay readable.
    """
    names = lambda: {r.viewName for r in spark.sql("SHOW VIEWS").collect() if r.isTemporary and not r.namespace}
    before, held = names(), {}
    for name in before:
        with contextlib.suppress(AnalysisException):  # one that is broken already
            held[name] = spark.table(f"`{name}`")
    try:
        yield
    finally:
        for name in names() - before:
            spark.catalog.dropTempView(name)
        for name, df in held.items():
            df.createOrReplaceTempView(f"`{name}`")


def run_sql_folder(spark: SparkSession, folder: str) -> None:
    """Run every .sql file of a folder in the order of the names."""
    for path in sorted(list_files(spark, folder, ".sql")):
        for statement in re.split(r";\s*\n", read_text(spark, path)):
            if statement.strip():
                spark.sql(statement)
