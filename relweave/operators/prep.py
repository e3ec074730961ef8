"""Preprocessors. Whatever is learnt comes from the training rows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import is_time
from ..session import UNKNOWN, plan_bytes
from . import roles as R
from . import skew

WORD_BREAK = r"[^\p{L}\p{N}]+"
TEXT_PIECE = 16 * 2**20  # bytes read for the texts of a task, whose words take many times that


class Seasonal:
    """Time stamps become calendar categories: year, month, weekday, hour, minute."""

    def __init__(self, parts: tuple[str, ...] = ("year", "month", "weekday", "hour", "minute")):
        self.parts = parts

    def fit(self, df: DataFrame, target: str | None = None) -> Seasonal:
        self.columns = [f.name for f in df.schema.fields if is_time(f.dataType) and R.role_of(f) == R.TIME_STAMP]
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        new = {f"{p}__{c}": F.expr(f"CAST({p}(`{c}`) AS STRING)") for c in self.columns for p in self.parts}
        df = df.withColumns(new)
        for name in new:
            df = df.withMetadata(name, {"role": R.CATEGORICAL})
        return df


class Mapping:
    """Category -> mean target of the training rows that carry it.

    `min_freq` drops rare categories. The table has one row per category, may be
    large, and is therefore joined, not collected. Through `link` the target of another table
    is used: link = (that table, its key, our key, its target).
    """

    def __init__(self, min_freq: int = 1):
        self.min_freq = min_freq

    def fit(self, df: DataFrame, target: str, columns: list[str] | None = None) -> Mapping:
        columns = columns if columns is not None else R.roles(df)[R.CATEGORICAL]
        self.tables = {}
        for c in columns:
            means = df.where(F.col(c).isNotNull()).groupBy(c).agg(
                F.avg(F.col(target).cast("double")).alias(f"{c}__mean_target"), F.count(target).alias("__n")
            )
            self.tables[c] = means.where(F.col("__n") >= self.min_freq).drop("__n")
        return self

    def fit_across(self, right: DataFrame, population: DataFrame, on: list[tuple[str, str]], target: str, columns: list[str]) -> Mapping:
        """Categories of `right`, targets of the population rows they join to (left key, right key)."""
        per_key = population.groupBy(*[l for l, _ in on]).agg(
            F.sum(F.col(target).cast("double")).alias("__s"), F.count(target).alias("__c")
        )
        keyed = per_key.select(*[F.col(l).alias(r) for l, r in on], "__s", "__c")
        self.tables = {}
        for c in columns:
            # pre-aggregate, so a (category, key) pair meets the population once
            pairs = right.where(F.col(c).isNotNull()).groupBy(c, *[r for _, r in on]).agg(F.count(F.lit(1)).alias("__k"))
            joined = skew.skew_join(pairs, keyed, [r for _, r in on], "inner")
            means = joined.groupBy(c).agg(
                (F.sum(F.col("__k") * F.col("__s")) / F.sum(F.col("__k") * F.col("__c"))).alias(f"{c}__mean_target"),
                F.sum(F.col("__k") * F.col("__c")).alias("__n"),
            )
            self.tables[c] = means.where(F.col("__n") >= self.min_freq).drop("__n")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        for c, table in self.tables.items():
            df = skew.skew_join(df, table, [c], "left").withMetadata(f"{c}__mean_target", {"role": R.NUMERICAL})
        return df


class Substring:
    """A piece of a hierarchical code, for columns with a unit or subrole."""

    def __init__(self, begin: int, length: int, unit: str | None = None, subrole: str | None = None):
        self.begin, self.length, self.unit, self.subrole = begin, length, unit, subrole

    def fit(self, df: DataFrame, target: str | None = None) -> Substring:
        self.columns = [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, T.StringType)
            and ((self.unit and f.metadata.get("unit") == self.unit) or (self.subrole and self.subrole in R.subroles(f)))
        ]
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        stop = self.begin + self.length
        new = {f"{c}__{self.begin}_{stop}": F.substring(c, self.begin + 1, self.length) for c in self.columns}
        df = df.withColumns(new)
        for name in new:
            df = df.withMetadata(name, {"role": R.CATEGORICAL})
        return df


def words(col: str) -> Column:
    """Lower-cased words of a text, in order."""
    return F.filter(F.split(F.lower(F.col(col)), WORD_BREAK), lambda w: w != "")


class TextFieldSplitter:
    """Free text -> a (row id, word) table, to be joined back many-to-many."""

    def __init__(self, row_id: list[str]):
        self.row_id = row_id

    def fit(self, df: DataFrame, target: str | None = None) -> TextFieldSplitter:
        self.columns = R.roles(df)[R.TEXT]
        return self

    def transform(self, df: DataFrame) -> dict[str, DataFrame]:
        out = {}
        for c in self.columns:
            rows = df.select(*self.row_id, c)
            # texts are dealt by row id before they grow into words: groupings by row id, or by row id and word, find these in place
            size = plan_bytes(df)
            if size < UNKNOWN:
                rows = rows.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TEXT_PIECE)), *self.row_id)
            else:  # rows of no known size are dealt as Spark deals them
                rows = rows.repartition(*self.row_id)
            table = rows.select(*self.row_id, F.explode(words(c)).alias("word"))
            for k in self.row_id:
                table = table.withMetadata(k, {"role": R.JOIN_KEY})
            out[c] = table.withMetadata("word", {"role": R.CATEGORICAL})
        return out


class Imputation:
    """Missing numbers -> training mean, with a 0/1 column that says so."""

    def __init__(self, add_dummies: bool = True):
        self.add_dummies = add_dummies

    def fit(self, df: DataFrame, columns: list[str] | None = None) -> Imputation:
        columns = columns if columns is not None else R.roles(df)[R.NUMERICAL]
        row = df.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in columns]).first()
        self.means = {c: row[c] for c in columns}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for c, mean in self.means.items():
            x = F.nanvl(F.col(c).cast("double"), F.lit(None))
            new[c] = F.coalesce(x, F.lit(mean))
            if self.add_dummies:
                new[f"{c}__missing"] = x.isNull().cast("double")
        out = df.withColumns(new)
        for c in new:
            known = df.schema[c].metadata if c in df.columns else {}
            out = out.withMetadata(c, {"role": R.NUMERICAL, **known})
        return out


def check(population: DataFrame, tables: dict[str, DataFrame], joins, row_id=()) -> list[tuple[str, str, float]]:
    """Data-model warnings: (kind, where, share or count).

    Row ids that are null or not unique, share of keys without partner and lookup keys that are not
    unique on every level of the model, and columns that are entirely null. Each is one
    aggregate or one anti join.
    """
    out = []
    if row_id:
        ids = [F.col(f"`{c}`") for c in row_id]
        missing = F.lit(False)
        for c in ids:
            missing = missing | c.isNull()
        counts = population.groupBy(*ids).agg(F.count(F.lit(1)).alias("__n"), F.max(missing).alias("__m"))
        row = counts.agg(F.sum(F.when(F.col("__m"), F.col("__n"))), F.count(F.when((F.col("__n") > 1) & ~F.col("__m"), 1))).first()
        out += [("row id missing", "population", float(row[0]))] if row[0] else []
        out += [("row ids not unique", "population", float(row[1]))] if row[1] else []
    out += _check_joins(population, tables, joins, "")
    for name, df in {"population": population, **tables}.items():
        row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
        out += [("column is always null", f"{name}.{c}", 1.0) for c in df.columns if row[c] == 0]
    return out


def _check_joins(left: DataFrame, tables: dict[str, DataFrame], joins, path: str) -> list[tuple[str, str, float]]:
    out = []
    for join in joins:
        right, place = tables[join.right.name], f"{path}{join.right.name}"
        left_keys, right_keys = [l for l, _ in join.on], [r for _, r in join.on]
        if join.on and all(c in left.columns for c in left_keys):  # keys that a lookup brings along are checked there
            total = left.count()
            known = right.select(*[F.col(r).alias(l) for l, r in join.on]).dropna().distinct()
            found = skew.skew_join(left.select(*left_keys), known.withColumn("__hit", F.lit(1)), left_keys, "left")
            missing = found.agg(F.count(F.when(F.col("__hit").isNull(), 1))).first()[0]
            if missing:
                out.append(("keys without partner", place, missing / total))
        if join.is_lookup:
            twice = right.groupBy(*right_keys).count().where("count > 1").count()
            if twice:
                out.append(("lookup keys not unique", place, float(twice)))
        out += _check_joins(right, tables, join.right.joins, f"{place}.")
    return out
