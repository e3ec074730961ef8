"""Predictors on Spark ML, one model per target, and their importances."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import classification, regression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INPUT = "__features"
PIECE = 64 * 2**20  # bytes of a task of an estimator


def assemble(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numeric columns as one vector; missing values count as 0."""
    safe = [F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), F.lit(0.0)).alias(f"__f{i}") for i, c in enumerate(columns)]
    wide = df.select("*", *safe)
    parts = [f"__f{i}" for i in range(len(columns))]
    return VectorAssembler(inputCols=parts, outputCol=INPUT).transform(wide).drop(*parts)


@dataclass
class Predictor:
    """Common fit / predict; subclasses name the Spark ML estimator."""

    params: dict = field(default_factory=dict)
    is_classifier = False

    def _estimator(self, target: str):
        raise NotImplementedError

    def copy(self, **params) -> Predictor:
        return type(self)({**self.params, **params})

    def fit(self, df: DataFrame, columns: list[str], targets: list[str]) -> Predictor:
        self.columns, self.targets = list(columns), list(targets)
        data = assemble(df.withColumns({t: F.col(t).cast("double") for t in targets}), columns)
        data = data.select(INPUT, *targets).persist()
        # an estimator passes over the rows hundreds of times: every pass has as many tasks as there are cores, unless these get large
        pieces = max(df.sparkSession.sparkContext.defaultParallelism, -(-data.count() * 8 * len(columns) // PIECE))
        self.models = {t: self._estimator(t).fit(data.coalesce(pieces).where(F.col(t).isNotNull())) for t in targets}
        data.unpersist()
        return self

    def _output(self) -> Column:
        return vector_to_array("probability")[1] if self.is_classifier else F.col("prediction")

    def predict(self, df: DataFrame) -> DataFrame:
        """The rows with one `prediction__<target>` column per target."""
        out = assemble(df, self.columns)
        for t, model in self.models.items():
            out = model.transform(out).withColumn(f"prediction__{t}", self._output())
            out = out.drop("prediction", "probability", "rawPrediction")
        return out.drop(INPUT)

    def importances(self, target: str | None = None) -> dict[str, float]:
        """Share of each column, adding up to 1."""
        model = self.models[target or self.targets[0]]
        if hasattr(model, "featureImportances"):
            raw = model.featureImportances.toArray()
        else:
            raw = abs(model.coefficients.toArray())
        total = raw.sum()
        return {c: float(v / total) if total else 0.0 for c, v in zip(self.columns, raw)}


class GbtRegressor(Predictor):
    """params: max_depth, n_estimators, learning_rate, min_child_weight, gamma, subsample, seed."""

    def _estimator(self, target):
        return regression.GBTRegressor(featuresCol=INPUT, labelCol=target, **_tree_params(self.params))


class GbtClassifier(Predictor):
    is_classifier = True

    def _estimator(self, target):
        return classification.GBTClassifier(featuresCol=INPUT, labelCol=target, **_tree_params(self.params))


def _tree_params(params: dict) -> dict:
    """Booster names -> Spark ML names; gamma is the least gain of a split."""
    names = {
        "max_depth": "maxDepth",
        "n_estimators": "maxIter",
        "learning_rate": "stepSize",
        "min_child_weight": "minInstancesPerNode",
        "gamma": "minInfoGain",
        "subsample": "subsamplingRate",
        "seed": "seed",
    }
    unknown = set(params) - set(names)
    if unknown:
        raise ValueError(f"unknown parameters {sorted(unknown)}")
    return {"maxDepth": 3, "maxIter": 20, "seed": 1, **{names[k]: v for k, v in params.items()}}


class LinearRegression(Predictor):
    def _estimator(self, target):
        return regression.LinearRegression(featuresCol=INPUT, labelCol=target, regParam=self.params.get("reg_lambda", 0.0))


class LogisticRegression(Predictor):
    is_classifier = True

    def _estimator(self, target):
        return classification.LogisticRegression(featuresCol=INPUT, labelCol=target, regParam=self.params.get("reg_lambda", 0.0))


class MultinomialRegression:
    """One linear classifier over all classes, for labels coded 0, 1, 2 ..."""

    def __init__(self, reg_lambda: float = 0.0):
        self.reg_lambda = reg_lambda

    def fit(self, df: DataFrame, columns: list[str], label: str) -> MultinomialRegression:
        self.columns = list(columns)
        data = assemble(df.withColumn(label, F.col(label).cast("double")), columns).select(INPUT, label)
        self.model = classification.LogisticRegression(
            featuresCol=INPUT, labelCol=label, family="multinomial", regParam=self.reg_lambda
        ).fit(data)
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(assemble(df, self.columns))
        return out.withColumn("probabilities", vector_to_array("probability")).drop(INPUT, "probability", "rawPrediction")


class IncludeCategorical:
    """Categorical columns of the population as 0/1 predictor inputs; unseen values are all 0.

    Every category gets a column unless `max_categories` asks for the most frequent ones only.
    """

    def __init__(self, columns: list[str], max_categories: int | None = None):
        self.columns, self.max_categories = columns, max_categories

    def fit(self, df: DataFrame) -> IncludeCategorical:
        self.values = {}
        for c in self.columns:
            counts = df.where(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), F.asc(c))
            self.values[c] = [r[0] for r in (counts.limit(self.max_categories) if self.max_categories else counts).collect()]
        return self

    def transform(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        new = {}
        for c, values in self.values.items():
            for i, v in enumerate(values):
                new[f"{c}__is{i}"] = F.coalesce((F.col(c) == F.lit(v)).cast("double"), F.lit(0.0))
        return df.withColumns(new), list(new)


def one_hot(df: DataFrame, column: str, name: str) -> DataFrame:
    """Sparse 0/1 vector of a category by Spark ML's indexer and encoder."""
    indexed = StringIndexer(inputCol=column, outputCol="__ix", handleInvalid="keep", stringOrderType="alphabetAsc").fit(df).transform(df)
    return OneHotEncoder(inputCol="__ix", outputCol=name, dropLast=True).fit(indexed).transform(indexed).drop("__ix")
