"""Scores, curves and correlations. Nothing sorts a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import ordered_pieces


def regression_scores(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """mae, rmse, rsquared; rsquared is the squared Pearson correlation."""
    a, b = F.col(y).cast("double"), F.col(yhat).cast("double")
    return df.agg(
        F.avg(F.abs(a - b)).alias("mae"),
        F.sqrt(F.avg((a - b) * (a - b))).alias("rmse"),
        F.pow(F.corr(a, b), F.lit(2.0)).alias("rsquared"),
    )


def accuracy(y: Column, p: Column, threshold: float = 0.5) -> Column:
    return F.avg(((p > threshold).cast("double") == y.cast("double")).cast("double"))


def cross_entropy(y: Column, p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))
    return -F.avg(y * F.ln(q) + (1 - y) * F.ln(1 - q))


def by_score(df: DataFrame, y: str, p: str) -> DataFrame:
    """(score, n, pos): one row per distinct score."""
    rows = df.select(F.col(p).cast("double").alias("score"), F.col(y).cast("double").alias("y")).dropna()
    return rows.groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))


def cumulate(counts: DataFrame, order: str, cols: list[str], descending: bool = True) -> DataFrame:
    """Running totals `cum_*` and grand totals `all_*` along `order`.

    Pieces of the order are summed on their own, shifted by the totals of the pieces
    before them; the table of pieces is small.
    """
    pieces = ordered_pieces(counts, [order])
    key, row = F.col("__p0"), F.col(order)
    local = Window.partitionBy("__p0").orderBy(row.desc() if descending else row.asc())
    local = local.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy(key.desc() if descending else key.asc())
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    totals = pieces.groupBy("__p0").agg(*[F.sum(c).alias(c) for c in cols])
    offsets = totals.select(
        "__p0",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__b_{c}") for c in cols],
        *[F.sum(c).over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"all_{c}") for c in cols],
    )
    running = pieces.withColumns({f"cum_{c}": F.sum(c).over(local) for c in cols})
    joined = running.join(offsets, "__p0")
    joined = joined.withColumns({f"cum_{c}": F.col(f"cum_{c}") + F.col(f"__b_{c}") for c in cols})
    return joined.drop("__p0", *[f"__b_{c}" for c in cols])


def auc(df: DataFrame, y: str, p: str) -> DataFrame:
    """Area under the ROC curve by rank sums; equal scores count half."""
    c = cumulate(by_score(df, y, p), "score", ["n", "pos"], descending=False)
    neg_below = (F.col("cum_n") - F.col("n")) - (F.col("cum_pos") - F.col("pos"))
    won = F.sum(F.col("pos") * (neg_below + (F.col("n") - F.col("pos")) / 2))
    pairs = F.max("all_pos") * (F.max("all_n") - F.max("all_pos"))
    return c.agg(F.try_divide(won, pairs).alias("auc"))


def classification_scores(df: DataFrame, y: str, p: str) -> DataFrame:
    a, b = F.col(y).cast("double"), F.col(p).cast("double")
    simple = df.agg(accuracy(a, b).alias("accuracy"), cross_entropy(a, b).alias("cross_entropy"))
    return simple.join(F.broadcast(auc(df, y, p)))  # one row each


def roc_curve(df: DataFrame, y: str, p: str) -> DataFrame:
    c = cumulate(by_score(df, y, p), "score", ["n", "pos"])
    neg, all_neg = F.col("cum_n") - F.col("cum_pos"), F.col("all_n") - F.col("all_pos")
    return c.select("score", F.try_divide(neg, all_neg).alias("fpr"), F.try_divide(F.col("cum_pos"), F.col("all_pos")).alias("tpr"))


def precision_recall_curve(df: DataFrame, y: str, p: str) -> DataFrame:
    c = cumulate(by_score(df, y, p), "score", ["n", "pos"])
    return c.select(
        "score", (F.col("cum_pos") / F.col("cum_n")).alias("precision"), F.try_divide(F.col("cum_pos"), F.col("all_pos")).alias("recall")
    )


def lift_curve(df: DataFrame, y: str, p: str) -> DataFrame:
    c = cumulate(by_score(df, y, p), "score", ["n", "pos"])
    share = F.col("cum_pos") / F.col("cum_n")
    base = F.col("all_pos") / F.col("all_n")
    return c.select("score", (F.col("cum_n") / F.col("all_n")).alias("proportion"), F.try_divide(share, base).alias("lift"))


def argmax_label(probabilities: list[str], labels: list[str]) -> Column:
    """Label of the largest probability; the first one among equals."""
    values = F.array(*[F.col(p) for p in probabilities])
    names = F.array(*[F.lit(v) for v in labels])
    return F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))


def argmax_accuracy(df: DataFrame, actual: str, probabilities: list[str], labels: list[str]) -> DataFrame:
    hit = (argmax_label(probabilities, labels) == F.col(actual)).cast("double")
    return df.agg(F.avg(F.coalesce(hit, F.lit(0.0))).alias("accuracy"))


def mean_over_targets(scores: list[DataFrame]) -> DataFrame:
    """Average of one-row score tables, one per target."""
    out = scores[0]
    for s in scores[1:]:
        out = out.unionByName(s)
    return out.agg(*[F.avg(c).alias(c) for c in scores[0].columns])


def correlation_table(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """(feature, correlation), all from one aggregation."""
    y = F.col(target).cast("double")
    wide = df.agg(*[F.corr(F.col(c).cast("double"), y).alias(c) for c in columns])
    return wide.unpivot([], columns, "feature", "correlation")
