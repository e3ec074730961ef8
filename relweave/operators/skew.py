"""Hot groups: find them behind a size check, split them, and join around them.

A group is *hot* when it holds more than ``spark.relweave.hotRows`` rows and more
than 1/4096 of the table. At most 4096 groups can be hot, so lists of hot groups
and of their segments may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import output_bytes, plan_bytes

MAX_HOT_GROUPS = 4096
MAX_SEGMENTS = 1024
SALTS = 64
BUCKETS = 1 << 16  # of keys, counted first


def hot_rows(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.relweave.hotRows", "20000000"))


def hot_groups(df: DataFrame, cols: list[str], sizes: DataFrame | None = None) -> tuple[list, int]:
    """Hot groups of `df` with their row counts, and the row limit they exceed.

    Nothing is counted while the whole input is so small that no group can be hot.
    The counting is a partial aggregate over buckets of the group columns. `sizes` holds the
    groups and their row counts `__n` where these are known already.
    """
    hot, limit, _ = counted_groups(df, cols, sizes)
    return hot, limit


def counted_groups(df: DataFrame, cols: list[str], sizes: DataFrame | None = None) -> tuple[list, int, int]:
    """As `hot_groups`, with the number of rows; 0 where nothing is counted."""
    limit = hot_rows(df.sparkSession)
    if plan_bytes(df) <= limit:
        return [], limit, 0
    if sizes is not None:
        total = sizes.agg(F.sum("__n")).first()[0] or 0
        limit = max(limit, total // MAX_HOT_GROUPS)
        return sizes.where(F.col("__n") > limit).select(*cols, "__n").collect(), limit, total
    if not cols:
        total = df.count()
        limit = max(limit, total // MAX_HOT_GROUPS)
        return ([(total,)] if total > limit else []), limit, total
    # groups share buckets, of which few rows are shuffled: only the groups of full ones are counted on their own
    bucket = F.pmod(F.xxhash64(*cols), F.lit(BUCKETS))
    filled = df.groupBy(bucket.alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    row = filled.agg(F.sum("__n"), F.collect_list(F.when(F.col("__n") > limit, F.struct("__b", "__n")))).first()
    total = row[0] or 0
    limit = max(limit, total // MAX_HOT_GROUPS)
    full = [b["__b"] for b in row[1] if b["__n"] > limit]
    if not full:
        return [], limit, total
    counts = df.where(bucket.isin(full)).groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") > limit).collect(), limit, total


def segment_bounds(df: DataFrame, cols: list[str], order: str) -> DataFrame | None:
    """Cut points of `order` that split every hot group; None when nothing is hot.

    The result is a local table of at most 4096 rows, so later plans see constants
    and a lost task recomputes exactly the same segments.
    """
    spark = df.sparkSession
    hot, limit = hot_groups(df, cols)
    if not hot:
        return None
    fields = [df.schema[c] for c in cols]
    if cols:
        sizes = spark.createDataFrame(
            [tuple(r) for r in hot],
            T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField("__n", T.LongType())]),
        )
        match = [df[c].eqNullSafe(sizes[c]) for c in cols]
        rows = df.join(F.broadcast(sizes), match).select(*[df[c] for c in cols], df[order], sizes["__n"])
    else:
        rows = df.select(order).withColumn("__n", F.lit(hot[0][0]))
    grid = F.array(*[F.lit(i / MAX_SEGMENTS) for i in range(1, MAX_SEGMENTS)])
    cuts = rows.groupBy(*cols, "__n").agg(F.percentile_approx(order, grid, 20000).alias("__cuts")).collect()
    out = []
    for row in cuts:
        pieces = min(MAX_SEGMENTS, -(-row["__n"] // limit))
        step = MAX_SEGMENTS / pieces
        picked = sorted({row["__cuts"][round(i * step) - 1] for i in range(1, pieces)})
        out.append((*[row[c] for c in cols], picked))
    schema = [T.StructField(f.name, f.dataType) for f in fields]
    return spark.createDataFrame(
        out, T.StructType(schema + [T.StructField("__cuts", T.ArrayType(df.schema[order].dataType))])
    )


def with_segment(df: DataFrame, bounds: DataFrame | None, cols: list[str], order: str, name: str = "__seg") -> DataFrame:
    """Number of cut points below `order`; 0 outside hot groups. Ties stay together."""
    if bounds is None:
        return df.withColumn(name, F.lit(0))
    b = bounds.select(*[F.col(c).alias(f"__b_{c}") for c in cols], "__cuts")
    match: Column = F.lit(True)
    for c in cols:
        match = match & df[c].eqNullSafe(b[f"__b_{c}"])
    seg = F.coalesce(F.array_size(F.filter("__cuts", lambda v: v < F.col(order))), F.lit(0))
    return df.join(F.broadcast(b), match, "left").withColumn(name, seg).drop("__cuts", *[f"__b_{c}" for c in cols])


def _broadcastable(df: DataFrame) -> bool:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    units = {"k": 2**10, "m": 2**20, "g": 2**30}
    text = text.lower().rstrip("b")
    threshold = int(text[:-1]) * units[text[-1]] if text[-1:] in units else int(text)
    return threshold > 0 and output_bytes(df) <= threshold


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", sizes: DataFrame | None = None) -> DataFrame:
    """Equi-join whose left side may have hot keys; `right` holds few rows per key. `sizes` as in `hot_groups`.

    A right side below the broadcast threshold needs no shuffle, so Spark's own
    choice is kept. Otherwise left rows of hot keys are spread over salts and only the
    right rows of those keys are repeated. Rows with a null key match nothing and
    are spread as well.
    """
    if _broadcastable(right):
        return left.join(right, on, how)
    keyed = left.select(*on).dropna()
    hot, _ = hot_groups(keyed, on, sizes)
    null_key = F.lit(False)
    for c in on:
        null_key = null_key | F.col(c).isNull()
    # AQE may re-plan the row order, the salt therefore depends on the row alone.
    flat = [f.name for f in left.schema.fields if not isinstance(f.dataType, T.MapType)]
    salt = F.pmod(F.xxhash64(*flat), F.lit(SALTS)).cast("int")
    if not hot:
        if how == "inner":
            return left.join(right, on, how)
        salted = left.withColumn("__salt", F.when(null_key, -1 - salt).otherwise(0))
        return salted.join(right.withColumn("__salt", F.lit(0)), [*on, "__salt"], how).drop("__salt")
    schema = T.StructType([T.StructField(c, left.schema[c].dataType) for c in on])
    hot_keys = left.sparkSession.createDataFrame([tuple(r)[:-1] for r in hot], schema).withColumn("__hot", F.lit(True))
    salted = left.join(F.broadcast(hot_keys), on, "left").withColumn(
        "__salt", F.when(null_key, -1 - salt).when(F.col("__hot"), salt).otherwise(0)
    )
    spread = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.join(F.broadcast(hot_keys), on, "left").withColumn("__salt", F.explode(spread)).drop("__hot")
    return salted.drop("__hot").join(repeated, [*on, "__salt"], how).drop("__salt")
