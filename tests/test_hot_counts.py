"""Hot groups are found by way of buckets, and states wider than rows are not shuffled."""

from collections import Counter

from pyspark.sql import functions as F

from relweave.functions.aggregates import Agg
from relweave.operators import grouping, skew


def test_groups_of_full_buckets_are_counted(spark, hot, monkeypatch):
    monkeypatch.setattr(skew, "BUCKETS", 7)  # every bucket is shared
    data = [(i % 40, "a" if i % 3 else None) for i in range(100)] + [(3, "b")] * 9 + [(None, None)] * 8
    df = spark.createDataFrame(data, "k long, s string")
    found, limit, total = skew.counted_groups(df, ["k", "s"])
    want = {g: n for g, n in Counter(data).items() if n > 5}
    assert {(r["k"], r["s"]): r["__n"] for r in found} == want and (limit, total) == (5, 117)


def test_few_rows_are_shuffled_where_nothing_is_hot(spark, monkeypatch):
    spark.conf.set("spark.relweave.hotRows", "50")
    seen = []
    monkeypatch.setattr(skew, "BUCKETS", 16)
    plain = type(spark.range(1)).groupBy
    monkeypatch.setattr(type(spark.range(1)), "groupBy", lambda df, *cols: seen.append(str(cols)) or plain(df, *cols))
    try:
        assert skew.hot_groups(spark.range(200).select("id"), ["id"]) == ([], 50)
    finally:
        spark.conf.unset("spark.relweave.hotRows")
    assert str(("id",)) not in seen and "pmod" in seen[0]


def test_narrow_rows_are_dealt_before_wide_states(spark, monkeypatch):
    monkeypatch.setattr(grouping, "ONE_SPLIT", 10)
    rows = [(i % 50 if i % 10 else None, float(i % 7) if i % 4 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, x double").repartition(3)
    aggs = [Agg(f, "`x`", c, f"{f}_{j}") for j, c in enumerate([None, "`x` > 2", "`x` <= 2"]) for f in ("COUNT", "SUM", "AVG", "MIN", "MAX")]
    out = grouping.group_aggregate(df, ["k"], aggs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    assert len(aggs) >= 15 and out.where("k IS NULL").count() == 0
    monkeypatch.setattr(grouping, "_deal_first", lambda *a: False)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, grouping.group_aggregate(df, ["k"], aggs).collect()))


def test_few_groups_are_added_up_before_the_shuffle(spark, monkeypatch):
    df = spark.range(0, 5000, 1, 3).select((F.col("id") % 4).alias("k"), F.col("id").cast("double").alias("x"))
    assert not grouping._deal_first(df, ["k"], 20, 2) and grouping._deal_first(df.withColumn("k", F.col("x")), ["k"], 20, 2)
