"""Words of texts: dealt by row id before they are split."""

from pyspark.sql import functions as F

from relweave.operators import prep
from relweave.operators import roles as R


def test_words_are_grouped_where_they_are(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "b a, A!" if i % 2 else None) for i in range(20)] + [(1, "a")], "id long, text string")
    monkeypatch.setattr(prep, "plan_bytes", lambda df: 2**31)  # far beyond one split
    words = prep.TextFieldSplitter(["id"]).fit(R.set_role(rows, "text", R.TEXT)).transform(rows)["text"]
    per_row = words.groupBy("word", "id").agg(F.count(F.lit(1)).alias("k"))
    assert per_row._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert words.rdd.getNumPartitions() == 2**31 // prep.TEXT_PIECE
    assert {tuple(r) for r in per_row.where("id < 2").collect()} == {("a", 1, 3), ("b", 1, 1)}
