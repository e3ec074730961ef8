"""Codes of labels and bags of words: how often the rows behind them are computed."""

from relweave.operators import graph, ranks


def counted(spark, rows, schema):
    """Rows, and how many of them have been computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def look(row):
        seen.add(1)
        return row

    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(look), schema), seen


def test_codes_read_their_rows_twice(spark):
    rows, seen = counted(spark, [(i, f"w{i % 7}" if i % 5 else None) for i in range(40)], "id long, w string")
    coded, _ = ranks.encode_category(rows, "w", "code")
    assert {tuple(r) for r in coded.select("id", "w", "code").collect()} == {(i, f"w{i % 7}" if i % 5 else None, i % 7 if i % 5 else None) for i in range(40)}
    assert seen.value <= 2 * 40


def test_codes_around_hot_labels(spark, hot):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([(i, "a" if i % 3 else f"b{i:02d}") for i in range(60)] + [(99, None)], "id long, w string")
        coded = {r["id"]: r["code"] for r in ranks.encode_category(rows, "w", "code")[0].collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert coded == {**{i: 0 if i % 3 else 1 + i // 3 for i in range(60)}, 99: None}


def test_patterns_read_their_rows_once(spark):
    rows = [(1, 3), (1, 5), (1, 5), (2, 1), (2, 2), (None, 7), (3, None), (4, 9)]
    a, seen = counted(spark, rows, "a long, p int")
    b = spark.createDataFrame([(70, 13), (70, 15), (60, 103), (60, 105), (50, 1)], "b long, p int")
    assert {tuple(r) for r in graph.match_by_gaps(a, b, "a", "b", "p").collect()} == {(1, 60), (4, 50)}
    assert seen.value <= 2 * len(rows)
    bags = graph.bag_of_words(a, "a", "p")
    assert bags._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {(r[0], tuple(r[1])) for r in bags.collect()} == {(1, (3, 5)), (2, (1, 2)), (4, (9,))}
