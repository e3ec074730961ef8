"""The next later row of a group."""

from relweave.operators import windows


def test_next_event_is_one_window(spark):
    rows = [(1, "a", 1, 0), (2, "a", 2, 1), (3, "a", 2, 0), (4, "a", 5, 1), (5, "b", 1, 1), (6, None, 1, 1), (7, None, 2, 1), (8, "a", None, 1)]
    df = spark.createDataFrame(rows, "id long, k string, t long, flag int")
    got = windows.next_event(df, ["k"], "t", ["id"], "flag", "n")
    assert {tuple(r) for r in got.collect()} == {(1, 0), (2, 1), (3, 1), (4, None), (5, None), (6, None), (7, None), (8, None)}
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_next_event_in_hot_groups(spark, hot):
    df = spark.createDataFrame([(i, "a", i // 2, i % 3) for i in range(40)], "id long, k string, t long, flag int")
    want = {(i, min(((i // 2 + 1) * 2) % 3, ((i // 2 + 1) * 2 + 1) % 3) if i < 38 else None) for i in range(40)}
    assert {tuple(r) for r in windows.next_event(df, ["k"], "t", ["id"], "flag", "n").collect()} == want
