"""Joins around hot keys, row numbers, quantiles, statistics, metrics."""

import random

import pytest
from pyspark.sql import functions as F

from relweave.functions import exprs
from relweave.functions.aggregates import Agg
from relweave.functions.stats import line_fit, t_two_sided_p
from relweave.operators import grouping, graph, metrics, moments, prep, ranks, reshape, skew, splits, windows
from relweave.operators import roles as R


def test_skew_join_keeps_every_row(spark, hot):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.createDataFrame([(i, 1 if i % 3 else i) for i in range(200)] + [(1000, None)], "id long, k long")
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 150)], "k long, v long")
    try:
        hot_keys, _ = skew.hot_groups(left.select("k").dropna(), ["k"])
        assert [r[0] for r in hot_keys] == [1]
        got = skew.skew_join(left, right, ["k"])
        assert sorted(map(str, got.select("id", "k", "v").collect())) == sorted(map(str, left.join(right, "k", "left").select("id", "k", "v").collect()))
        assert got.count() == 201
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_row_ids_are_dense_with_ties_and_nulls(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([None, 1, 1, 1, 2, 5]), f"w{rnd.randrange(99):02d}") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a long, s string")
    got = {r["id"]: r["rowid"] for r in ranks.with_row_id(df, ["a", "id"]).collect()}
    want = sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[0]))
    assert [got[r[0]] for r in want] == list(range(300))
    got = {r["id"]: r["rowid"] for r in ranks.with_row_id(df, ["s", "id"]).collect()}
    assert [got[r[0]] for r in sorted(rows, key=lambda r: (r[2], r[0]))] == list(range(300))


def test_pieces_cut_equal_beginnings_and_nulls(spark):
    rows = [(i, None, f"https://a/{i}") for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, z long, s string")
    for order in (["s"], ["z", "id"]):
        for pieces, width in ((12, 1024), (24, 5)):
            found = ranks.ordered_pieces(df, order, pieces, width).select("__p0", *order).collect()
            sizes = [sum(r["__p0"] == p for r in found) for p in {r["__p0"] for r in found}]
            assert len(sizes) > pieces / 2 and max(sizes) < 4 * 1200 / pieces
            by_order = [r["__p0"] for r in sorted(found, key=lambda r: r[order[-1]])]
            assert by_order == sorted(by_order)
    assert ranks.with_row_id(df.limit(0), ["s"]).count() == 0


def test_group_row_number_in_segments(spark, hot):
    rows = [(i, 1 if i < 150 else i, (i * 7) % 31) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, k long, t long")
    got = {r["id"]: r["rn"] for r in ranks.group_row_number(df, ["k"], ["t", "id"]).collect()}
    order = [r[0] for r in sorted((r for r in rows if r[1] == 1), key=lambda r: (r[2], r[0]))]
    assert [got[i] for i in order] == list(range(1, 151))
    lagged = {r["id"]: r["p"] for r in windows.lag_rows(df, ["k"], ["t", "id"], "id", 4, "p").collect()}
    assert [lagged[i] for i in order] == [None] * 4 + order[:-4]


def test_quantiles_in_pieces(spark, hot):
    rnd = random.Random(2)
    rows = [(1 if i % 3 else 2, rnd.choice([1.0, 2.0, float(i)])) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, x double")
    aggs = [Agg("MEDIAN", "x", name="m"), Agg("QUANTILE", "x", name="q", param=0.9), Agg("MODE", "x", name="mo"), Agg("COUNT_ABOVE_MEAN", "x", name="c")]
    hist = grouping.value_histogram(df, ["k"], ["x"])
    assert grouping._value_cuts(hist)
    got = {r["k"]: r for r in grouping.group_aggregate(df, ["k"], aggs).collect()}
    want = df.groupBy("k").agg(F.percentile("x", 0.5).alias("m"), F.percentile("x", 0.9).alias("q"), F.mode("x", True).alias("mo"))
    for r in want.collect():
        assert got[r["k"]]["m"] == pytest.approx(r["m"]) and got[r["k"]]["q"] == pytest.approx(r["q"]) and got[r["k"]]["mo"] == r["mo"]


def test_t_distribution(spark):
    # closed forms for 1, 2, 3 and tabled values for larger degrees of freedom
    cases = [(1.0, 1, 0.5), (2.0, 2, 0.18350341907227), (3.182446305284, 3, 0.05), (2.228138851965, 10, 0.05), (2.085963447266, 20, 0.05), (0.0, 7, 1.0)]
    df = spark.createDataFrame([(t, n, p) for t, n, p in cases], "t double, n int, p double")
    for r in df.select("p", t_two_sided_p(F.col("t"), F.col("n")).alias("got")).collect():
        assert r["got"] == pytest.approx(r["p"], abs=1e-9)


def test_auc_with_ties(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1), (0, 0.4), (1, 0.8)]
    df = spark.createDataFrame(rows, "y int, p double")
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / 9
    assert metrics.auc(df, "y", "p").first()[0] == pytest.approx(want)


def test_moments(spark):
    df = spark.range(500).select((F.col("id") % 7).cast("double").alias("a"), F.sin("id").alias("b"), (1e6 + F.col("id")).alias("c"))
    m = moments.covariances(df, ["a", "b", "c"])
    want = df.agg(F.covar_pop("a", "c"), F.covar_pop("b", "c"), F.var_pop("c")).first()
    assert m.block(["a", "b", "c"], ["c"])[:, 0] == pytest.approx(list(want))
    n, mean, var, cov, my, vy = moments.cross_moments(df, ["a", "b"], F.col("c"))
    assert n == 500 and cov == pytest.approx(list(want)[:2]) and vy == pytest.approx(want[2])


def test_mapping_and_imputation_use_training_rows_only(spark):
    train = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, None), ("b", 5.0, 4.0)], "c string, y double, x double")
    test = spark.createDataFrame([("a", 100.0, None), ("z", 100.0, 8.0)], "c string, y double, x double")
    out = prep.Mapping().fit(train, "y", ["c"]).transform(test)
    assert {r["c"]: r["c__mean_target"] for r in out.collect()} == {"a": 2.0, "z": None}
    out = prep.Imputation().fit(train, ["x"]).transform(test)
    assert {r["c"]: (r["x"], r["x__missing"]) for r in out.collect()} == {"a": (3.0, 1.0), "z": (8.0, 0.0)}
    assert prep.Mapping(min_freq=2).fit(train, "y", ["c"]).tables["c"].count() == 1


def test_roles_and_types(spark):
    df = spark.createDataFrame([("1", "NULL", "03/2020"), ("2", "x", "bad")], "n string, s string, t string")
    df = R.set_role(df, "n", R.NUMERICAL)
    df = R.set_role(df, "s", R.CATEGORICAL)
    df = R.set_unit(R.set_role(df, "t", R.TIME_STAMP, ["%Y-%m", "%m/%Y"]), "t", "month")
    assert R.roles(df)["numerical"] == ["n"] and R.units(df) == {"month": ["t"]}
    rows = df.orderBy("n").collect()
    assert rows[0]["n"] == 1.0 and rows[0]["s"] is None and rows[0]["t"].month == 3 and rows[1]["t"] is None
    with pytest.raises(ValueError):
        R.set_role(df, "n", "nonsense")


def test_split_shares_are_stable(spark):
    df = spark.range(20000)
    split = splits.split_random(["id"], train=0.7, validation=0.1, test=0.2, seed=3)
    counts = {r[0]: r[1] for r in df.groupBy(split.alias("s")).count().collect()}
    assert counts["train"] == pytest.approx(14000, rel=0.03) and counts["test"] == pytest.approx(4000, rel=0.08)
    again = df.repartition(17).where(split == "test")
    assert again.agg(F.sum("id")).first() == df.where(split == "test").agg(F.sum("id")).first()
    with pytest.raises(ValueError):
        splits.split_random(["id"], train=0.7)


def test_lookup_must_be_unique(spark):
    left = spark.range(3)
    with pytest.raises(ValueError):
        reshape.lookup(left, left.union(left), ["id"], check=True)


def test_long_lists_become_semi_joins(spark):
    df = spark.range(5000)
    assert reshape.where_in(df, "id", range(0, 4000, 2)).count() == 2000


def test_gap_patterns(spark):
    a = spark.createDataFrame([(1, 3), (1, 5), (1, 9), (2, 1), (2, 2)], "a long, p int")
    b = spark.createDataFrame([(70, 13), (70, 15), (70, 19), (80, 4), (80, 5), (60, 103), (60, 105), (60, 109)], "b long, p int")
    assert {tuple(r) for r in graph.match_by_gaps(a, b, "a", "b", "p").collect()} == {(1, 60), (2, 80)}


def test_dense_vectors(spark):
    df = spark.createDataFrame([(1, [0, 2])], "n long, w array<int>")
    assert df.select(graph.to_dense(F.col("w"), 4).alias("v")).first()["v"] == [1, 0, 1, 0]


def test_strftime_patterns():
    assert exprs.java_pattern("%Y-%m-%d %H:%M") == "yyyy-MM-dd HH:mm"
    assert exprs.java_pattern("%Y/%n") == "yyyy/M"
    assert exprs.java_pattern("T%H") == "'T'HH"


def test_empty_inputs_give_nulls_not_errors(spark):
    empty = spark.createDataFrame([], "y int, p double")
    assert metrics.auc(empty, "y", "p").first()[0] is None
    one_class = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, p double")
    assert metrics.auc(one_class, "y", "p").first()[0] is None
    assert metrics.roc_curve(one_class, "y", "p").where("fpr IS NULL").count() == 2
    m = moments.covariances(empty, ["y", "p"])
    assert m.n == 0


def test_pandas_round_trip(spark):
    from relweave.sources import tables

    df = spark.createDataFrame([(1, 2.5, "a"), (2, 3.5, "b")], "id long, x double, c string")
    pdf = tables.to_pandas(df)
    back = tables.from_pandas(spark, pdf, {"x": R.NUMERICAL, "c": R.CATEGORICAL})
    assert sorted(back.collect()) == sorted(df.collect()) and R.roles(back)["numerical"] == ["x"]
    with pytest.raises(ValueError):
        tables.to_pandas(df, max_rows=1)


def test_joins_do_not_depend_on_column_names(spark):
    """Internal names stay out of the way of short user columns."""
    df = spark.createDataFrame([(1, 5.0, "a"), (1, 7.0, "b"), (2, 1.0, "a")], "k long, v double, n string")
    aggs = [Agg("COUNT", name="o"), Agg("SUM", "v", name="s0"), Agg("MEDIAN", "v", name="hi"), Agg("MODE", "n", name="mean")]
    got = {r["k"]: tuple(r)[1:] for r in grouping.group_aggregate(df, ["k"], aggs).collect()}
    assert got == {1: (2, 12.0, 6.0, "a"), 2: (1, 1.0, 1.0, "a")}


def test_line_through_two_points_is_certain(spark):
    # c / sqrt(vx * vy) ends just below 1 for some of these
    rows = [(g, float(x), y) for g in range(200) for x, y in ((1, 27.25 + g * 0.37), (2, 3.33 if g % 10 else 27.25 + g * 0.37))]
    s = spark.createDataFrame(rows, "g long, x double, y double").groupBy("g").agg(F.count("x").alias("n"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"), F.covar_pop("x", "y").alias("c"))
    n, zero = F.col("n"), F.lit(0.0)
    p = line_fit(n, zero, zero, n * F.col("vx"), n * F.col("c"), n * F.col("vy"))["p"]
    assert {r["g"]: r["p"] for r in s.select("g", p.alias("p")).collect()} == {g: 0.0 if g % 10 else 1.0 for g in range(200)}
