"""Steps that have to grow with their input: how often plans read, deal and group rows."""

from relweave.functions.aggregates import Agg
from relweave.operators import grouping
from relweave.operators import roles as R
from relweave.plans.features import Propositionalizer
from relweave.plans.model import DataModel, Placeholder, View
from relweave.sources import scripts


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_exported_histograms_deal_rows_once(spark):
    rows = [(1, 4.0, 1.0), (1, 6.0, None), (1, 6.0, 2.0), (2, 1.0, None), (None, 9.0, 9.0)]
    spark.createDataFrame(rows, "k long, a double, b double").createOrReplaceTempView("few_rows")
    aggs = [Agg("MEDIAN", "`a`", name="ma"), Agg("MEDIAN", "`b`", name="mb"), Agg("COUNT_DISTINCT", "`a`", name="d")]
    plain, dealt = [spark.sql(grouping.histogram_sql(["k"], aggs, "few_rows", "DOUBLE", deal)) for deal in (False, True)]
    assert exchanges(dealt) == 1 < exchanges(plain)
    assert {tuple(r) for r in dealt.collect()} == {tuple(r) for r in plain.where("k IS NOT NULL").collect()} == {(1, 6.0, 1.5, 2), (2, 1.0, None, 1)}


def test_exported_views_compute_what_is_read(spark):
    tables = {
        "top": spark.createDataFrame([(1,), (2,)], "t long"),
        "mid": spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "t long, m long"),
        "low": R.set_role(spark.createDataFrame([(10, 1.0), (10, 3.0), (11, 5.0)], "m long, x double"), "x", R.NUMERICAL),
    }
    dm = DataModel(Placeholder("top", ("t",))).add("mid", "low")
    dm.population.join(dm.mid, on="t")
    dm.mid.join(dm.low, on="m")
    view = View(tables["top"], {k: tables[k] for k in ("mid", "low")})
    learner = Propositionalizer(("COUNT", "SUM", "MEDIAN"), compare_units=False, shared=False).fit(dm, view)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for _, statement in scripts.feature_scripts(learner, dm, view, "top"):
        spark.sql(statement)
    assert not any(spark.catalog.isCached(t.name) for t in spark.catalog.listTables() if t.isTemporary)
    read = spark.table("FEATURES").select("t", "mid__sum__mid__low__sum__x")
    assert "__hi" not in read._jdf.queryExecution().optimizedPlan().toString()  # no medians
    assert {tuple(r) for r in read.collect()} == {(1, 9.0), (2, None)}
