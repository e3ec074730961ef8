"""Scripts of one query leave the temporary views of others as they were."""

from relweave.sources.scripts import own_views


def test_views_come_back(spark):
    spark.range(3).createOrReplaceTempView("kept_rows")
    spark.sql("CREATE OR REPLACE TEMP VIEW kept_sums AS SELECT sum(id) AS s FROM kept_rows")
    with own_views(spark):
        spark.range(2).selectExpr("id AS other").createOrReplaceTempView("kept_rows")
        spark.sql("CREATE OR REPLACE TEMP VIEW new_sums AS SELECT sum(other) AS s FROM kept_rows")
        told = spark.table("new_sums")
    assert told.first().s == 1 and spark.table("kept_sums").first().s == 3
    left = {t.name for t in spark.catalog.listTables()}
    assert "new_sums" not in left and {"kept_rows", "kept_sums"} <= left
    for name in ("kept_rows", "kept_sums"):
        spark.catalog.dropTempView(name)


def test_queries_leave_no_views(spark, folder):
    from relweave.queries import QUERIES

    before = {t.name for t in spark.catalog.listTables()}
    assert QUERIES["s7_window_scripts"](spark, folder).count() > 0
    assert {t.name for t in spark.catalog.listTables()} == before
