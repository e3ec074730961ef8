"""Every registered query against its SQL, and every other one for rows."""

import duckdb
import pytest
from check import TABLES, rows_of

from relweave.queries import ORACLES, QUERIES

SLOW = {"e5_sweep", "e4_tuning", "f11_stat_builder", "f10_series_builder", "f1_all_aggregates_windowed", "f5_boosted_trees"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, db, name):
    df = QUERIES[name](spark, folder)
    got = df.collect()
    cur = db.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert rows_of(df.columns, got) == rows_of(columns, want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).limit(1).count() == 1
