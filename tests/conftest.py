import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from relweave.session import build_session

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[*]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return FOLDER


@pytest.fixture
def hot(spark):
    """Treat groups of more than five rows as hot."""
    spark.conf.set("spark.relweave.hotRows", "5")
    yield
    spark.conf.unset("spark.relweave.hotRows")


@pytest.fixture(autouse=True)
def no_views_left():
    """Temporary views that a test leaves behind break when a later one replaces what they read."""
    session = SparkSession.getActiveSession()
    names = lambda s: {r.viewName for r in s.sql("SHOW VIEWS").collect() if r.isTemporary} if s else set()
    before = names(session)
    yield
    session = SparkSession.getActiveSession()
    for name in names(session) - before:
        session.catalog.dropTempView(name)
