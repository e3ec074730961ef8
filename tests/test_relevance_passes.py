"""All F tests of a selection come from one pass over the rows."""

import random

from pyspark.sql import functions as F

from relweave.operators import moments
from relweave.plans import select


def jobs(spark, group, work):
    spark.sparkContext.setJobGroup(group, "")
    found = work()
    spark.sparkContext.setJobGroup("", "")
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_one_pass_for_all_columns(spark):
    rng = random.Random(6)
    data = []
    for _ in range(400):
        good, noise = rng.gauss(0, 1), rng.gauss(0, 1)
        data.append((good, noise, 3.0, None if rng.random() < 0.1 else good * good, 2 * good + rng.gauss(0, 1)))
    df = spark.createDataFrame(data, "good double, noise double, flat double, square double, y double")
    names = ["good", "noise", "flat", "square"]
    _, once = jobs(spark, "once", lambda: moments.cross_moments(df, names, F.col("y")))
    kept, used = jobs(spark, "used", lambda: select.select_relevant(df, names, "y"))
    assert kept == ["good"] and used == once
    assert select.select_relevant(df.withColumn("y", F.lit(1.0)), names, "y") == []
    assert select.select_relevant(df.withColumn("y", F.col("good")), names, "y") == ["good"]
