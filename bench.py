"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select data and
cores. Each query is warmed up once and then timed three times into the noop sink;
the median counts. `features_per_second` relates the wide feature table to its time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from relweave.functions import aggregates as A
from relweave.functions.timecols import days, hours
from relweave.plans.features import Propositionalizer
from relweave.plans.model import DataModel, Placeholder, TimeSeries, View
from relweave.queries import QUERIES
from relweave.session import build_session
from relweave.sources.tables import load_dataset

CPUS = os.environ.get("BENCH_CPUS", "8")
FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def window_features(spark, folder):
    """All mergeable aggregates of the orders of the last 90 days, per order."""
    data = load_dataset(spark, folder, ["orders"])
    dm = DataModel(Placeholder("population", ("o_orderkey",))).add("orders")
    dm.population.join(dm.orders, on="o_custkey", time_stamps="o_orderdate", horizon=days(1), memory=days(90))
    view = View(data["orders"], data)
    learner = Propositionalizer(tuple(A.MERGEABLE), half_lives=(86400.0 * 30,), n_most_frequent=3).fit(dm, view)
    return learner.transform(dm, view)


def series_features(spark, folder):
    """Time series per user: one day of memory, one hour of horizon."""
    events = load_dataset(spark, folder, ["events"])["events"]
    series = TimeSeries(events, "ts", ["event_id"], on="user_id", horizon=hours(1), memory=days(1))
    learner = Propositionalizer(A.ALL, quantiles=A.QUANTILES, n_most_frequent=2).fit(series, series.full)
    return learner.transform(series, series.full)


def relational_features(spark, folder):
    """Customers <- orders: every aggregate and the most frequent categories."""
    data = load_dataset(spark, folder, ["customer", "orders"])
    dm = DataModel(Placeholder("population", ("c_custkey",))).add("orders")
    dm.population.join(dm.orders, on=("c_custkey", "o_custkey"))
    view = View(data["customer"], {"orders": data["orders"]})
    return Propositionalizer(tuple(f for f in A.ALL if f not in ("FIRST", "LAST", "AVG_TIME_BETWEEN", "EWMA")), n_most_frequent=3).fit(dm, view).transform(dm, view)


HEADLINE = [
    "flagship_prior_orders", "j1_many_to_many", "j4_many_to_one", "j6_as_of", "j8_memory", "j10_self_join_keyless", "j12_snowflake",
    "a5_median_grp", "a13_trend_win", "w1_sliding_1d", "w2_seasonal_hour", "w6_churn", "p22_row_id", "r4_text_splitter", "f1_propositionalization",
    "g5_label_connectivity", "g6_propagation",
]
WIDE = {"wide_window_features": window_features, "wide_series_features": series_features, "wide_relational_features": relational_features}


def run(fn, spark) -> tuple[float, int]:
    start = time.perf_counter()
    df = fn(spark, FOLDER)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start, len(df.columns)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
            # tables of a few MB: keep all cores busy after a shuffle
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, rates = {}, {}
    chosen = {**{n: QUERIES[n] for n in HEADLINE}, **WIDE}
    for name in sys.argv[1:] or chosen:
        fn = chosen[name]
        run(fn, spark)
        found = [run(fn, spark) for _ in range(REPEATS)]
        times[name] = round(statistics.median(t for t, _ in found), 3)
        if name in WIDE:
            rates[name] = {"features": found[0][1] - 1, "per_second": round((found[0][1] - 1) / times[name], 1)}
        print(name, times[name], rates.get(name, ""), file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "features_per_second": rates,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
