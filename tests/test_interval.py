"""Time-bounded aggregation: edges, nulls, forms, hot groups, leakage."""

import math
import random

import pytest
from pyspark.sql import Row

from relweave.functions.aggregates import MERGEABLE, Agg
from relweave.operators import holistic, interval, value_counts

SCHEMA = "id long, k long, t long, x double, c string"


def frame(spark, rows):
    return spark.createDataFrame([Row(*r) for r in rows], SCHEMA)


def run(left, right, aggs, form=None, key="k", **bounds):
    on = [(key, key)] if key else []
    plan = interval.plan_interval(left, right, aggs, on=on, times=("t", "t"), row_id=["id"], **bounds)
    return {r["id"]: r for r in interval.interval_aggregate(left, right, plan, form).collect()}


def brute(left, right, horizon, memory, keyed=True):
    """Right rows seen by each left row."""
    out = {}
    for i, k, t, _, _ in left:
        seen = []
        for _, rk, rt, x, c in right:
            if t is None or rt is None or (keyed and (k is None or rk is None or k != rk)):
                continue
            if rt <= t - horizon and (memory is None or rt > t - horizon - memory):
                seen.append((rt, x, c))
        out[i] = seen
    return out


def close(a, b):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=1e-7, abs_tol=1e-7)


EDGES = [
    (0, 1, 100, 5.0, "a"),
    (1, 1, 100, 7.0, "b"),  # equal time stamps
    (2, 1, 90, 1.0, "a"),  # exactly t - horizon of rows 0 and 1: in
    (3, 1, 70, 2.0, "a"),  # exactly t - horizon - memory of rows 0 and 1: out
    (4, 1, 71, None, None),  # null measure
    (5, None, 95, 3.0, "a"),  # null key
    (6, 2, 100, 9.0, "c"),  # single-row group
    (7, 1, None, 4.0, "a"),  # null time
    (8, 1, -35, 4.0, "a"),  # below zero
]


@pytest.mark.parametrize("form", ["sliding", "blocks"])
def test_edges(spark, form):
    df = frame(spark, EDGES)
    aggs = [Agg("COUNT", name="n"), Agg("COUNT", "x", name="nx"), Agg("SUM", "x", name="s"), Agg("VAR", "x", name="v"), Agg("TREND", "x", name="tr")]
    out = run(df, df, aggs, form, horizon=10, memory=20)
    assert len(out) == len(EDGES)
    for i in (0, 1):
        assert (out[i]["n"], out[i]["nx"], out[i]["s"], out[i]["v"], out[i]["tr"]) == (2, 1, 1.0, 0.0, None)
    for i in (5, 6, 7, 8):
        assert (out[i]["n"], out[i]["nx"], out[i]["s"], out[i]["v"]) == (0, 0, None, None)


def test_own_row_counts_without_horizon(spark):
    df = frame(spark, EDGES)
    for form in ("sliding", "blocks"):
        out = run(df, df, [Agg("COUNT", name="n")], form, horizon=0, memory=1)
        assert out[0]["n"] == out[1]["n"] == 2 and out[6]["n"] == 1


def sample(seed, n=160):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = rnd.choice([1, 1, 1, 1, 2, 3, None])
        t = rnd.choice([None, *range(-40, 200)])
        rows.append((i, k, t, rnd.choice([None, 1.0, 2.0, 5.5, -3.137]), rnd.choice(["a", "b", None])))
    return rows


AGGS = [Agg(f, "x", name=f) for f in MERGEABLE if f not in ("EWMA", "COUNT")] + [
    Agg("EWMA", "x", name="EWMA", param=25.0),
    Agg("COUNT", None, name="n"),
    Agg("SUM", "x", "c = 'a'", name="sa"),
]


def expect(seen):
    xs = [(t, x) for t, x, _ in seen if x is not None]
    vals = [x for _, x in xs]
    out = {"n": len(seen), "SUM": sum(vals) if vals else None, "MIN": min(vals, default=None), "MAX": max(vals, default=None)}
    a = [x for _, x, c in seen if x is not None and c == "a"]
    out["sa"] = sum(a) if a else None
    out["FIRST"] = min(xs)[1] if xs else None
    out["LAST"] = max(xs)[1] if xs else None
    if vals:
        m = sum(vals) / len(vals)
        out["AVG"], out["VAR"] = m, sum((v - m) ** 2 for v in vals) / len(vals)
    return out


@pytest.mark.parametrize("horizon,memory", [(0, 30), (7, 50), (-60, 60), (3, None)])
@pytest.mark.parametrize("keyed", [True, False])
def test_forms_agree_with_brute_force(spark, horizon, memory, keyed):
    rows = sample(horizon + (memory or 0) + keyed)
    df = frame(spark, rows)
    want = brute(rows, rows, horizon, memory, keyed)
    forms = ["blocks"] if memory is None else ["blocks", "sliding"]
    results = [run(df, df, AGGS, f, key="k" if keyed else None, horizon=horizon, memory=memory) for f in forms]
    other = frame(spark, rows).where("id >= 0")  # not the same plan: left and right markers
    results += [run(df, other, AGGS, f, key="k" if keyed else None, horizon=horizon, memory=memory) for f in forms]
    for out in results:
        for i, seen in want.items():
            for name, value in expect(seen).items():
                assert close(out[i][name], value), (i, name, out[i][name], value)
            for agg in AGGS:
                assert close(out[i][agg.alias], results[0][i][agg.alias]), (i, agg.alias)


@pytest.mark.parametrize("memory", [40, None])
def test_hot_groups_are_cut(spark, hot, memory):
    rows = sample(11, 400)
    df = frame(spark, rows)
    plan = interval.plan_interval(df, df, AGGS, on=[("k", "k")], times=("t", "t"), row_id=["id"], horizon=2, memory=memory)
    cuts = interval.hot_cuts(df, df, plan)
    assert cuts is not None and cuts.count() >= 1
    out = {r["id"]: r for r in interval.interval_aggregate(df, df, plan, "blocks").collect()}
    spark.conf.unset("spark.relweave.hotRows")
    plain = run(df, df, AGGS, "blocks", horizon=2, memory=memory)
    want = brute(rows, rows, 2, memory)
    for i, seen in want.items():
        for name, value in expect(seen).items():
            assert close(out[i][name], value), (i, name)
        for agg in AGGS:
            assert close(out[i][agg.alias], plain[i][agg.alias]), (i, agg.alias)


def test_later_rows_do_not_leak(spark):
    rows = sample(5)
    horizon, memory, cut = 5, 60, 100
    before = run(frame(spark, rows), frame(spark, rows), AGGS, horizon=horizon, memory=memory)
    changed = [(i, k, t, 999.0 if t is not None and t > cut - horizon else x, c) for i, k, t, x, c in rows]
    after = run(frame(spark, rows), frame(spark, changed), AGGS, horizon=horizon, memory=memory)
    for i, _, t, _, _ in rows:
        if t is not None and t <= cut:
            for agg in AGGS:
                assert close(before[i][agg.alias], after[i][agg.alias])


HOLISTIC = ["MEDIAN", "COUNT_DISTINCT", "NUM_MAX", "NUM_MIN", "COUNT_ABOVE_MEAN", "PERCENT_UNIQUE", "ENTROPY"]


@pytest.mark.parametrize("form", ["sliding", "blocks"])
def test_holistic(spark, form):
    rows = sample(3)
    df = frame(spark, rows)
    out = run(df, df, [Agg(f, "x", name=f) for f in HOLISTIC], form, horizon=1, memory=70)
    for i, seen in brute(rows, rows, 1, 70).items():
        vals = sorted(x for _, x, _ in seen if x is not None)
        assert out[i]["COUNT_DISTINCT"] == len(set(vals))
        if not vals:
            assert out[i]["MEDIAN"] is None
            continue
        half = len(vals) // 2
        assert close(out[i]["MEDIAN"], vals[half] if len(vals) % 2 else (vals[half - 1] + vals[half]) / 2)
        assert out[i]["NUM_MAX"] == vals.count(max(vals)) and out[i]["NUM_MIN"] == vals.count(min(vals))
        mean = sum(vals) / len(vals)
        assert out[i]["COUNT_ABOVE_MEAN"] == sum(v > mean for v in vals)
        assert close(out[i]["PERCENT_UNIQUE"], len(set(vals)) / len(vals))
        p = [vals.count(v) / len(vals) for v in set(vals)]
        assert close(out[i]["ENTROPY"], -sum(q * math.log(q) for q in p) + 0.0)


COUNTED = [
    Agg("MEDIAN", "x", name="median"), Agg("QUANTILE", "x", name="q", param=0.1), Agg("MODE", "c", name="mode"), Agg("ENTROPY", "c", name="entropy"),
    Agg("COUNT_DISTINCT", "c", name="distinct"), Agg("COUNT_MINUS_DISTINCT", "c", name="again"), Agg("PERCENT_UNIQUE", "c", name="unique"),
    Agg("NUM_MAX", "x", name="tops"), Agg("NUM_MIN", "x", name="lows"),
    Agg("COUNT_ABOVE_MEAN", "x", name="above"), Agg("COUNT_BELOW_MEAN", "x", name="below"), Agg("COUNT", name="n"),
]


def expected_holistic(seen):
    xs = sorted(x for _, x, _ in seen if x is not None)
    cs = [c for _, _, c in seen if c is not None]

    def quantile(p):
        at = p * (len(xs) - 1)
        return xs[math.floor(at)] + (at - math.floor(at)) * (xs[math.ceil(at)] - xs[math.floor(at)]) if xs else None

    mean = sum(xs) / len(xs) if xs else 0.0
    shares = [cs.count(c) / len(cs) for c in set(cs)]
    return {
        "median": quantile(0.5), "q": quantile(0.1), "mode": min(set(cs), key=lambda c: (-cs.count(c), c)) if cs else None,
        "entropy": max(0.0, -sum(q * math.log(q) for q in shares)) if cs else None,
        "distinct": len(set(cs)), "again": len(cs) - len(set(cs)), "unique": len(set(cs)) / len(cs) if cs else None,
        "tops": xs.count(xs[-1]) if xs else 0, "lows": xs.count(xs[0]) if xs else 0,
        "above": sum(x > mean for x in xs), "below": sum(x < mean for x in xs), "n": len(seen),
    }


def assert_holistic(out, windows):
    for i, seen in windows.items():
        for name, want in expected_holistic(seen).items():
            got = out[i][name]
            assert got == want if isinstance(want, str) or want is None else close(got, want), (i, name, got, want)


@pytest.mark.parametrize(("few", "memory"), [(64, None), (0, None), (0, 60)])
def test_holistic_windows_from_counts(spark, monkeypatch, few, memory):
    """Values listed one by one and values refined in ranges give the same."""
    monkeypatch.setattr(value_counts, "FEW", few)
    monkeypatch.setattr(holistic, "FAN", 16)
    rows = [*EDGES, *[(i + 100, k, t, None if x is None else x / 4, c) for i, k, t, x, c in sample(8)]]
    df = frame(spark, rows)
    assert_holistic(run(df, df, COUNTED, "blocks", horizon=1, memory=memory), brute(rows, rows, 1, memory))


def test_as_of_quantiles_of_many_values(spark, hot):
    rows = [(i, 1, i * 7 % 101, (i * 37 % 97) / 8, f"c{i % 70}") for i in range(120)]
    df = frame(spark, rows)
    aggs = [a for a in COUNTED if a.name in ("median", "q", "distinct", "n")]
    got = run(df, df, aggs, key=None)
    for i, seen in brute(rows, rows, 0, None, keyed=False).items():
        want = expected_holistic(seen)
        assert all(close(got[i][a.name], want[a.name]) for a in aggs)


@pytest.mark.parametrize("form", ["sliding", "blocks"])
def test_nan_and_infinity_are_values_in_every_form(spark, monkeypatch, form):
    odd = [math.nan, math.inf, -math.inf, 1.0, 1.0, None, 2.0]
    rows = [(i, 1, i, x, "a") for i, x in enumerate(odd)]
    df = frame(spark, rows)
    aggs = [Agg("COUNT_DISTINCT", "x", name="d"), Agg("MEDIAN", "x", name="m"), Agg("NUM_MAX", "x", name="top")]
    for few in (64, 0):
        monkeypatch.setattr(value_counts, "FEW", few)
        out = run(df, df, aggs, form, memory=100)
        assert [out[6][c] for c in ("d", "m", "top")] == [5, 1.5, 1]
        assert [out[i]["d"] for i in range(7)] == [1, 2, 3, 4, 4, 4, 5]


@pytest.mark.parametrize("memory", [None, 5000])
def test_ewma_over_thousands_of_half_lives(spark, memory):
    rows = [(i, i % 2, t, float(t % 7), "a") for i, t in enumerate([0, 1, 3, 3000, 3001, 3950, 4000, 4003, 9000, 9001])]
    df = frame(spark, rows)
    out = run(df, df, [Agg("EWMA", "x", name="e", param=1.0), Agg("COUNT", name="n")], memory=memory)
    for i, seen in brute(rows, rows, 0, memory).items():
        last = max(t for t, _, _ in seen)
        weights = [2.0 ** (t - last) for t, _, _ in seen]
        assert close(out[i]["e"], sum(w * x for w, (_, x, _) in zip(weights, seen)) / sum(weights)) and out[i]["n"] == len(seen)



@pytest.mark.parametrize("horizon", [0, 10, -15])
def test_quantiles_of_short_histories_need_no_refinement(spark, monkeypatch, horizon):
    rng = random.Random(horizon)
    rows = EDGES + [(100 + i, rng.choice([1, 2, 3, None]), rng.choice([None, rng.randrange(-200, 200)]), rng.choice([None, rng.gauss(0, 9), 2.0]), "a") for i in range(80)]
    left, right = frame(spark, rows), frame(spark, rows).select("*")
    aggs = [Agg("MEDIAN", "x", name="m"), Agg("QUANTILE", "x", name="q", param=0.05)]
    monkeypatch.setattr(interval, "SMALL_HISTORY", interval.Profile(0, 0.0))
    refined = run(left, right, aggs, horizon=horizon)
    monkeypatch.undo()
    monkeypatch.setattr(holistic, "aggregate", None)
    for other in (right, left):
        found = run(left, other, aggs, horizon=horizon)
        assert found.keys() == refined.keys() == {r[0] for r in rows}
        assert all(close(found[i][c], refined[i][c]) for i in found for c in ("m", "q"))
