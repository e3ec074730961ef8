"""Means of categories below the population: all targets go down the joins together."""

import random

import pytest

from relweave.operators import prep
from relweave.operators import roles as R
from relweave.plans import mapping, pushdown
from relweave.plans.features import Propositionalizer
from relweave.plans.flow import Pipeline
from relweave.plans.model import DataModel, Placeholder, View


@pytest.mark.parametrize("few", [1000, 1])
def test_targets_share_their_way_down(spark, monkeypatch, few):
    rng = random.Random(5)
    monkeypatch.setattr(mapping, "FEW", few)
    top = [(i, rng.choice([None, float(rng.randrange(9))]), rng.choice([None, float(rng.randrange(5))])) for i in range(60)]
    mid = [(rng.randrange(80), j, rng.choice(["a", "b", None, "rare"])) for j in range(200)]
    low = [(rng.randrange(250), rng.choice("xyz")) for _ in range(400)]
    rows = R.set_role(spark.createDataFrame(top, "t long, p double, q double"), ["p", "q"], R.TARGET)
    tables = {
        "mid": R.set_role(spark.createDataFrame(mid, "t long, m long, c string"), "c", R.CATEGORICAL),
        "low": R.set_role(spark.createDataFrame(low, "m long, k string"), "k", R.CATEGORICAL),
    }
    dm = DataModel(Placeholder("population", ("t",))).add("mid", "low")
    dm.population.join(dm.mid, on="t")
    dm.mid.join(dm.low, on="m")
    calls, plain = [], pushdown.carried
    monkeypatch.setattr(pushdown, "carried", lambda *a: calls.append(a) or plain(*a))
    found = mapping.fitted(rows, tables, dm.population.joins, ["p", "q"], 20)
    assert len(calls) == 2  # one for each join
    want = {}
    for n, (at, value) in enumerate((("p", 1), ("q", 2))):
        known = {r[0]: r[value] for r in top if r[value] is not None}
        met = [(c, known[t]) for t, _, c in mid if t in known and c is not None]
        below = [(k, known[t]) for m, k in low for t, j, _ in mid if j == m and t in known]
        for name, pairs in (("mid", met), ("low", below)):
            for c in {c for c, _ in pairs}:
                own = [v for d, v in pairs if d == c]
                if len(own) >= 20:
                    want[name, at, c] = pytest.approx(sum(own) / len(own))
    got = {(name, "q" if new.endswith("__q") else "p", r[0]): r[1] for name, entries in found.items() for _, new, means in entries for r in means.collect()}
    assert got == want
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_learners_that_do_not_look_at_targets_are_fitted_once(spark):
    rows = R.set_role(spark.createDataFrame([(i, float(i), float(-i)) for i in range(20)], "t long, p double, q double"), ["p", "q"], R.TARGET)
    items = R.set_role(spark.createDataFrame([(i % 20, float(i)) for i in range(60)], "t long, x double"), "x", R.NUMERICAL)
    dm = DataModel(Placeholder("population", ("t",))).add("items")
    dm.population.join(dm.items, on="t")
    view = View(rows, {"items": items})
    same = Pipeline(dm, feature_learners=[Propositionalizer(("AVG",))]).fit(view, ["p", "q"])
    own = Pipeline(dm, feature_learners=[Propositionalizer(("AVG", "MAX"), num_features=1)]).fit(view, ["p", "q"])
    assert same._learners[0][1] is same._learners[1][1] and own._learners[0][1] is not own._learners[1][1]
    assert same.transform(view).columns == ["t", "p", "q", "items__avg__x__for_p", "items__avg__x__for_q"]
