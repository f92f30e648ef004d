import random

import numpy as np
import pytest
from test_trees import data, table

from signalwatch.constants import LABEL
from signalwatch.operators.least_squares import Linear, moments, r2, ridge
from signalwatch.operators.trees import Growth
from signalwatch.plans import forecast, search
from signalwatch.plans.ensembles import BoostedTrees
from signalwatch.schemas import CATEGORY


def columns(spark, x, y):
    return spark.createDataFrame([(*map(float, a), float(b), i % 2) for i, (a, b) in enumerate(zip(x, y))],
                                 "a double, b double, c double, z double, y double, part int")


def test_weights_and_scores_from_moments(spark):
    x, y = data(500, 7)
    about = moments(columns(spark, x, y).repartition(4), ["a", "b", "c", "z", "y"])[()]
    for names, strength in ((("a", "b", "c"), 0.0), (("a", "z"), 0.0), (("b", "c"), 2.5)):
        model = ridge(about, names, "y", strength)
        part = x[:, ["abcz".index(n) for n in names]]
        centred = part - part.mean(0)
        system = centred.T @ centred / len(y) + strength * np.eye(len(names))
        expected = np.linalg.pinv(system) @ (centred.T @ (y - y.mean()) / len(y))
        assert model.weights == pytest.approx(expected, abs=1e-9)
        error = y - (model.base + part @ np.array(model.weights))
        assert r2(model, about, "y") == pytest.approx(1 - error @ error / (len(y) * y.var()))


def test_moments_of_groups_leave_out_rows_with_nulls(spark):
    x, y = data(60, 8)
    rows = columns(spark, x, y)
    holes = rows.union(spark.createDataFrame([(None, 1.0, 1.0, 1.0, 1e9, 0)], rows.schema))
    found = moments(holes, ["a", "y"], ["part"])
    assert set(found) == {(0,), (1,)}
    for part in (0, 1):
        about = found[(part,)]
        assert about.n_rows == 30
        assert about.cov == pytest.approx(np.cov(x[part::2, 0], y[part::2], bias=True))
    assert moments(rows.where("part = 7"), ["a"]) == {}


def test_half_of_the_candidates_go_on(spark):
    scores = {(k, f): random.Random(k * 10 + f).random() for k in range(11) for f in range(4)}
    calls = []

    def score(c, f):
        calls.append((c["k"], f))
        return scores[c["k"], f]

    tried = search.halving([{"k": k} for k in range(11)], 4, score)
    assert [len([c for c in calls if c[1] == f]) for f in range(4)] == [11, 6, 3, 2]
    left = list(range(11))
    for fold, keep in ((0, 6), (1, 3), (2, 2)):
        left = sorted(left, key=lambda k: -np.mean([scores[k, f] for f in range(fold + 1)]))[:keep]
    best = max(left, key=lambda k: np.mean([scores[k, f] for f in range(4)]))
    assert tried[0].number == best and len(tried[0].scores) == 4
    assert sorted(t.number for t in tried) == list(range(11))
    assert [len(t.scores) for t in tried] == sorted((len(t.scores) for t in tried), reverse=True)


def test_draws_repeat():
    space = {"x": search.one_of(1, 2, 3), "y": search.between(0.1, 10.0)}
    first = search.draw(space, 50)
    assert first == search.draw(space, 50) != search.draw(space, 50, seed=1)
    assert {c["x"] for c in first} == {1, 2, 3} and all(0.1 <= c["y"] <= 10 for c in first)


def test_trees_can_be_searched(spark):
    x, y = data(360, 9)
    rows = table(spark, x, y).persist()
    tried = search.search_models(
        rows, 360, [{"rounds": 1, "rate": 0.01}, {"rounds": 4, "rate": 0.5}],
        lambda **p: BoostedTrees(growth=Growth(depth=3, l2=1.0), **p), LABEL, folds=2)
    rows.unpersist()
    assert [t.number for t in tried] == [1, 0]
    assert len(tried[0].scores) == 2 and tried[0].mean > 0.5 > tried[1].mean


def plain_forecast(values, model, steps):
    values, out = [float(v) for v in values], []
    for _ in range(steps):
        recent = values[-3:]
        y = max(0.0, model.base + model.weights[0] * recent[-1]
                + model.weights[1] * sum(recent) / len(recent))
        values.append(y)
        out.append(y)
    return out


def test_days_are_foretold_from_those_before(spark):
    rng = random.Random(5)
    sales = {"x": [rng.randrange(1, 30) for _ in range(40)], "y": [7], "z": [1, 50], "w": [90, 2, 0]}
    daily = spark.createDataFrame([(c, 10 + 2 * k, v) for c, vs in sales.items() for k, v in enumerate(vs)],
                                  f"{CATEGORY} string, time_sk long, sales_volume long").repartition(3)
    for model in (forecast.fit(daily), Linear(forecast.INPUTS, -20.0, (0.5, 0.9))):
        found = {}
        for r in forecast.forecast(daily, model, 5).orderBy("step").collect():
            found.setdefault(r[CATEGORY], []).append((r["time_sk"], r["forecast"]))
        for c, values in sales.items():
            last = 10 + 2 * (len(values) - 1)
            assert [t for t, _ in found[c]] == [last + k for k in range(1, 6)]
            assert [v for _, v in found[c]] == pytest.approx(plain_forecast(values, model, 5))
    inputs, label = [], []
    for values in sales.values():
        for k in range(1, len(values)):
            inputs.append([1, values[k - 1], np.mean(values[max(0, k - 3):k])])
            label.append(values[k])
    base, *weights = np.linalg.lstsq(np.array(inputs, float), np.array(label, float), rcond=None)[0]
    fitted = forecast.fit(daily)
    assert (fitted.base, *fitted.weights) == pytest.approx((base, *weights))


def test_nothing_to_foretell(spark):
    none = spark.createDataFrame([], f"{CATEGORY} string, time_sk long, sales_volume long")
    with pytest.raises(ValueError):
        forecast.fit(none)
    assert forecast.forecast(none, Linear(forecast.INPUTS, 0.0, (1.0, 0.0))).count() == 0
