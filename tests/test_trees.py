import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalwatch.constants import LABEL
from signalwatch.operators import trees as T
from signalwatch.operators.splits import POSITION
from signalwatch.plans.ensembles import BoostedTrees, Forest, forest_standalone


def table(spark, x, y, parts=3):
    rows = [(i, float(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, f"{POSITION} long, {LABEL} double, features array<double>") \
        .repartition(parts)


def data(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), rng.normal(size=n).round(2), rng.integers(0, 3, n),
                         np.zeros(n)])
    y = 3.0 * x[:, 0] + 10 * (x[:, 1] > 0.3) * (x[:, 2] == 1) + rng.normal(size=n).round(2)
    return x, y


def plain_tree(x, g, w, growth, cuts, depth=0, number=1):
    """A tree by trying every split at a value of the whole table."""
    def score(g, w):
        kept = np.sign(g) * max(abs(g) - growth.l1, 0)
        return kept * kept / (w + growth.l2)

    total, n = g.sum(), w.sum()
    out = {number: (-np.sign(total) * max(abs(total) - growth.l1, 0) / (n + growth.l2), None)}
    best = (T.LEAST_GAIN, None)
    if depth < growth.depth and n >= growth.split_rows:
        for f in range(x.shape[1]):
            for cut in cuts[f]:
                left = x[:, f] < cut
                if min(w[left].sum(), w[~left].sum()) < max(growth.leaf_rows, 1):
                    continue
                gain = score(g[left].sum(), w[left].sum()) + score(g[~left].sum(), w[~left].sum()) \
                    - score(total, n)
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut))
    if best[1]:
        f, cut = best[1]
        left = x[:, f] < cut
        out[number] = (out[number][0], best[1])
        out |= plain_tree(x[left], g[left], w[left], growth, cuts, depth + 1, 2 * number)
        out |= plain_tree(x[~left], g[~left], w[~left], growth, cuts, depth + 1, 2 * number + 1)
    return out


def plain_predict(tree, x):
    def one(row):
        n = 1
        while tree[n][1]:
            n = 2 * n + (row[tree[n][1][0]] >= tree[n][1][1])
        return tree[n][0]
    return np.array([one(row) for row in x])


GROWTHS = [T.Growth(depth=3, l1=0.1, l2=1.5), T.Growth(depth=4, leaf_rows=7, split_rows=30),
           T.Growth(depth=2, l1=50.0), T.Growth(depth=1, l1=1e9)]


@pytest.mark.parametrize("growth", GROWTHS)
def test_boosted_trees_are_those_of_brute_force(spark, growth):
    x, y = data()
    model = BoostedTrees(rounds=3, rate=0.3, growth=growth, row_share=1.0, column_share=1.0,
                         bins=1 << 10).fit(table(spark, x, y))
    left, w = y.mean() - y, np.ones(len(y))
    for found in model.trees:
        tree = plain_tree(x, left, w, growth, [np.unique(c) for c in x.T])
        assert set(found) == set(tree)
        for number, (value, split) in tree.items():
            node = found[number]
            assert node.value == pytest.approx(value, abs=1e-9)
            assert (node.feature >= 0) == bool(split)
            if split:
                assert (node.feature, model.cuts[node.feature][node.bin]) == split
        left = left + 0.3 * plain_predict(tree, x)
    seen = model.transform(table(spark, x, y)).orderBy(POSITION).select("prediction", LABEL).collect()
    assert [r[0] for r in seen] == pytest.approx((y + left).tolist(), abs=1e-8)
    assert len(model.trees) == 3 and sum(model.featureImportances) in (0, pytest.approx(1))


def test_bins_and_cuts(spark):
    rng = random.Random(3)
    rows = [[rng.choice([0.0, 1.5, -2.0, 7.0]), float(k)] for k in range(300)]
    df = spark.createDataFrame([(r,) for r in rows], "v array<double>")
    cuts = T.cut_points(df, "v", 2, 8)
    for k in (0, 1):
        ranked = sorted(r[k] for r in rows)
        assert cuts[k] == sorted({ranked[-(-300 * i // 8) - 1] for i in range(1, 8)})
    found = df.select("v", T.binned("v", cuts).alias("b")).collect()
    assert all(r["b"] == [sum(c <= v for c in cs) for v, cs in zip(r["v"], cuts)] for r in found)


def test_fits_do_not_depend_on_partitions_and_use_shares(spark, setting):
    x, y = data(900, 2)
    model = BoostedTrees(rounds=6, growth=T.Growth(depth=3, l1=0.1, l2=1.5), column_share=0.3)
    one = model.fit(table(spark, x, y, 1))
    setting(spark__sql__shuffle__partitions="7")
    assert model.fit(table(spark, x, y, 5)) == one
    used = [{n.feature for n in tree.values() if n.feature >= 0} for tree in one.trees]
    assert all(len(u) <= 1 for u in used) and len(set(map(frozenset, used))) > 1
    assert all(600 < tree[1].n_rows < 850 for tree in one.trees)
    forest = Forest(trees=12, growth=T.Growth(depth=5, split_rows=2))
    first = forest.fit(table(spark, x, y, 1))
    assert first == forest.fit(table(spark, x, y, 4))
    scored = first.transform(table(spark, x, y))
    error = scored.select(F.avg(F.pow(F.col(LABEL) - F.col("prediction"), 2))).first()[0]
    assert error < 0.1 * y.var()


def test_forest_nodes_hold_the_sizes(spark):
    x, y = data(300, 3)
    forest = forest_standalone(trees=8, depth=12, n_features=4)
    model = forest.fit(table(spark, x, y))
    sizes = [(n.feature >= 0, n.n_rows) for tree in model.trees for n in tree.values()]
    assert min(n for _, n in sizes) >= 2 and min(n for split, n in sizes if split) >= 5
    assert any(not split and n in (2, 3, 4) for split, n in sizes)
    # two of four columns for each node: no feature is always the first choice
    assert len({tree[1].feature for tree in model.trees}) > 1
    # drawn with replacement: about as many rows as there are
    assert all(230 < tree[1].n_rows < 370 for tree in model.trees)


def test_rows_without_spread(spark):
    x, y = np.zeros((20, 2)), np.full(20, 4.0)
    for model in (BoostedTrees(rounds=2), Forest(trees=2)):
        found = model.fit(table(spark, x, y)).transform(table(spark, x, y))
        assert {r["prediction"] for r in found.collect()} == {4.0}
