import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricecast.operators import regress, splits
from pricecast.operators.boost import cuts_of
from pricecast.operators.trees import Forest, ForestParams, grow_drawn_forest, grow_random_forest, uniform, weights


def rows_of(seed=1, n=700):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.normal(size=n), r.integers(0, 4, n), np.full(n, 3.0), r.exponential(size=n), r.normal(size=n).round(1)])
    y = x[:, 0] * 2 + np.sin(x[:, 3] * 3) + 0.3 * x[:, 1] + r.normal(0, 0.1, n)
    return x, y


def grow_one(x, y, tree, params, seed):
    """A tree by recursion over single nodes, with the same draws: {node: (feature, threshold, value, rows)}."""
    p = x.shape[1]
    out = {}

    def visit(node, rows):
        xs, ys = x[rows], y[rows]
        out[node] = (-1, None, ys.mean(), len(rows))
        if node.bit_length() > params.depth() or len(rows) < params.min_samples_split or len(rows) < 2 * params.min_samples_leaf or ys.min() == ys.max():
            return
        live = [f for f in range(p) if xs[:, f].min() < xs[:, f].max()]
        live = sorted(live, key=lambda f: float(uniform(seed, tree, node, f, 1)))[: params.drawn(p)]
        tried = []
        for f in sorted(live):
            lo, hi = xs[:, f].min(), xs[:, f].max()
            cut = lo + float(uniform(seed, tree, node, f, 0)) * (hi - lo)
            left = xs[:, f] <= cut
            if min(left.sum(), (~left).sum()) < params.min_samples_leaf:
                continue
            tried.append((ys[left].sum() ** 2 / left.sum() + ys[~left].sum() ** 2 / (~left).sum(), f, cut, left))
        if not tried:
            return
        most = max(t[0] for t in tried)
        _, f, cut, left = next(t for t in tried if t[0] >= most * (1 - 1e-9))
        out[node] = (f, cut, ys.mean(), len(rows))
        visit(2 * node, rows[left])
        visit(2 * node + 1, rows[~left])

    visit(1, np.arange(len(y)))
    return out


def frame(spark, x, y):
    return spark.createDataFrame([(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "i long, a double, b double, c double, d double, e double, y double")


NAMES = ["a", "b", "c", "d", "e"]
CASES = [
    (ForestParams(6, None, 2, 1, "sqrt"), 50),
    (ForestParams(6, None, 2, 1, "sqrt"), 10_000),
    (ForestParams(4, 5, 8, 3, 1.0), 1),
    (ForestParams(5, 3, 2, 2, 0.6), 120),
    (ForestParams(3, 0, 2, 1, None), 100),
]


@pytest.mark.parametrize("params,local", CASES)
def test_equals_recursion_with_the_same_draws(spark, params, local):
    """All nodes and forecasts agree, whether levels are aggregated by Spark or subtrees finished in tasks."""
    x, y = rows_of()
    df = frame(spark, x, y).repartition(3)
    forest = grow_drawn_forest(df, NAMES, "y", params, 7, local)
    want = [grow_one(x, y, t, params, 7) for t in range(params.n_estimators)]
    got = {(r.tree, r.node): r for r in forest.nodes.collect()}
    assert set(got) == {(t, k) for t, tree in enumerate(want) for k in tree}
    for t, tree in enumerate(want):
        for k, (f, cut, value, n) in tree.items():
            r = got[t, k]
            assert (r.feature, r.n) == (f, n) and abs(r.value - value) < 1e-9
            assert (r.threshold is None) == (cut is None) and (cut is None or abs(r.threshold - cut) < 1e-12)
    asked = rows_of(9, 40)[0]
    made = [r.prediction for r in forest.transform(frame(spark, asked, np.zeros(40))).orderBy("i").collect()]

    def value(tree, row):
        k = 1
        while tree[k][0] >= 0:
            k = 2 * k + int(row[tree[k][0]] > tree[k][1])
        return tree[k][2]

    np.testing.assert_allclose(made, [np.mean([value(t, row) for t in want]) for row in asked], rtol=1e-9)


def test_draws_are_uniform_and_thresholds_not_searched(spark):
    u = uniform(3, 5, np.arange(1, 2001, dtype=np.uint64)[:, None], np.arange(5), 0)
    assert abs(u.mean() - 0.5) < 0.01 and abs(u.var() - 1 / 12) < 0.005 and len(np.unique(u)) == u.size
    x, y = rows_of()
    roots = grow_drawn_forest(frame(spark, x, y), NAMES, "y", ForestParams(40, 1, max_features=1), 3).nodes.where("node = 1 AND feature = 0").collect()
    assert len({r.threshold for r in roots}) == len(roots) > 3


def test_missing_values_and_small_tables(spark):
    x, y = rows_of(n=30)
    df = frame(spark, x, y)
    hole = df.withColumn("a", F.when(F.col("i") != 3, F.col("a"))).withColumn("y", F.when(F.col("i") != 4, F.col("y")))
    forest = grow_drawn_forest(hole, NAMES, "y", ForestParams(3))
    assert {r.n for r in forest.nodes.where("node = 1").collect()} == {28}
    out = forest.transform(hole)
    assert out.where("prediction IS NULL").count() == 1 and out.where("i = 4 AND prediction IS NOT NULL").count() == 1
    alone = grow_drawn_forest(df.limit(1), NAMES, "y", ForestParams(2))
    assert alone.nodes.count() == 2 and isinstance(alone, Forest)
    with pytest.raises(ValueError):
        grow_drawn_forest(df.limit(0), NAMES, "y", ForestParams(2))
    odd = grow_drawn_forest(df.withColumn("a", F.when(F.col("i") == 1, math.inf).otherwise(F.col("a"))), NAMES, "y", ForestParams(5))
    assert odd.transform(df).where("isnan(prediction)").count() == 0


def test_forecaster_and_search_use_drawn_trees(panel):
    split = splits.holdout(panel, 60)
    matrix = regress.scaled_lags(split, (1, 2, 3))
    out = regress.tree_forecast(matrix, (1, 2, 3), "extra_trees", {"n_estimators": 20, "max_features": "sqrt", "min_samples_leaf": 2}, "extra_trees")
    assert out.count() == 120
    train = split.where("split = 'train'").withColumn("lag", F.col("price") + 1).withColumn("actual", F.col("price"))
    params, score = regress.search_trees(train, ["lag", "open"], "extra_trees", 2, 2, space={"n_estimators": [5, 8], "max_depth": [4, None]})
    assert params["n_estimators"] in (5, 8) and score > 0


def grow_searched(codes, y, w, tree, params, seed):
    """A tree by recursion over single nodes, all cuts of all bins tried: {node: (feature, bin, value, weight, gain)}."""
    p = codes.shape[1]
    out = {}

    def visit(node, rows):
        c, ys, ws = codes[rows], y[rows], w[rows]
        n, s = ws.sum(), (ws * ys).sum()
        out[node] = (-1, None, s / n, n, 0.0)
        if node.bit_length() > params.depth() or n < params.min_samples_split or n < 2 * params.min_samples_leaf or ys.min() == ys.max():
            return
        live = [f for f in range(p) if c[:, f].min() < c[:, f].max()]
        live = sorted(sorted(live, key=lambda f: float(uniform(seed, tree, node, f, 1)))[: params.drawn(p)])
        tried = []
        for f in live:
            for b in np.unique(c[:, f])[:-1]:
                left = c[:, f] <= b
                if min(ws[left].sum(), ws[~left].sum()) >= params.min_samples_leaf:
                    tried.append(((ws * ys)[left].sum() ** 2 / ws[left].sum() + (ws * ys)[~left].sum() ** 2 / ws[~left].sum(), f, b, left))
        if not tried:
            return
        best = {f: max(t[0] for t in tried if t[1] == f) for f in live if any(t[1] == f for t in tried)}
        f = next(f for f in best if best[f] >= max(best.values()) * (1 - 1e-9))
        gain, _, b, left = next(t for t in tried if t[1] == f and t[0] >= best[f] * (1 - 1e-9))
        out[node] = (f, b, s / n, n, gain - s * s / n)
        visit(2 * node, rows[left])
        visit(2 * node + 1, rows[~left])

    visit(1, np.flatnonzero(w > 0))
    return out


@pytest.mark.parametrize("params,local,bins", [(ForestParams(5, None, 2, 2, 1.0), 90, 16), (ForestParams(5, None, 4, 1, "sqrt"), 10_000, 256), (ForestParams(4, 4, 2, 3, 0.6), 1, 32)])
def test_random_forest_equals_recursion(spark, params, local, bins):
    x, y = rows_of()
    df = frame(spark, x, y).coalesce(1).orderBy("i")
    forest = grow_random_forest(df, NAMES, "y", params, 7, bins, local)
    cuts = cuts_of(df.select(F.array(*NAMES).alias("x")), 5, bins)
    codes = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
    got = {}
    for r in forest.nodes.collect():
        got.setdefault(r.tree, {})[r.node] = r
    for t in range(params.n_estimators):
        want = grow_searched(codes, y, weights(7, t, np.arange(len(y))), t, params, 7)  # one partition: keys are row numbers
        assert set(got[t]) == set(want)
        for k, (f, b, value, n, gain) in want.items():
            r = got[t][k]
            assert (r.feature, r.n) == (f, n) and abs(r.value - value) < 1e-9 and abs(r.gain - gain) < 1e-6
            assert f < 0 or r.threshold == cuts[f][b]
    share = {}
    for t in got:
        whole = sum(r.gain for r in got[t].values())
        for r in got[t].values():
            if r.feature >= 0:
                share[r.feature] = share.get(r.feature, 0) + r.gain / whole / params.n_estimators
    scores = {r.position: r.score for r in forest.importance().collect()}
    assert len(scores) == 5 and scores[2] == 0.0
    for f, v in share.items():
        assert abs(scores[f] - v) < 1e-9


def test_bootstrap_weights():
    w = weights(1, 3, np.arange(20_000))
    assert abs(w.mean() - 1) < 0.03 and abs(w.var() - 1) < 0.05 and abs((w == 0).mean() - np.exp(-1)) < 0.015
    assert (weights(1, 3, np.arange(10)) != weights(1, 4, np.arange(10))).any()
