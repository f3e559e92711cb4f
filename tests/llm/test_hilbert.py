import numpy as np
from pricecast.llm import hilbert


def brute(ids, vectors, k, every=20):
    out = {}
    for i, q in zip(ids, vectors):
        if i % every == 0:
            s = vectors @ q
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), s[j]) for j in order]
    return out


def test_curve_is_a_walk():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    order = grid[np.argsort(hilbert.hilbert_index(grid, 3))]
    assert sorted(hilbert.hilbert_index(grid, 3)) == list(range(512))
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_recall_scores_and_ties(spark):
    r = np.random.default_rng(5)
    v = r.normal(size=(1500, 16)) * r.uniform(0.5, 2, (1500, 1))
    v[100:500] = v[100]  # one vector held by many ids
    ids = np.arange(1500)
    df = spark.createDataFrame([(int(i), x.tolist(), 0) for i, x in zip(ids, v)], "vec_id long, embedding array<double>, label int")
    got = {}
    for x in hilbert.nearest(df, window=200).collect():
        got.setdefault(x.query_id, {})[x["rank"]] = (x.vec_id, x.score)
    want = brute(ids, v, 20)
    assert set(got) == set(want)
    hit = [len({i for i, _ in w} & {i for i, _ in got[q].values()}) / 20 for q, w in want.items()]
    assert np.mean(hit) >= 0.9
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21))
        pairs = [found[k] for k in range(1, 21)]
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0]))
        assert all(abs(s - v[i] @ v[q]) < 1e-9 for i, s in pairs) and q not in [i for i, _ in pairs]


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in hilbert.nearest(df).collect())
    assert got == [(0, 1, 20, 1.0), (0, 2, 1, 0.5), (20, 1, 0, 1.0), (20, 2, 1, 0.5)]
    assert hilbert.nearest(df.filter("1 = 0")).count() == 0


def test_recall_with_the_registered_settings_at_two_sizes(spark):
    r = np.random.default_rng(7)
    for n, least in ((4_000, hilbert.WINDOW), (12_000, 40)):  # the second starts from windows far too short for the table
        v = r.normal(size=(n, 24))
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
        got = {}
        for x in hilbert.nearest(df, every=100, window=least).collect():
            got.setdefault(x.query_id, set()).add(x.vec_id)
        want = brute(np.arange(n), v, 20, 100)
        assert set(got) == set(want)
        assert np.mean([len({i for i, _ in w} & got[q]) / 20 for q, w in want.items()]) >= 0.9
