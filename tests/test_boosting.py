"""Boosted trees with L2 and minimum gain against a plain NumPy booster."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoria.operators import boosting as G


def plain(codes, y, held, features, depth, l2, gamma, min_child, rate, rounds):
    """Margins by plain recursion over rows."""
    f = np.zeros(len(y))
    learn = ~held

    def grow(rows, level):
        g, h = (p[rows] - y[rows]), (p * (1 - p))[rows]
        leaf = -rate * g.sum() / (h.sum() + l2)
        best = (1e-9, None, None)
        for k in features if level < depth else ():
            for b in range(codes[:, k].max()):
                left = codes[rows, k] <= b
                hl, hr = h[left].sum(), h[~left].sum()
                if hl < min_child or hr < min_child:
                    continue
                gain = g[left].sum() ** 2 / (hl + l2) + g[~left].sum() ** 2 / (hr + l2) - g.sum() ** 2 / (h.sum() + l2)
                if gain > best[0] + 1e-9:
                    best = gain, k, b
        if best[1] is None:
            return leaf
        left = codes[rows, best[1]] <= best[2]
        a, b = grow(rows[left], level + 1), grow(rows[~left], level + 1)
        if best[0] < gamma and not isinstance(a, tuple) and not isinstance(b, tuple):
            return leaf
        return best[1], best[2], a, b

    def value(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        tree = grow(np.nonzero(learn)[0], 0)
        f += [value(tree, r) for r in codes]
    return f


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 6, (900, 3))
    y = (x[:, 0] + 2 * (x[:, 1] > 2) * (x[:, 2] < 3) + rng.normal(size=900) > 3.2).astype(int)
    held = rng.random(900) < 0.25
    df = spark.createDataFrame([(*map(float, r), int(t), bool(h)) for r, t, h in zip(x, y, held)], "a double, b double, c double, y int, held boolean")
    edges = G.bin_edges(df, ["a", "b", "c"], 16)
    return G.bin_cells(df, edges, "y", ["held"]), edges, x, y, held


@pytest.mark.parametrize("l2,gamma,min_child", [(0.5, 0.0, 0.1), (10.0, 10.0, 1.0), (3.0, 4.0, 25.0)])
def test_like_a_plain_booster(spark, data, l2, gamma, min_child, monkeypatch):
    monkeypatch.setattr(G, "KEEP", 3)
    cells, edges, x, y, held = data
    models = [G.Booster([0, 1, 2], 3, l2, gamma, min_child, 0.3), G.Booster([0, 2], 2, l2, gamma, min_child, 0.3)]
    G.boost(cells, models, 17, rounds=7, patience=100)
    codes = np.stack([np.searchsorted(edges[c], x[:, i]) + 1 for i, c in enumerate("abc")], 1)
    for m in models:
        want = plain(codes, y, held, m.features, m.depth, l2, gamma, min_child, 0.3, 7)
        assert G._margin(m.trees, codes) == pytest.approx(want, abs=1e-9)
        assert len(m.trees) == 7


def test_constants_take_effect_and_the_held_part_ends_a_model(spark, data):
    cells, edges, x, y, held = data
    loose, tight = G.Booster([0, 1, 2], 4, 0.1, 0.0, 0.1, 0.5), G.Booster([0, 1, 2], 4, 10.0, 10.0, 1.0, 0.5)
    G.boost(cells, [loose, tight], 17, rounds=60, patience=4)
    splits = [np.mean([(t[0] >= 0).sum() for t in m.trees[:5]]) for m in (loose, tight)]
    assert splits[0] > splits[1] > 0
    assert loose.done and len(loose.trees) == int(np.argmin(loose.losses)) < 60
    codes = np.array([r.codes for r in cells.collect()])
    scored = cells.select("codes", G.probability(F.col("codes"), loose).alias("p")).collect()
    by = {tuple(c): m for c, m in zip(codes.tolist(), G._margin(loose.trees, codes))}
    assert all(r.p == pytest.approx(1 / (1 + np.exp(-by[tuple(r.codes)]))) for r in scored)


def test_missing_values_are_a_bin(spark):
    df = spark.createDataFrame([(None, 1), (1.0, 0), (2.0, 0), (float("nan"), 1), (None, 0)], "a double, y int")
    cells = G.bin_cells(df, G.bin_edges(df, ["a"], 4), "y")
    got = {r.codes[0]: (r.n, r.n1) for r in cells.collect()}
    assert got[0] == (2, 1) and sum(n for n, _ in got.values()) == 5


def test_a_round_adds_one_tree_to_the_stored_margins(spark, data, monkeypatch):
    """a job walks no tree of earlier rounds (each level walked up to 25 of every model again)."""
    cells, edges, x, y, held = data
    walked = []
    advance = G._advance
    monkeypatch.setattr(G, "_advance", lambda state, newest: walked.append(sorted(newest)) or advance(state, newest))
    m = G.Booster([0, 1, 2], 3, 1.0, 0.0, 1.0, 0.3)
    G.boost(cells, [m], 17, rounds=5, patience=100)
    assert walked == [[0]] * 4 and len(m.trees) == 5


def test_sums_by_shuffle_and_on_the_driver_agree(spark, data, monkeypatch):
    cells, edges, x, y, held = data
    got = []
    for limit in (G.PARTS_BYTES, 0):
        monkeypatch.setattr(G, "PARTS_BYTES", limit)
        models = [G.Booster([0, 1, 2], 3, 1.0, 0.0, 1.0, 0.3), G.Booster([0, 2], 2, 1.0, 0.0, 1.0, 0.3)]
        G.boost(cells, models, 17, rounds=3, patience=100)
        got.append([t for m in models for t in m.trees])
    for (f, at, v), (g, at2, w) in zip(*got):
        assert (f == g).all() and (at == at2).all() and v == pytest.approx(w)


def test_bins_of_odd_values(spark):
    """The bins count the edges below a value; missing is 0, NaN behind the last."""
    df = spark.createDataFrame([(v,) for v in (None, float("-inf"), 1.0, 1.5, 2.0, 9.0, float("nan"))], "a double")
    assert [r.c[0] for r in df.coalesce(1).select(G.bin_codes({"a": [1.0, 2.0]}).alias("c")).collect()] == [0, 1, 1, 2, 2, 3, 3]


def test_forest_scores_of_rows_that_all_trees_treat_alike(spark):
    """The AUC of a forest from such rows together is that of the rows scored one by one."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from scoria.operators.metrics import auc
    from scoria.plans import q_model as Q
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 2))
    rows = [(float(a), float(b), int(a + b * b + e > 1), "u" if i % 3 else "v") for i, ((a, b), e) in enumerate(zip(x, rng.normal(size=800)))]
    df = spark.createDataFrame(rows, "a double, b double, target int, part string")
    va = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    m = RandomForestClassifier(labelCol="target", numTrees=5, maxDepth=3, maxBins=8, seed=1).fit(va.transform(df))
    seen = []
    far = spark.createDataFrame([(99.0, -99.0, 1, "u")], df.schema)
    want = auc(m.transform(va.transform(df.union(far))).withColumn("score", vector_to_array("probability")[1]), "target", "score", by=["part"])
    real = type(m).transform
    type(m).transform, keep = (lambda self, d: seen.append(d.count()) or real(self, d)), real
    try:
        got = {r.part: r for r in Q._forest_auc(df.union(far), m, ["a", "b"], ["part"]).collect()}
    finally:
        type(m).transform = keep
    assert seen[0] <= 2 * 8 * 8
    for r in want.collect():
        assert got[r.part].auc == pytest.approx(r.auc, abs=1e-12) and (got[r.part].n_pos, got[r.part].n_neg) == (r.n_pos, r.n_neg)
