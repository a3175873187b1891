"""Forests on cells against a plain forest over rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoria.operators import boosting as G
from scoria.operators import forest as T


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 7, (700, 3)).astype(float)
    y = (x[:, 0] + 2 * (x[:, 1] > 2) + rng.normal(size=700) > 5).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "a double, b double, c double, y int")
    edges = T.split_edges(df, ["a", "b", "c"], 16)
    return df, edges, G.bin_cells(df, edges, "y"), x.astype(int), y


def plain(codes, y, copies, model, number):
    """Shares of events of the leaves that rows reach, by recursion over rows with their copies."""
    out = np.zeros(len(y))

    def counts(rows):
        return np.array([copies[rows][y[rows] == k].sum() for k in (0, 1)])

    def gini(c):
        return 1 - ((c / c.sum()) ** 2).sum()

    def split(rows, node, level):
        here, best = counts(rows), (1e-12, None, None)
        if level < model.depth and here.min() > 0 and (not level or here.sum() >= 2 * model.min_share * len(y)):
            for f in model.chosen(number, node):
                for b in range(int(codes[:, f].max())):
                    side = codes[rows, f] <= b
                    left, right = counts(rows[side]), counts(rows[~side])
                    light = min(left.sum(), right.sum())
                    if light == 0 or light < model.min_share * len(y):
                        continue
                    gain = gini(here) - (left.sum() * gini(left) + right.sum() * gini(right)) / here.sum()
                    if gain > best[0] + 1e-12:
                        best = gain, f, b
        if best[1] is None:
            return [(rows, here)]
        side = codes[rows, best[1]] <= best[2]
        a, b = split(rows[side], 2 * node + 1, level + 1), split(rows[~side], 2 * node + 2, level + 1)
        if len(a) == len(b) == 1 and (a[0][1][1] > a[0][1][0]) == (b[0][1][1] > b[0][1][0]):
            return [(rows, here)]
        return a + b

    for rows, c in split(np.arange(len(y)), 0, 0):
        out[rows] = c[1] / c.sum()
    return out


@pytest.mark.parametrize("share,min_share,depth", [(None, 0.0, 4), (0.9, 0.05, 3), (0.2, 0.0, 2)])
def test_like_a_plain_forest(spark, data, share, min_share, depth, monkeypatch):
    df, edges, cells, x, y = data
    monkeypatch.setattr(T, "TASK_BYTES", 20_000)  # several portions a level
    codes = np.stack([np.searchsorted(e, x[:, i]) + 1 for i, e in enumerate(edges.values())])
    model = T.Forest([0, 1, 2], 4, depth, share, min_share, seed=9)
    T.grow(cells, [T.Forest([0, 2], 2, 3), model], 17)
    # the copies of a cell's class, all on its first row
    every, first, count = np.unique(np.vstack([codes, y]), axis=1, return_index=True, return_counts=True)
    order = np.argsort(count, kind="stable")
    every, first, count = every[:, order], first[order], count[order]
    want = np.zeros(len(y))
    for t in range(4):
        copies = np.zeros(len(y))
        copies[first] = T._copies(T._hash(every[:3], every[3]), count, 9, t)
        want += plain(codes.T, y, copies, model, t) / 4
    got = {tuple(r.codes): r.p for r in cells.select("codes", T.probability(F.col("codes"), model).alias("p")).collect()}
    assert [got[tuple(codes[:, i].tolist())] for i in first] == pytest.approx(want[first], abs=1e-12)


def test_more_trees_later_and_any_partitioning(spark, data):
    _, _, cells, _, _ = data
    whole, grown = T.Forest([0, 1, 2], 6, 3), T.Forest([0, 1, 2], 2, 3)
    T.grow(cells, [whole], 17)
    T.grow(cells.repartition(3), [grown], 17)
    grown.size = 6
    T.grow(cells.orderBy("codes"), [grown], 17)
    assert len(grown.trees) == 6
    for a, b in zip(whole.trees, grown.trees):
        assert all((u == v).all() for u, v in zip(a, b))


def test_copies_are_poisson():
    rng = np.random.default_rng(1)
    for mean in (1, 4, 60):
        w = T._copies(rng.integers(0, 2 ** 63, 40_000).astype(np.uint64), np.full(40_000, mean), 3, 7)
        assert abs(w.mean() - mean) < 5 * (mean / 40_000) ** 0.5 and w.var() / mean == pytest.approx(1, abs=0.06)


def test_copies_count_the_steps_of_the_ladder():
    count = np.sort(np.random.default_rng(8).integers(1, len(T.LADDERS), 20_000))
    key = np.random.default_rng(9).integers(0, 2 ** 63, len(count)).astype(np.uint64)
    u = (T._mix(key ^ T._mix(np.array([(3 << 32) + 8], np.uint64))) >> np.uint64(32)).astype(float) / 2.0 ** 32
    assert T._copies(key, count, 3, 7).tolist() == [np.searchsorted(T.LADDERS[c], x, side="right") for c, x in zip(count, u)]


def test_edges_of_few_values_are_the_values(spark):
    df = spark.range(3000).select((F.col("id") % 5).cast("double").alias("a"), F.col("id").cast("double").alias("b"),
                                  F.when(F.col("id") < 2, F.lit(float("nan"))).otherwise(F.when(F.col("id") < 4, 9.0).otherwise(1.0)).alias("c"))
    e = T.split_edges(df, ["a", "b", "c"], 16)
    assert e["a"] == [0.0, 1.0, 2.0, 3.0] and e["c"] == [1.0] and 10 <= len(e["b"]) <= 15


def test_baseline_forest_learns_from_cells(spark, monkeypatch):
    """no fit walks the rows of the table once a tree."""
    from pyspark.ml.classification import RandomForestClassifier
    from scoria.plans.catalog import QUERIES
    monkeypatch.setattr(RandomForestClassifier, "fit", None)
    rows = QUERIES["rf_baseline"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 9 and {r.features for r in rows} == {"all", "psi", "perm"}
    assert all(r.auc > 0.7 for r in rows if r.features == "all")


def test_search_forests_learn_from_cells(spark, monkeypatch):
    """F2: no forest of the search is fitted on rows; a rung keeps the trees of the one before and is scored in one pass."""
    from pyspark.ml.classification import RandomForestClassifier
    from scoria.plans import q_model as Q
    monkeypatch.setattr(RandomForestClassifier, "fit", None)
    monkeypatch.setattr(Q, "FOREST_RUNGS", [(3, 2), (1, 3)])
    monkeypatch.setattr(Q, "BOOST_RUNGS", [(2, 1), (1, 2)])
    grown, grow = [], T.grow
    monkeypatch.setattr(T, "grow", lambda cells, models, n: grown.append([len(m.trees) for m in models]) or grow(cells, models, n))
    rows = {(r.model, r.point): r for r in Q.hyper_search(spark, "/root/testdata/sf0.001").collect()}
    assert grown == [[0, 0, 0], [2]] and len(rows) == 5
    assert sorted(r.trees for (m, _), r in rows.items() if m == "forest") == [2, 2, 3]
    assert sum(r.chosen for r in rows.values()) == 2 and all(r.auc >= 0.5 for r in rows.values())


def test_aucs_of_models_scored_together(spark):
    from scoria.plans import q_model as Q
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(a), int(a + e > 3), "valid" if i % 3 else "train") for i, (a, e) in enumerate(
        zip(rng.integers(0, 6, 300), rng.normal(size=300)))], "a double, y int, part string")
    cells = G.bin_cells(df, T.split_edges(df, ["a"], 8), "y", ["part"])
    models = {4: T.Forest([0], 2, 1), 7: T.Forest([0], 3, 3)}
    T.grow(cells.where("part = 'train'"), list(models.values()), 9)
    got = Q._valid_aucs(cells, models, T.probability)
    one = {i: Q._cell_auc(cells.where("part = 'valid'"), m, ["part"], T.probability).first().auc for i, m in models.items()}
    assert got == pytest.approx(one)
