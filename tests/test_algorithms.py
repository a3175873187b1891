"""Distributed kernels against brute force on small inputs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from scoria.operators import binning as B
from scoria.operators import model as M
from scoria.operators.metrics import auc
from scoria.operators.ranking import dist_row_number, running_sums


def test_running_sums_match_window(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("ab"), i, rnd.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, o int, v int")
    got = {(r["g"], r["o"]): r["cum_v"] for r in running_sums(df, ["g"], ["o"], ["v"], slices=7).collect()}
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    ref = {(r["g"], r["o"]): r["c"] for r in df.select("g", "o", F.coalesce(F.sum("v").over(w), F.lit(0))
                                                        .alias("c")).collect()}
    assert got == ref


def test_dist_row_number(spark):
    df = spark.createDataFrame([(i % 3, f"k{i:04d}") for i in range(300)], "g int, k string")
    r = dist_row_number(df, ["g"], ["k"], slices=5).collect()
    for g in range(3):
        ks = sorted(x["k"] for x in r if x["g"] == g)
        rn = {x["k"]: x["rn"] for x in r if x["g"] == g}
        assert [rn[k] for k in ks] == list(range(1, len(ks) + 1))


def test_auc_matches_pairwise(spark):
    rnd = random.Random(2)
    rows = [(float(rnd.randint(0, 20)), rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "s double, y int")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert auc(df, "y", "s", slices=4).first()["auc"] == pytest.approx(brute)


def _gain(n, n1, cuts):
    p0 = n1.sum() / n.sum()
    g, h = n * p0 - n1, n * p0 * (1 - p0)
    bounds = [-1] + list(cuts) + [len(n) - 1]
    tot = 0.0
    for a, b in zip(bounds[:-1], bounds[1:]):
        G, H = g[a + 1:b + 1].sum(), h[a + 1:b + 1].sum()
        tot += G * G / H
    return tot


def test_best_first_two_leaves_is_exhaustive_optimum():
    rnd = np.random.default_rng(3)
    n = rnd.integers(20, 60, size=12).astype(float)
    n1 = np.floor(n * np.linspace(0.1, 0.8, 12) * rnd.uniform(0.7, 1.3, 12))
    cuts = B.best_first_splits(n, n1, 2, min_data_in_leaf=30)
    best = max((c for c in range(11) if n[:c + 1].sum() >= 30 and n[c + 1:].sum() >= 30),
               key=lambda c: _gain(n, n1, [c]))
    assert cuts == [best]


def test_monotone_constraint_holds():
    rnd = np.random.default_rng(4)
    n = np.full(30, 100.0)
    n1 = np.clip(np.round(30 + 20 * np.sin(np.arange(30) / 3) + rnd.normal(0, 3, 30)), 0, 100)
    cuts = B.best_first_splits(n, n1, 5, min_data_in_leaf=50, monotone=1)
    bounds = [-1] + cuts + [29]
    rates = [n1[a + 1:b + 1].sum() / n[a + 1:b + 1].sum() for a, b in zip(bounds[:-1], bounds[1:])]
    assert all(x <= y + 1e-12 for x, y in zip(rates, rates[1:]))


def test_merge_ci_and_folds_reduce_bins():
    n = np.array([100, 100, 100, 100, 100.0])
    n1 = np.array([10, 11, 40, 41, 80.0])
    g = B.merge_ci(n, n1, max_bin_count=5)
    assert g[0] == g[1] and g[2] == g[3] and len(set(g)) == 3
    fn = np.tile(n / 5, (5, 1))
    fn1 = np.tile(n1 / 5, (5, 1))
    g2 = B.merge_folds(n, n1, fn, fn1, max_bin_count=3)
    assert len(set(g2)) == 3


def test_glm_matches_numpy_newton(spark):
    rnd = np.random.default_rng(5)
    X = rnd.choice([-0.5, 0.0, 0.7], size=(2000, 2))
    p = 1 / (1 + np.exp(-(X @ np.array([-1.2, 0.8]) - 0.3)))
    y = (rnd.uniform(size=2000) < p).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(t)) for (a, b), t in zip(X, y)], "a double, b double, y int")
    comp = M.compress(df, ["a", "b"], "y", [])
    fit = M.glm_fit(comp, ["a", "b"], [{"id": 0, "lam": 0.0}])[0]
    Xa = np.column_stack([X, np.ones(len(X))])
    beta = np.zeros(3)
    for _ in range(50):
        q = 1 / (1 + np.exp(-(Xa @ beta)))
        H = (Xa * (q * (1 - q))[:, None]).T @ Xa
        beta = beta + np.linalg.solve(H, Xa.T @ (y - q))
    assert fit["beta"] == pytest.approx(beta, abs=1e-6)
    pv, var = M.wald_pvalues(fit["H"], fit["beta"])
    assert var == pytest.approx(np.diag(np.linalg.inv(H)), rel=1e-5)


def test_l1_shrinks_to_zero(spark):
    rnd = np.random.default_rng(6)
    X = rnd.choice([-1.0, 0.0, 1.0], size=(1000, 3))
    y = (rnd.uniform(size=1000) < 1 / (1 + np.exp(-(X[:, 0] * -1.5)))).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(X, y)], "a double, b double, c double, y int")
    comp = M.compress(df, ["a", "b", "c"], "y", [])
    cmin = M.l1_min_c(comp, ["a", "b", "c"])
    fits = M.glm_fit(comp, ["a", "b", "c"], [{"id": 0, "lam": 1 / (0.3 * cmin)}, {"id": 1, "lam": 1 / (100 * cmin)}])
    assert np.all(fits[0]["beta"][:3] == 0)
    assert fits[1]["beta"][0] < 0


def test_gini_ci_brackets_point_estimate(spark):
    from scoria.operators.report import gini_ci
    rnd = np.random.default_rng(7)
    s = rnd.integers(0, 30, size=3000).astype(float)
    y = (rnd.uniform(size=3000) < 1 / (1 + np.exp(-(s - 15) / 5))).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    g = 2 * auc(df, "y", "s").first()["auc"] - 1
    r = gini_ci(df, "y", "s", n=200).first()
    assert r["gini_lo"] < g < r["gini_hi"]
    assert r["gini_hi"] - r["gini_lo"] < 0.2


def test_woe_bootstrap_centres_on_point_woe(spark):
    from scoria.operators.report import woe_bootstrap
    rows = [("a", 1)] * 30 + [("a", 0)] * 70 + [("b", 1)] * 60 + [("b", 0)] * 40
    df = spark.createDataFrame(rows, "c string, y int")
    b = woe_bootstrap(df, "c", "y", n=200).toPandas()
    m = b.groupby("category")["woe"].mean()
    pa = (70 + 0.5) / 110.5, (30 + 0.5) / 90.5
    assert m["a"] == pytest.approx(np.log(pa[0] / pa[1]), abs=0.1)
    assert b["rep"].nunique() == 200
