"""Selection, refits and merging called directly, against plain re-statements of their rules."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoria.functions.exprs import interval_label
from scoria.operators import binning as B
from scoria.operators import model as M
from scoria.operators import sampling as P
from scoria.operators import select as S
from scoria.operators import woe as W
from scoria.operators.metrics import corr_matrix


def _corr(seed, k=6, n=400):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, k))
    x[:, 1] = x[:, 0] + 0.1 * x[:, 1]
    x[:, 4] = x[:, 2] - x[:, 3] + 0.05 * x[:, 4]
    names = [f"f{i}" for i in range(k)]
    return x, names, pd.DataFrame(np.corrcoef(x.T), index=names, columns=names)


@pytest.mark.parametrize("seed", range(4))
def test_vif_filter(seed):
    _, names, corr = _corr(seed)
    kept, dropped = S.vif_filter(corr, names, 5.0)
    left = list(names)
    want = {}
    while len(left) > 1:
        v = np.linalg.inv(corr.loc[left, left].abs().to_numpy() + 1e-4 * np.eye(len(left))).diagonal()
        if v.max() < 5.0:
            break
        want[left[int(v.argmax())]] = v.max()
        left = [f for i, f in enumerate(left) if i != int(v.argmax())]
    assert kept == left and list(dropped) == list(want)
    assert dropped == pytest.approx(want)


@pytest.mark.parametrize("strict", [False, True])
def test_corr_filter_by_auc_and_by_iv(strict):
    _, names, corr = _corr(1)
    for order in (pd.Series(range(6), index=names), pd.Series([3, 9, 1, 1, 1, 0.5], index=names)):
        kept, dropped = S.corr_filter(corr, order, names, 0.6, strict=strict)
        alive = []
        for f in sorted(names, key=lambda f: (-order[f], f)):
            hit = [g for g in alive if abs(corr.loc[f, g]) >= 0.6]
            assert (f in dropped) == bool(hit)
            if hit:
                assert dropped[f] == hit[0]
            else:
                alive.append(f)
        assert kept == alive
    exact = pd.DataFrame([[1.0, 0.6], [0.6, 1.0]], index=["a", "b"], columns=["a", "b"])
    assert S.corr_filter(exact, pd.Series({"a": 1, "b": 0}), ["a", "b"], 0.6, strict=strict)[0] == (["a", "b"] if strict else ["a"])


def test_corr_matrix_with_large_means(spark):
    x, names, corr = _corr(2)
    d = spark.createDataFrame((x + 1e7).tolist(), ", ".join(f"{n} double" for n in names))
    assert np.allclose(corr_matrix(d, names), corr.to_numpy(), atol=1e-6)


def test_select_c():
    path = pd.DataFrame([(0, 0.1, 0, 0.0, 0.0, 0.60), (0, 0.1, 1, 0.0, 0.0, 0.60), (1, 1.0, 0, -0.5, 0.0, 0.70), (1, 1.0, 1, -0.4, -0.1, 0.70),
                         (2, 9.0, 0, -0.9, 0.2, 0.7001), (2, 9.0, 1, -0.9, 0.1, 0.7001)], columns=["ci", "C", "fold", "a", "b", "auc"])
    c, keep, tab = M.select_c(path, ["a", "b"], True, 1e-3)
    assert c == 1.0 and keep == ["a", "b"] and tab["is_neg"].tolist() == [True, True, False]
    assert M.select_c(path, ["a", "b"], False, 1e-5)[0] == 9.0


def _cells(spark, seed=3, n=4000):
    rnd = np.random.default_rng(seed)
    x = rnd.integers(-2, 3, size=(n, 3)).astype(float)
    y = (rnd.random(n) < 1 / (1 + np.exp(0.8 * x[:, 0] + 0.3 * x[:, 1] - 0.2))).astype(int)
    d = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "a double, b double, c double, target int")
    return M.compress(d, ["a", "b", "c"], "target", []).persist()


def test_refits(spark):
    cells = _cells(spark)
    w, b = M.refit_l1(cells, ["a", "b", "c"], 10.0)
    assert set(w) >= {"a", "b"} and all(v < 0 for v in w.values())
    r = M.refit_backward(cells, ["a", "b", "c"], valid=_cells(spark, seed=4))
    assert set(r["weights"]) >= {"a", "b"} and all(v < 0 for v in r["weights"].values())
    assert max(v for k, v in r["p_values"].items() if k != "Intercept_") <= 0.05
    assert set(r["p_values_valid"]) == {*r["weights"], "Intercept_"}
    assert w["a"] == pytest.approx(r["weights"]["a"], abs=0.1) and b == pytest.approx(r["intercept"], abs=0.1)


def test_unsettled_fits_are_reported(spark):
    cells = spark.createDataFrame([(0.0, 5.0, 0.0), (1.0, 5.0, 5.0)], "a double, n double, n1 double")  # separable
    with pytest.warns(RuntimeWarning, match="did not converge"):
        fit = M.glm_fit(cells, ["a"], [{"id": 0, "lam": 0.0}], max_iter=4)[0]
    assert not fit["converged"]


def test_permutation_importance_finds_the_signal(spark):
    d = spark.range(600).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("z"))
    d = d.withColumn("target", (F.col("x") > 3).cast("int"))
    imp = S.permutation_importance(d, lambda f: f.withColumn("score", F.col("x")), ["x", "z"], "k", n_iter=2)
    assert imp["x"] > 0.3 and imp["z"] == pytest.approx(0.0, abs=1e-12)


def test_importance_of_wide_categories(spark):
    d = spark.range(4000).select(F.col("id").alias("k"), F.concat(F.lit("c"), F.col("id") % 900).alias("c"), (F.col("id") % 11).cast("double").alias("x"))
    d = d.withColumn("target", (F.col("x") > 5).cast("int"))
    for kind in ("feature_imp", "perm_imp"):
        imp = S.fit_importance(d, ["x"], ["c"], "k", kind=kind, max_iter=3, n_iter=2)
        assert imp["x"] > 0 and (kind == "feature_imp" or imp["x"] > imp["c"])
    with pytest.raises(ValueError):
        S.fit_importance(d, ["x"], ["c"], "k", kind="other", max_iter=1)
    from scoria.operators.scorecard import ScorecardEstimator
    with pytest.raises(ValueError):
        ScorecardEstimator(imp_type="other")


def test_folds_labels_and_history(spark):
    d = P.assign_folds(spark.range(100).withColumnRenamed("id", "k"), 4, "k", method="hash")
    assert P.exclude_fold(d, 2).where("fold = 2").count() == 0 and P.exclude_fold(d, 2).count() == d.where("fold <> 2").count()
    assert [interval_label(*e, "age") for e in ((None, 3), (3, 5.5), (5.5, None), (None, None))] == [
        "age <= 3.00", "3.00 < age <= 5.50", "age > 5.50", "-inf < age < +inf"]
    t = pd.DataFrame({"feature": ["f", "f", "g"], "bin": [0.0, 1.0, np.nan], "spec": [None, None, "__NaN__"], "woe": [0.1, -0.2, 0.0]})
    assert W.woe_listing(t, {"f": [2.0]})["label"].tolist() == ["f <= 2.00", "f > 2.00", "__NaN__"]
    h = S.history_table({"b": None, "a": ("auc", 0.5, None)}, iv={"b": 0.2})
    assert h["feature"].tolist() == ["a", "b"] and h["reason"].tolist()[0] == "auc" and h["iv"].tolist()[1] == 0.2


def test_merge_ci_by_hand():
    def wilson(k, n, z=1.959963984540054):
        p, den = k / n, 1 + z * z / n
        half = z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / den
        mid = (p + z * z / (2 * n)) / den
        return mid - half, mid + half

    n, n1 = [100.0, 100.0, 100.0], [10.0, 12.0, 70.0]

    def local(rate, size):
        b = max(0.5, int(rate * size))
        return math.log((b / sum(n1)) / (max(size - b, 0.5) / (sum(n) - sum(n1))))

    ends = [[local(r, s) for r in wilson(k, s)] for k, s in zip(n1, n)]
    overlap = [min(a[1], b[1]) - max(a[0], b[0]) for a, b in zip(ends, ends[1:])]
    assert overlap[0] > 0 > overlap[1]
    assert B.merge_ci(n, n1) == [0, 0, 1]
    assert B.merge_ci([100.0] * 4, [10.0, 11.0, 60.0, 61.0]) == [0, 0, 1, 1]


def test_merge_folds_joins_an_unstable_pair():
    n, n1 = np.full(3, 200.0), np.array([20.0, 60.0, 64.0])
    fold_n = np.full((2, 3), 100.0)
    fold_n1 = np.array([[10.0, 34.0, 28.0], [10.0, 26.0, 36.0]])  # the folds disagree on the last two bins
    assert B.merge_folds(n, n1, fold_n, fold_n1, 2) in ([0, 1, 1], [0, 0, 1])
    assert B.merge_folds(n, n1, fold_n, fold_n1, 3) == [0, 1, 2]


@pytest.mark.parametrize("order", ["auc", "iv"])
def test_estimator_keeps_the_better_of_correlated_features(spark, order):
    """With a limit of 0 every pair is correlated, so only the first by the chosen measure stays."""
    from scoria.operators.scorecard import ScorecardEstimator
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 1500)
    rows = [(str(i), int(t), float(rng.normal() + t), float(rng.normal() + 2 * t * (rng.random() < 0.3))) for i, t in enumerate(y)]
    df = spark.createDataFrame(rows, "k string, y int, a double, b double")
    est = ScorecardEstimator(imp_type=None, pearson_th=0.0, vif_th=1e9, order_by=order, p_val=1.0)
    model = est.fit(df, "y", features=["a", "b"])
    measure = est.artifacts["auc"] if order == "auc" else est.artifacts["woe_table"].groupby("feature")["iv"].first().astype(float)
    assert list(model.weights) == [max("ab", key=lambda f: measure[f])]
    with pytest.raises(ValueError, match="order_by"):
        ScorecardEstimator(order_by="gini")
