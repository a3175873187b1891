"""The L1 path over wide frames: working sets with KKT checks against the fit of all columns."""

import numpy as np
import pytest

from scoria.operators import model as M
from scoria.session import cut_lineage


def _frame(spark, n, k, seed, folds=3):
    rnd = np.random.default_rng(seed)
    x = rnd.choice([-0.8, -0.1, 0.4, 1.1], size=(n, k))
    x[:, 1] = x[:, 0] * 0.7 + x[:, 1] * 0.3  # a correlated pair
    y = (rnd.random(n) < 1 / (1 + np.exp(1.1 * x[:, 0] + 0.9 * x[:, 2] + 0.7 * x[:, 3] + 0.4))).astype(float)
    fold = rnd.integers(0, folds, n)
    names = [f"f{i}" for i in range(k)]
    spec = ", ".join(f"{c} double" for c in names) + ", fold int, n double, n1 double"
    rows = [(*r, int(f), 1.0, t) for r, f, t in zip(x.tolist(), fold.tolist(), y.tolist())]
    return cut_lineage(spark.createDataFrame(rows, spec).coalesce(4)), names, x, y, fold


def _kkt(x, y, fold, m, beta):
    """Largest breach of the optimality conditions, relative to the penalty."""
    own = fold != m["exclude_fold"] if m.get("exclude_fold") is not None else np.ones(len(y), bool)
    xa = np.column_stack([x[own], np.ones(own.sum())])
    g = xa.T @ (y[own] - 1 / (1 + np.exp(-(xa @ beta))))
    gap = np.where(beta[:-1] != 0, np.abs(g[:-1] - m["lam"] * np.sign(beta[:-1])), np.maximum(np.abs(g[:-1]) - m["lam"], 0))
    return max(gap.max(), abs(g[-1])) / m["lam"]


def test_working_sets_end_in_the_same_fits(spark):
    d, names, x, y, fold = _frame(spark, 1500, 20, 1, folds=2)
    models = [{"id": i * 3 + f, "lam": lam, "exclude_fold": f if f < 2 else None}
              for i, lam in enumerate([3.0, 120.0, 12.0]) for f in range(3)] + [{"id": 99, "lam": 0.0, "active": [0, 2, 3]}]
    wide, all_at_once = (M.glm_fit(d, names, models, budget=b) for b in (200, 10 ** 9))
    for m in models:
        a, b = wide[m["id"]], all_at_once[m["id"]]
        assert a["converged"] and b["converged"] and a["beta"] == pytest.approx(b["beta"], abs=1e-6)
        if m["lam"]:
            assert _kkt(x, y, fold, m, a["beta"]) < 1e-4
    assert set(np.nonzero(wide[99]["beta"])[0]) == {0, 2, 3, 20} and wide[99]["H"] == pytest.approx(all_at_once[99]["H"])


def test_a_thousand_features(spark, monkeypatch):
    d, names, x, y, fold = _frame(spark, 3000, 1000, 2, folds=2)
    taken, job = [], M._stats_job

    def spy(comp, features, models):
        taken.append(sum(M._n_stats(len(m["work"]), len(features) + 1) for m in models))
        return job(comp, features, models)

    monkeypatch.setattr(M, "_stats_job", spy)
    c0 = M.l1_min_c(d, names)
    path, fits = M.l1_path(d, names, [0, 1], cs=[5 * c0, 12 * c0])
    # all columns at once would take 2 million numbers
    assert max(taken) < 100_000
    for m, (_, r) in zip(sorted(fits), path.sort_values("model").iterrows()):
        assert fits[m]["converged"]
        assert _kkt(x, y, fold, {"lam": 1 / r["C"], "exclude_fold": r["fold"]}, fits[m]["beta"]) < 1e-4
    last = path[path["ci"] == 1]
    assert (last[["f0", "f2", "f3"]] < 0).all().all() and (last["auc"] > 0.65).all()
    # held-out AUC by plain counting
    r = last.iloc[0]
    own = fold == r["fold"]
    s = x[own] @ fits[int(r["model"])]["beta"][:-1]
    pos, neg = s[y[own] == 1], s[y[own] == 0]
    plain = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert r["auc"] == pytest.approx(plain, abs=1e-9)
