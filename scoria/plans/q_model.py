"""Registered queries without a SQL oracle (iterative fits, searches, resampling).

Each is checked instead by a brute-force or property test in ``tests/``
(see README).  All read the driver tables through the planted-label frame.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from scoria.operators import binning as B
from scoria.operators import boosting as G
from scoria.operators import forest as T
from scoria.operators import model as M
from scoria.operators import report as R
from scoria.operators import select as S
from scoria.operators import woe as W
from scoria.functions.exprs import md5_bucket
from scoria.operators.metrics import auc
from scoria.operators.sampling import assign_folds
from scoria.operators.scorecard import ScorecardEstimator
from scoria.plans import fixtures as X
from scoria.plans.q_woe import FIX_INTERCEPT, FIX_WEIGHTS, TIEBREAK, TYPES, WOE_SQL, _fixed_model, _frame, _lin_sql, _woe_case_sql
from scoria.plans.registry import query
from scoria.session import by_group, cut_lineage

def fitted(spark, sf, **params):
    """The full scorecard with its default stages, fitted on the train sample."""
    f = X.scorecard_frame(spark, sf).where(F.col("sample") == "train")
    est = ScorecardEstimator(**params)
    return est.fit(f, "target", features=X.FEATURES + ["ship_dt"]), est.artifacts


def _pdf(spark, pdf: pd.DataFrame, schema: str):
    """A small driver table as a DataFrame; NaN is NULL, whatever the session's Arrow setting."""
    rows = [tuple(None if v is None or v != v else v.item() if hasattr(v, "item") else v for v in r)
            for r in pdf.itertuples(index=False, name=None)]
    return spark.createDataFrame(rows, schema)


@query("scorecard_fit")
def scorecard_fit(spark, sf):
    """Full fit (types -> filters -> policy -> binning -> WoE -> selection -> refit);
    returns the scorecard table."""
    model, _ = fitted(spark, sf)
    sc = model.scorecard()
    sc["woe"] = sc["woe"].astype(float)
    return _pdf(spark, sc, "variable string, value string, woe double, coef double, points double")


@query("scorecard_auc")
def scorecard_auc(spark, sf):
    """Fitted model scored on every sample (projection) -> AUC / Gini per sample."""
    model, _ = fitted(spark, sf)
    sc = model.transform(X.scorecard_frame(spark, sf))
    return auc(sc, "target", "prob", by=["sample"])


@query("scorecard_fit_oof")
def scorecard_fit_oof(spark, sf):
    """E23 in the estimator: selection and path on out-of-fold WoE columns; coefficients."""
    model, _ = fitted(spark, sf, oof_woe=True)
    rows = [("Intercept_", float(model.intercept)), *((f, float(w)) for f, w in sorted(model.weights.items()))]
    return spark.createDataFrame(rows, "feature string, coef double")


@query("feature_history")
def feature_history(spark, sf):
    """Why each feature was dropped (no reason = kept), its Gini on WoE and its IV."""
    model, art = fitted(spark, sf)
    iv = art["woe_table"].groupby("feature")["iv"].first().to_dict()
    gini = {f: 2 * float(a) - 1 for f, a in art["auc"].items()}
    h = S.history_table(model.history, gini=gini, iv=iv)
    return _pdf(spark, h, "feature string, reason string, value double, other string, gini double, iv double")


@query("tree_bins")
def tree_bins(spark, sf):
    """Histogram (Spark) + per-feature CV split search (applyInPandas)."""
    f = assign_folds(X.scorecard_frame(spark, sf).where(F.col("sample") == "train"), 5, "k", method="hash")
    n = f.count()
    h = B.histogram_wide(f, X.FEATURES_REAL, "fold", "target")
    t = B.tree_bins(h, 5, W.resolve_threshold(0.01, n), (2, 4), (0.0, 0.5, 1.0),
                    monotone={"l_quantity": 1, "l_discount": 1})
    return t.select("feature", F.posexplode("splits").alias("i", "split"), "num_leaves", "cv_auc")


def _hist(spark, sf):
    f = assign_folds(X.scorecard_frame(spark, sf), 5, "k", method="hash")
    return B.histogram_wide(f, X.FEATURES_REAL, "fold", "target")


@query("merge_ci")
def merge_ci(spark, sf):
    """Adjacent-bin merging by Wilson-interval overlap, per feature (applyInPandas)."""
    h = _hist(spark, sf)

    def run(pdf):
        t = pdf.groupby("qbin", as_index=False).agg(n=("n", "sum"), n1=("n1", "sum"), hi=("hi", "max"))
        g = B.merge_ci(t["n"].to_numpy(float), t["n1"].to_numpy(float), max_bin_count=5)
        return pd.DataFrame({"feature": pdf["feature"].iloc[0], "qbin": t["qbin"], "group": g, "hi": t["hi"]})

    return by_group(h, "feature").groupBy("feature").applyInPandas(run, "feature string, qbin int, group long, hi double")


@query("merge_folds")
def merge_folds(spark, sf):
    """Fold-stability merging of histogram bins to at most 5 bins, per feature."""
    h = _hist(spark, sf)

    def run(pdf):
        t = pdf.groupby("qbin", as_index=False).agg(n=("n", "sum"), n1=("n1", "sum"))
        folds = sorted(pdf["fold"].unique())
        fn = np.stack([pdf[pdf["fold"] == k].set_index("qbin")["n"].reindex(t["qbin"]).fillna(0).to_numpy()
                       for k in folds])
        fn1 = np.stack([pdf[pdf["fold"] == k].set_index("qbin")["n1"].reindex(t["qbin"]).fillna(0).to_numpy()
                        for k in folds])
        g = B.merge_folds(t["n"].to_numpy(float), t["n1"].to_numpy(float), fn, fn1, 5)
        return pd.DataFrame({"feature": pdf["feature"].iloc[0], "qbin": t["qbin"], "group": g})

    return by_group(h, "feature").groupBy("feature").applyInPandas(run, "feature string, qbin int, group long")


@query("merge_special")
def merge_special(spark, sf):
    """Interval and fold merging with heaped values as special points: a third of the quantities is rounded
    to tens and a sixth of the prices replaced by one price list value."""
    f = assign_folds(X.scorecard_frame(spark, sf), 5, "k", method="hash")
    u = md5_bucket(F.concat("k", F.lit("|heap")))
    f = f.withColumn("l_quantity", F.when(u < 1 / 3, F.round("l_quantity", -1)).otherwise(F.col("l_quantity"))).withColumn(
        "l_extendedprice", F.when(u > 5 / 6, F.lit(30000.0)).otherwise(F.col("l_extendedprice"))).persist()
    names = ["l_quantity", "l_extendedprice"]
    special = B.special_points(f, names, share=0.06)
    xs = f.select(*[F.col(c).cast("double").alias(c) for c in names]).unpivot([], names, "feature", "x").where("x IS NOT NULL")
    cuts = {r.feature: r.splits[:-1] for r in B.quantile_splits(xs, 12, "x", exact=True).collect()}
    stats = B.special_stats(f, cuts, special, by=["fold"])
    return B.merge_special(stats, cuts, special, max_bin_count=5)


@query("special_merge", sql=WOE_SQL + """,
m AS (SELECT feature, max(CASE WHEN spec = '__NaN__' THEN raw END) AS here FROM w0 GROUP BY feature),
g AS (SELECT w0.*, CASE WHEN spec IS NULL OR NOT starts_with(spec, '__') OR spec = '__NaN__' THEN abs(raw - here) END AS gap
      FROM w0 JOIN m USING (feature)),
nr AS (SELECT feature, min(gap) FILTER (WHERE gap > 0) AS near FROM g GROUP BY feature),
pl AS (SELECT g.*, coalesce(near < 0.3 AND gap <= near, false) AS pool FROM g JOIN nr USING (feature)),
ps AS (SELECT feature, sum(n0) AS p0, sum(n1) AS p1 FROM pl WHERE pool GROUP BY feature)
SELECT pl.feature, CAST(bin AS DOUBLE) AS bin, spec, n, round(CASE WHEN spec IN ('__NaN_0__', '__Small_0__') THEN 0.0
       WHEN pool THEN ln((p0 / t0) / (p1 / t1)) ELSE raw END, 6) AS woe
FROM pl JOIN tot USING (feature) LEFT JOIN ps USING (feature)""")
def special_merge(spark, sf):
    """A __NaN__ bin close in WoE to a regular bin takes the pooled WoE."""
    from scoria.plans.q_woe import _woe_pd
    t, _ = _woe_pd(spark, sf, woe_diff_th=0.3)
    t = t.assign(n=t["n"].astype("int64"))
    return _pdf(spark, t[["feature", "bin", "spec", "n", "woe"]], "feature string, bin double, spec string, n bigint, woe double")


def _poisson_sql(count: str, key: str) -> str:
    """``report.poisson_weight`` in SQL."""
    u, v = (f"(('0x' || substr(md5({key}), {a}, 8))::BIGINT / 4294967296.0)" for a in (1, 9))
    z = f"sqrt(-2 * ln(1 - {u})) * cos(2 * pi() * {v})"
    steps = "[" + ", ".join("[" + ", ".join(f"{x!r}::DOUBLE" for x in ladder) + "]" for ladder in R.LADDERS) + "]"
    return (f"CASE WHEN {count} <= {R.LADDER} THEN len([c FOR c IN {steps}[CAST(least({count}, {R.LADDER}) AS INT) + 1] IF c <= {u}])::DOUBLE "
            f"ELSE greatest(0.0, floor({count} + sqrt({count}::DOUBLE) * {z} + (({z}) * ({z}) - 1) / 6 + 0.5)) END")


@query("woe_bootstrap", sql=f"""WITH {X.SQL_FRAME},
cells AS (SELECT l_returnflag AS category, sum(1 - target)::BIGINT AS n0, sum(target)::BIGINT AS n1 FROM frame GROUP BY 1),
r AS (SELECT category, rep, n0, n1, '0|' || coalesce('0' || category, '1') || '|' || rep AS k
      FROM cells, (SELECT unnest(range(0, 300))::INT AS rep)),
w AS (SELECT rep, category, {_poisson_sql('n0', "k || '|0'")} AS n0, {_poisson_sql('n1', "k || '|1'")} AS n1 FROM r),
t AS (SELECT rep, sum(n0) AS t0, sum(n1) AS t1 FROM w GROUP BY rep)
SELECT rep, category, round(ln(((n0 + 0.5) / (t0 + 0.5)) / ((n1 + 0.5) / (t1 + 0.5))), 6) AS woe FROM w JOIN t USING (rep)""")
def woe_bootstrap(spark, sf):
    """WoE of each return-flag category over 300 Poisson bootstrap replicates."""
    return R.woe_bootstrap(X.scorecard_frame(spark, sf), "l_returnflag", "target", n=300)


def _gini_ci_sql(n: int, scores: str) -> str:
    """Bootstrap interval of Gini per ``g`` over ``scores`` (g, target, s)."""
    return f"""sc AS ({scores}),
cells AS (SELECT g, s, sum(target)::BIGINT AS pos, sum(1 - target)::BIGINT AS neg FROM sc WHERE s IS NOT NULL GROUP BY 1, 2),
ordered AS (SELECT *, coalesce(sum(pos + neg) OVER (PARTITION BY g ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
       FROM cells),
r AS (SELECT *, '0|' || coalesce('0' || g, '1') || '|' || place || '|' || rep AS k
      FROM ordered, (SELECT unnest(range(0, {n}))::INT AS rep)),
w AS (SELECT g, rep, place, {_poisson_sql('neg', "k || '|0'")} AS neg, {_poisson_sql('pos', "k || '|1'")} AS pos FROM r),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY g, rep ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM w),
a AS (SELECT g, rep, 2 * sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) - 1 AS gini FROM c
      GROUP BY 1, 2 HAVING sum(pos) > 0 AND sum(neg) > 0)
SELECT g, round(quantile_cont(gini, 0.025), 3) AS gini_lo, round(quantile_cont(gini, 0.975), 3) AS gini_hi FROM a GROUP BY g"""


@query("gini_ci", sql=WOE_SQL + ", " + _gini_ci_sql(1000, f"SELECT sample AS g, target, round({_lin_sql()}, 9) AS s FROM frame").replace(
    "SELECT g, round(quantile", "SELECT g AS sample, round(quantile"))
def gini_ci(spark, sf):
    """95 % bootstrap interval of the scorecard Gini per sample (1000 replicates).  Scores are rounded to
    9 digits, so that equal sums of weights are one score in any engine."""
    m = _fixed_model(spark, sf)
    sc = X.scorecard_frame(spark, sf).withColumn("score", F.round(m.linear(), 9))
    return R.gini_ci(sc, "target", "score", by=["sample"], n=1000)


@query("gini_ci_continuous", sql=f"WITH {X.SQL_FRAME}, " + _gini_ci_sql(
    1000, "SELECT CASE WHEN grp % 3 > 0 THEN grp % 3 END AS g, target, l_extendedprice AS s FROM frame"))
def gini_ci_continuous(spark, sf):
    """P10: the same for a score of almost as many values as rows, with a null group (1000 replicates of every row)."""
    f = X.scorecard_frame(spark, sf).withColumn("g", F.when(F.col("grp") % 3 > 0, F.col("grp") % 3))
    return R.gini_ci(f, "target", "l_extendedprice", by=["g"], n=1000)


def _woe_comp(spark, sf, with_fold=True):
    m = _fixed_model(spark, sf)
    f = X.scorecard_frame(spark, sf)
    if with_fold:
        f = assign_folds(f, 6, "k", method="hash")
    w = m.woe_columns(f)
    cols = [F.col(f"woe__{c}").alias(c) for c in FIX_WEIGHTS]
    return w.select("sample", "target", *(["fold"] if with_fold else []), *cols)


@query("l1_path")
def l1_path(spark, sf):
    """L1 path (20 C x 6 folds fitted together) with held-out AUC per C."""
    w = _woe_comp(spark, sf).where(F.col("sample") == "train")
    comp = M.compress(w, list(FIX_WEIGHTS), "target", ["fold"]).persist()
    path, _ = M.l1_path(comp, list(FIX_WEIGHTS), list(range(6)))
    c, keep, tab = M.select_c(path, list(FIX_WEIGHTS))
    tab["chosen"] = tab["C"] == c
    return _pdf(spark, tab[["ci", "C", "score", "is_neg", "chosen"]],
                "ci long, C double, score double, is_neg boolean, chosen boolean")


@query("wald_pvalues")
def wald_pvalues(spark, sf):
    """Backward-elimination refit with Wald p-values (coefficients, p-values)."""
    w = _woe_comp(spark, sf, with_fold=False)
    comp = M.compress(w.where(F.col("sample") == "train"), list(FIX_WEIGHTS), "target", [])
    valid = M.compress(w.where(F.col("sample") == "oot"), list(FIX_WEIGHTS), "target", [])
    # M4: the p-value test is repeated on the out-of-time sample, refitted there
    r = M.refit_backward(comp, list(FIX_WEIGHTS), p_val=0.05, valid=valid)
    t = R.coef_table(r["weights"], r["intercept"], r["p_values"], r["p_values_valid"])
    return _pdf(spark, t, "feature string, coef double, p_value double, p_value_valid double")


_C = list(FIX_WEIGHTS)
VIF_SQL = WOE_SQL + ",\nx AS (SELECT " + ", ".join(f"{_woe_case_sql(f)} AS x{i}" for i, f in enumerate(_C)) + """ FROM frame),
c AS (SELECT corr(x0, x1) AS a, corr(x0, x2) AS b, corr(x1, x2) AS c FROM x),
d AS (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM c)
""" + " UNION ALL ".join(f"SELECT '{f}' AS feature, round((1 - {r} * {r}) / det, 6) AS vif FROM d" for f, r in zip(_C, "cba"))


@query("vif_table", sql=VIF_SQL)
def vif_table(spark, sf):
    """VIF of the WoE columns (k x k correlation from one aggregate)."""
    w = _woe_comp(spark, sf, with_fold=False)
    return _pdf(spark, R.vif_table(w, list(FIX_WEIGHTS)), "feature string, vif double")


@query("greedy_corr")
def greedy_corr(spark, sf):
    """VIF loop then greedy |corr| pruning ordered by AUC (and by IV)."""
    from scoria.operators.metrics import corr_matrix
    w = _woe_comp(spark, sf, with_fold=False)
    aucs = S.woe_aucs(w, list(FIX_WEIGHTS))
    corr = pd.DataFrame(np.abs(corr_matrix(w, list(FIX_WEIGHTS))), index=list(FIX_WEIGHTS), columns=list(FIX_WEIGHTS))
    kept, vdrop = S.vif_filter(corr, list(FIX_WEIGHTS), 5.0)
    kept2, cdrop = S.corr_filter(corr, aucs, kept, 0.9)
    rows = [(f, float(aucs[f]), f in kept2, vdrop.get(f), cdrop.get(f)) for f in FIX_WEIGHTS]
    return spark.createDataFrame(rows, "feature string, auc_woe double, kept boolean, vif_dropped double, "
                                       "corr_with string")


@query("loo_contribution")
def loo_contribution(spark, sf):
    """AUC drop on OOT when refitting without each feature (refits in one batch)."""
    w = _woe_comp(spark, sf, with_fold=False)
    tr = M.compress(w.where(F.col("sample") == "train"), list(FIX_WEIGHTS), "target", [])
    te = M.compress(w.where(F.col("sample") == "oot"), list(FIX_WEIGHTS), "target", [])
    return _pdf(spark, R.loo_contribution(tr, te, list(FIX_WEIGHTS)), "feature string, auc_drop double")


_TIES = ", ".join(TIEBREAK)
_PERM_FEATURES = list(FIX_WEIGHTS)
PERM_SQL = WOE_SQL + f""",
o AS (SELECT * FROM frame WHERE sample = 'oot'),
base AS (SELECT *, row_number() OVER (ORDER BY k, {_TIES}) AS rk FROM o),
its AS (SELECT unnest(range(0, 5)) AS it),
perm AS (SELECT it, row_number() OVER (PARTITION BY it ORDER BY md5(k || '|' || it), k, {_TIES}) AS rk,
                {', '.join(_PERM_FEATURES)} FROM o, its),
v AS (""" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, it, base.target, " + ", ".join(f"{'perm' if g == f else 'base'}.{g} AS {g}" for g in _PERM_FEATURES)
    + " FROM base JOIN perm USING (rk)" for f in _PERM_FEATURES) + " UNION ALL SELECT '', -1, target, " + ", ".join(_PERM_FEATURES) + f""" FROM o),
sc AS (SELECT feature, it, target, {_lin_sql()} AS s FROM v),
c AS (SELECT feature, it, s, sum(target) AS pos, sum(1 - target) AS neg FROM sc GROUP BY 1, 2, 3),
r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY feature, it ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cn FROM c),
a AS (SELECT feature, it, sum(pos * (cn + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM r GROUP BY 1, 2)
SELECT feature, round(min((SELECT auc FROM a WHERE it = -1) - auc), 6) AS importance FROM a WHERE it >= 0 GROUP BY feature"""


@query("perm_importance", sql=PERM_SQL)
def perm_importance(spark, sf):
    """L2: permutation importance (5 md5 shuffles per feature, min AUC drop) of the fixed scorecard."""
    m = _fixed_model(spark, sf)
    f = X.scorecard_frame(spark, sf).where(F.col("sample") == "oot")
    imp = S.permutation_importance(f, lambda d: d.withColumn("score", m.linear()), _PERM_FEATURES, "k",
                                   n_iter=5, reduce="min", tiebreak=TIEBREAK)
    return spark.createDataFrame([(k, float(v)) for k, v in imp.items()], "feature string, importance double")


@query("tree_importance")
def tree_importance(spark, sf):
    """Split counts of boosted trees (hold-out by md5, frequency-encoded categories)."""
    f = X.scorecard_frame(spark, sf).where(F.col("sample") == "train")
    imp = S.tree_importance(f, X.FEATURES_REAL, X.FEATURES_CAT, "target")
    return spark.createDataFrame([(k, float(v)) for k, v in imp.items()], "feature string, importance double")


@query("importance_wide")
def importance_wide(spark, sf):
    """The same for all features and one of thousands of categories."""
    f = X.scorecard_frame(spark, sf).where(F.col("sample") == "train").withColumn("client", F.concat(F.lit("c"), F.col("grp") % 5000))
    imp = S.tree_importance(f, X.FEATURES_REAL, [*X.FEATURES_CAT, "client"], "target")
    return spark.createDataFrame([(k, float(v)) for k, v in imp.items()], "feature string, importance double")


def _splits(spark, sf):
    """Train and valid (md5 of the key, 80 : 20) and out-of-time rows, categories frequency-encoded on train."""
    f = X.scorecard_frame(spark, sf)
    part = F.when(F.col("sample") == "oot", "oot").when(md5_bucket(F.concat("k", F.lit("|valid"))) < 0.2, "valid").otherwise("train")
    f = f.withColumn("part", part)
    return S.encode_categories(f, X.FEATURES_CAT, fit_on=f.where("part = 'train'")).fillna(-1.0, X.FEATURES).persist()


def _forest_auc(df, model, features, by):
    """AUC of a forest whose trees compare single features with thresholds: a value counts as the smallest threshold that is
    not below it, so that rows which every tree treats alike are scored once."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    cuts: dict = {}
    for i, t in re.findall(r"\(feature (\d+) <= ([^)]+)\)", model.toDebugString):
        cuts.setdefault(int(i), set()).add(float(t))
    inner = [np.array(sorted(cuts.get(i, ()))) for i in range(len(features))]

    def alike(x, e):
        def run(v: pa.Array) -> pa.Array:
            return pa.array(np.append(e, np.inf)[np.searchsorted(e, v.to_numpy(zero_copy_only=False))])
        return F.arrow_udf(run, "double")(x)

    y = F.col("target").cast("int")
    cells = df.groupBy(*by, *[alike(F.col(f).cast("double"), e).alias(f) for f, e in zip(features, inner)]).agg(
        F.sum(y).cast("bigint").alias("pos"), F.sum(1 - y).cast("bigint").alias("neg"))
    p = model.transform(VectorAssembler(inputCols=features, outputCol="features").transform(cells)).withColumn("score", vector_to_array("probability")[1])
    return auc(p.groupBy(*by, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "target", "score", by=by, counts=True)


#: Bins of the forests: of the baseline and of the search.
FOREST_BINS, SEARCH_BINS = 128, 64


def _forest_cells(d, bins):
    """Bin edges learnt on train, and cells of all parts; a train row without a label is an error."""
    if d.where("part = 'train' AND target IS NULL").limit(1).count():
        raise ValueError("labels must not be null")
    edges = T.split_edges(d.where("part = 'train'"), X.FEATURES, bins)
    return edges, cut_lineage(G.bin_cells(d.where("target IS NOT NULL"), edges, "target", ["part"]))


@query("rf_baseline")
def rf_baseline(spark, sf):
    """Random forest baseline (200 trees, depth 5), AUC per part for three feature sets: all, stable by PSI, and
    useful by permutation on valid."""
    from scoria.operators.metrics import psi
    d = _splits(spark, sf)
    raw = X.scorecard_frame(spark, sf)
    drift = {r.feature: r.psi for r in psi(raw.where("sample = 'train'"), raw.where("sample = 'oot'"), X.FEATURES).collect()}
    edges, cells = _forest_cells(d, FOREST_BINS)
    sets = {"all": X.FEATURES, "psi": [f for f in X.FEATURES if drift[f] < 0.25] or X.FEATURES}
    models: dict = {}

    def train(names):
        """The forests of feature sets that have none yet, grown together."""
        new = {tuple(sets[s]): T.Forest([X.FEATURES.index(f) for f in sets[s]], 200, 5) for s in names}
        new = {k: m for k, m in new.items() if k not in models}
        if new:
            T.grow(cells.where("part = 'train'"), list(new.values()), FOREST_BINS + 1)
        models.update(new)

    train(["all", "psi"])
    stable = models[tuple(sets["psi"])]

    def score(x):
        """``x`` has the features of the stable set; the forest does not read the others."""
        x = x.withColumns({f: F.lit(None).cast("double") for f in X.FEATURES if f not in x.columns})
        return x.withColumn("score", T.probability(G.bin_codes(edges), stable))

    imp = S.permutation_importance(d.where("part = 'valid'"), score, sets["psi"], "k", n_iter=1)
    sets["perm"] = [f for f in sets["psi"] if imp[f] > 0] or sets["psi"]
    train(["perm"])
    out = None
    for name, features in sets.items():
        a = _cell_auc(cells, models[tuple(features)], ["part"], T.probability)
        a = a.withColumn("features", F.lit(name)).withColumn("n_features", F.lit(len(features)))
        out = a if out is None else out.unionByName(a)
    return out


def _boost_cells(spark, sf):
    """Encoded rows, bin edges learnt on train, and cells of all parts."""
    d = _splits(spark, sf)
    edges = G.bin_edges(d.where("part = 'train'"), X.FEATURES)
    cells = cut_lineage(G.bin_cells(d, edges, "target", ["part"]))
    return d, edges, cells, cells.where("part <> 'oot'").withColumn("held", F.col("part") == "valid")


def _cell_auc(cells, model, by, probability=G.probability):
    scored = cells.select(*by, F.col("n1").alias("pos"), (F.col("n") - F.col("n1")).alias("neg"), probability(F.col("codes"), model).alias("score"))
    return auc(scored.groupBy(*by, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "target", "score", by=by, counts=True)


@query("gbt_baseline")
def gbt_baseline(spark, sf):
    """Boosted trees (up to 1000 rounds, depth 4, rate 0.1, L2 10, minimum gain 10; the valid part ends them), AUC per
    part and feature set: all, stable by PSI, and useful by permutation on valid."""
    from scoria.operators.metrics import psi
    d, edges, cells, fit = _boost_cells(spark, sf)
    raw = X.scorecard_frame(spark, sf)
    drift = {r.feature: r.psi for r in psi(raw.where("sample = 'train'"), raw.where("sample = 'oot'"), X.FEATURES).collect()}
    sets = {"all": X.FEATURES, "psi": [f for f in X.FEATURES if drift[f] < 0.25] or X.FEATURES}
    models: dict = {}

    def train(names):
        """The models of feature sets that have none yet, grown together."""
        new = {tuple(sets[s]): G.Booster([X.FEATURES.index(f) for f in sets[s]]) for s in names}
        new = {k: m for k, m in new.items() if k not in models}
        if new:
            G.boost(fit, list(new.values()), BOOST_BINS, rounds=1000, patience=BOOST_PATIENCE, tol=BOOST_TOL)
        models.update(new)

    train(["all", "psi"])
    stable = models[tuple(sets["psi"])]

    def score(x):
        """``x`` has the features of the stable set; the model does not read the others."""
        x = x.withColumns({f: F.lit(None).cast("double") for f in X.FEATURES if f not in x.columns})
        return x.withColumn("score", G.probability(G.bin_codes(edges), stable))

    imp = S.permutation_importance(d.where("part = 'valid'"), score, sets["psi"], "k", n_iter=1)
    sets["perm"] = [f for f in sets["psi"] if imp[f] > 0] or sets["psi"]
    train(["perm"])
    out = None
    for name, features in sets.items():
        a = _cell_auc(cells, models[tuple(features)], ["part"]).withColumn("features", F.lit(name)).withColumn("n_features", F.lit(len(features)))
        out = a if out is None else out.unionByName(a)
    return out


#: Bins of the boosted models: at most 64 and one of missing values.
BOOST_BINS = 65
#: A model ends after so many rounds whose loss on the valid part is not better by this share.
BOOST_PATIENCE, BOOST_TOL = 10, 0.001
#: Successive halving: how many points go on, and to how many trees / rounds.
FOREST_RUNGS = [(25, 10), (6, 50), (2, 200)]
BOOST_RUNGS = [(25, 10), (6, 40), (2, 1000)]


def _valid_aucs(cells, models, probability):
    """The AUC on valid of each model, all scored in one pass."""
    points = F.explode(F.array(*[F.struct(F.lit(i).alias("point"), probability(F.col("codes"), m).alias("score")) for i, m in models.items()]))
    scored = cells.where("part = 'valid'").select(F.col("n1").alias("pos"), (F.col("n") - F.col("n1")).alias("neg"), points.alias("p"))
    counts = scored.groupBy("p.point", "p.score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return {r.point: r.auc for r in auc(counts, "target", "score", by=["point"], counts=True).collect()}


@query("hyper_search")
def hyper_search(spark, sf):
    """25 points over the stated bounds of the forest (depth 3-8, split and leaf share 0.01-0.5, feature share 0.2-0.8)
    and 25 of the boosted trees (depth 3-6, leaf weight 100-2500, L2 5-100, minimum gain 1-100), by successive
    halving: small ensembles of all, larger ones of the best, and the full 200 trees or 1000 rounds (ended by the
    valid part) of the last two; valid AUC of each point at its last size, and which is chosen."""
    d, _, cells, fit = _boost_cells(spark, sf)
    _, own = _forest_cells(d, SEARCH_BINS)
    rng = np.random.default_rng(27)
    forests = [T.Forest(range(len(X.FEATURES)), 0, int(rng.integers(3, 9)), min_share=min(0.499, float(rng.uniform(0.01, 0.5))),
                        share=round(float(rng.uniform(0.2, 0.8)), 3)) for _ in range(25)]
    boosted = [G.Booster(range(len(X.FEATURES)), int(rng.integers(3, 7)), float(rng.uniform(5, 100)), float(rng.uniform(1, 100)),
                         float(rng.uniform(100, 2500))) for _ in range(25)]
    every = fit.agg(F.sum(F.when(~F.col("held"), F.col("n")))).first()[0]
    for m in boosted:  # the bound is in Hessian, a quarter of a row at most; a small table must leave a split possible
        m.min_child = min(m.min_child, every / 20)

    rows: dict = {}

    def halve(kind, rungs, grow, depth):
        alive = list(range(25))
        for keep, size in rungs:
            alive = sorted(alive, key=lambda i: (-(rows[kind, i][4] or 0), i) if (kind, i) in rows else (0, i))[:keep]
            for i, (score, trees) in grow(alive, size).items():
                rows[kind, i] = (kind, i, depth(i), trees, score, False)
        best = max(alive, key=lambda i: (rows[kind, i][4] or 0, -i))
        rows[kind, best] = (*rows[kind, best][:5], True)

    def grow_boosted(alive, size):
        G.boost(fit, [boosted[i] for i in alive], BOOST_BINS, size - len(boosted[alive[0]].trees) if size < 1000 else size, BOOST_PATIENCE, BOOST_TOL)
        aucs = _valid_aucs(cells, {i: boosted[i] for i in alive}, G.probability)
        return {i: (aucs.get(i), len(boosted[i].trees)) for i in alive}

    def grow_forests(alive, size):
        for i in alive:
            forests[i].size = size  # the trees that a forest has stay
        T.grow(own.where("part = 'train'"), [forests[i] for i in alive], SEARCH_BINS + 1)
        aucs = _valid_aucs(own, {i: forests[i] for i in alive}, T.probability)
        return {i: (aucs.get(i), size) for i in alive}

    halve("forest", FOREST_RUNGS, grow_forests, lambda i: forests[i].depth)
    halve("boosted", BOOST_RUNGS, grow_boosted, lambda i: boosted[i].depth)
    return spark.createDataFrame(list(rows.values()), "model string, point int, max_depth int, trees int, auc double, chosen boolean")
