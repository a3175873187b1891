"""Queries for build steps 4-10: types, policy, WoE, binning, selection, model, report.

SQL-checkable queries use *fixed* splits (the binning search is checked
separately) so every WoE number has an exact DuckDB counterpart.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from scoria.operators import woe as W
from scoria.operators import model as M
from scoria.operators import metrics as T
from scoria.operators import binning as B
from scoria.operators.sampling import assign_folds
from scoria.plans import fixtures as X
from scoria.plans.registry import query
from scoria.session import cut_lineage

TH = 0.005                     # th_const = th_nan = th_cat (fraction of rows)
N_FOLDS = 6
# fixed splits for the SQL-checked WoE queries (chosen here)
FIX_SPLITS = {"l_quantity": [10.0, 20.0, 30.0, 40.0], "l_discount": [0.02, 0.05, 0.08],
              "l_tax": [0.02, 0.05], "l_extendedprice": [10000.0, 30000.0, 50000.0]}
TYPES = {**{f: "real" for f in X.FEATURES_REAL}, **{f: "cat" for f in X.FEATURES_CAT}}
# a fixed scorecard (weights chosen here) over the fixed-split WoE
FIX_WEIGHTS = {"l_quantity": -1.0, "l_discount": -0.9, "l_returnflag": -0.8}
FIX_INTERCEPT = -1.1


# ------------------------------------------------------------------ Spark building blocks

def _frame(spark, sf):
    return X.scorecard_frame(spark, sf)


def _long(spark, sf, with_folds=False):
    f = _frame(spark, sf)
    keep = ["k", "target", "sample"]
    if with_folds:
        # several jobs read the fold-assigned frame: materialise it once
        f = cut_lineage(assign_folds(f, N_FOLDS, "k", target="target", tiebreak=TIEBREAK))
        keep.append("fold")
    return W.to_long_mixed(f, TYPES, keep), f


def _coded(spark, sf, with_folds=False):
    long, f = _long(spark, sf, with_folds)
    n = f.count()
    # the policy needs category counts and missing counts only: non-missing
    # real values are left out of its value-count aggregate
    pol, cats = W.fit_policy(long.where(F.col("xr").isNull()), TYPES, n, TH, TH)
    return W.apply_policy(long, pol, cats), pol, cats


def _stats_parts(spark, sf):
    """(categorical binned rows, real-feature bin statistics, policy): real
    features are binned and counted straight from the wide frame."""
    f = _frame(spark, sf)
    n = f.count()
    keep = ["k", "target", "sample"]
    pol_long = W.to_long_mixed(f, TYPES, keep).where(F.col("xr").isNull())
    pol, cats = W.fit_policy(pol_long, TYPES, n, TH, TH)
    cat_long = W.to_long_mixed(f, {c: "cat" for c in X.FEATURES_CAT}, keep)
    binned_cat = W.assign_bins(W.apply_policy(cat_long, pol, cats), None, None)
    real_stats = W.real_bin_stats(f, FIX_SPLITS, pol, "target")
    return binned_cat, real_stats, pol


def _fixed_splits_df(spark):
    return spark.createDataFrame([(k, v) for k, v in FIX_SPLITS.items()], "feature string, splits array<double>")


def _binned(spark, sf, with_folds=False):
    coded, pol, _ = _coded(spark, sf, with_folds)
    return W.assign_bins(coded, _fixed_splits_df(spark), None), pol


def _woe_pd(spark, sf, woe_diff_th: float = 0.0):
    binned_cat, real_stats, pol = _stats_parts(spark, sf)
    return W.woe_table(binned_cat, woe_diff_th, extra_stats=real_stats), pol


def _fixed_model(spark, sf, features=None):
    """The scorecard of ``FIX_WEIGHTS``; ``features`` (default: its own) are those with bins."""
    table, pol = _woe_pd(spark, sf)
    bins = {}
    for f in features or FIX_WEIGHTS:
        t = table[table["feature"] == f]
        woe = {}
        cat_bins = {}
        for r in t.itertuples():
            if r.spec is not None and r.spec.startswith("__"):
                woe[r.spec] = float(r.woe)
            elif r.spec is not None:          # category keyed by itself
                cat_bins[r.spec] = len(cat_bins)
                woe[cat_bins[r.spec]] = float(r.woe)
            else:
                woe[int(r.bin)] = float(r.woe)
        for k, v in pol[f].spec.items():
            if v is not None:
                woe[k] = float(v)
        bins[f] = M.FeatureBins(f, TYPES[f], FIX_SPLITS.get(f, []), cat_bins, woe, pol[f].nan_key,
                                pol[f].small_key)
    return M.ScorecardModel(bins, dict(FIX_WEIGHTS), FIX_INTERCEPT)


# ------------------------------------------------------------------ SQL building blocks

# the row key has rare duplicates: order ties by further (never-null) columns
TIEBREAK = ["grp", "l_linestatus", "l_returnflag", "l_extendedprice", "l_tax", "ship_dt"]
FOLD_SQL = (f"CAST((row_number() OVER (PARTITION BY target ORDER BY md5(k), k, {', '.join(TIEBREAK)}) - 1) "
            f"% {N_FOLDS} AS INTEGER)")


def _bin_sql(f: str) -> str:
    s = FIX_SPLITS[f]
    return "(" + " + ".join(f"CASE WHEN xr > {v} THEN 1 ELSE 0 END" for v in s) + ")"


def _coded_sql(with_folds=False) -> str:
    """CTEs: frame, lf (long), th, nn (nan counts), cc (category counts), coded."""
    fold_col = ", fold" if with_folds else ""
    frame2 = (f",\nframe2 AS (SELECT *, {FOLD_SQL} AS fold FROM frame)" if with_folds else
              ",\nframe2 AS (SELECT * FROM frame)")
    bins = " ".join(f"WHEN feature = '{f}' THEN {_bin_sql(f)}" for f in FIX_SPLITS)
    return f"""WITH {X.SQL_FRAME}{frame2},
lf AS ({X.sql_long(X.FEATURES_REAL, X.FEATURES_CAT, 'frame2', 'k, target, sample' + fold_col)}),
th AS (SELECT CAST(floor({TH} * count(*)) AS BIGINT) AS t FROM frame),
nn AS (SELECT feature, sum(CASE WHEN xr IS NULL AND xc IS NULL THEN 1 ELSE 0 END) AS m FROM lf GROUP BY feature),
cc AS (SELECT feature, xc, count(*) AS n FROM lf WHERE xc IS NOT NULL GROUP BY feature, xc),
ss AS (SELECT cc.feature, sum(CASE WHEN cc.n < th.t THEN cc.n ELSE 0 END) AS s FROM cc, th GROUP BY cc.feature),
pol AS (SELECT nn.feature,
          CASE WHEN nn.m < th.t THEN '__NaN_0__' ELSE '__NaN__' END AS nan_key,
          CASE WHEN coalesce(ss.s, 0) < th.t THEN '__Small_0__' ELSE '__Small__' END AS small_key
        FROM nn CROSS JOIN th LEFT JOIN ss ON nn.feature = ss.feature),
coded0 AS (
  SELECT lf.*, pol.nan_key, pol.small_key,
    CASE WHEN lf.xr IS NULL AND lf.xc IS NULL THEN pol.nan_key
         WHEN lf.xc IS NOT NULL THEN CASE WHEN cc.n >= th.t THEN lf.xc ELSE pol.small_key END END AS code
  FROM lf JOIN pol ON lf.feature = pol.feature CROSS JOIN th
  LEFT JOIN cc ON lf.feature = cc.feature AND lf.xc = cc.xc),
coded AS (
  SELECT *, CASE WHEN code IN ('__NaN_0__', '__Small_0__') OR (code = '__NaN__' AND xc IS NULL AND feature IN ({", ".join(f"'{f}'" for f in X.FEATURES_REAL)})) THEN code END AS spec,
         CASE WHEN xr IS NOT NULL THEN CASE {bins} END END AS bin
  FROM coded0)"""


def _stats_sql(by: str = "") -> str:
    b = f"{by}, " if by else ""
    return f"""st AS (SELECT feature, {b}bin, CASE WHEN spec IS NOT NULL THEN spec WHEN bin IS NULL THEN code END AS spec,
        count(*) AS n, sum(target) AS n1, count(*) - sum(target) AS n0
      FROM coded GROUP BY ALL)"""


WOE_SQL = _coded_sql() + ",\n" + _stats_sql() + """,
tot AS (SELECT feature, greatest(sum(n1), 0.5) AS t1, greatest(sum(n0), 0.5) AS t0 FROM st GROUP BY feature),
w0 AS (SELECT st.*, ln(((CASE WHEN n0 = 0 THEN 0.5 ELSE n0 END) / t0) / ((CASE WHEN n1 = 0 THEN 0.5 ELSE n1 END) / t1)) AS raw,
              n0 / t0 - n1 / t1 AS d
       FROM st JOIN tot USING (feature)),
iv AS (SELECT feature, sum(d * raw) AS iv FROM w0 GROUP BY feature),
woe AS (SELECT w0.feature, w0.bin, w0.spec, w0.n, w0.n1, w0.n0,
               CASE WHEN w0.spec IN ('__NaN_0__', '__Small_0__') THEN 0.0 ELSE w0.raw END AS woe, iv.iv
        FROM w0 JOIN iv USING (feature))"""


# ------------------------------------------------------------------ step 4: types and policy

@query("type_profile", sql=f"""WITH {X.SQL_FRAME},
lf AS ({X.sql_long()}),
v AS (SELECT feature, coalesce(CAST(xr AS VARCHAR), xc) AS value FROM lf),
base AS (SELECT feature, count(*) AS n_rows, CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null
         FROM v GROUP BY feature),
vc AS (SELECT feature, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY 1, 2),
top AS (SELECT feature, max(n) AS top_count, count(*) AS n_unique FROM vc GROUP BY feature)
SELECT base.*, coalesce(top.top_count, 0) AS top_count, coalesce(top.n_unique, 0) AS n_unique
FROM base LEFT JOIN top USING (feature)""")
def type_profile(spark, sf):
    """Rows, nulls, top-value count and distinct count per feature (one pass)."""
    long, _ = _long(spark, sf)
    return W.profile(long)


@query("const_filter", sql=f"""WITH {X.SQL_FRAME},
lf AS ({X.sql_long()}),
v AS (SELECT feature, coalesce(CAST(xr AS VARCHAR), xc) AS value FROM lf),
base AS (SELECT feature, count(*) AS n_rows, CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null
         FROM v GROUP BY feature),
vc AS (SELECT feature, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY 1, 2),
top AS (SELECT feature, max(n) AS top_count FROM vc GROUP BY feature),
p AS (SELECT base.*, coalesce(top.top_count, 0) AS top_count, n_rows - CAST(floor({TH} * n_rows) AS BIGINT) AS lim
      FROM base LEFT JOIN top USING (feature))
SELECT feature, n_rows, n_null, top_count, (n_null >= lim OR top_count >= lim) AS "drop",
       CASE WHEN n_null >= lim THEN 'NaN values' WHEN top_count >= lim THEN 'constant' END AS reason FROM p""")
def const_filter_q(spark, sf):
    """Constant / mostly-missing feature flags."""
    long, _ = _long(spark, sf)
    return W.const_filter(W.profile(long), TH)


def _infer_sql() -> str:
    parts = []
    for c in ["l_quantity", "l_discount", "l_tax", "l_extendedprice", "grp", "dow"]:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS feature, CASE WHEN count(DISTINCT {x}) > 2 AND count(DISTINCT {x}) <= 5 "
                     f"AND bool_and(coalesce({x} = floor({x}), true)) THEN 'cat' ELSE 'real' END AS ftype FROM f")
    for c in ["l_returnflag", "l_linestatus"]:
        parts.append(f"SELECT '{c}', CASE WHEN count(TRY_CAST({c} AS TIMESTAMP)) = count({c}) "
                     f"AND min(year(TRY_CAST({c} AS TIMESTAMP))) > 1975 THEN 'date' ELSE 'cat' END FROM f")
    parts.append("SELECT 'ship_dt', CASE WHEN min(year(ship_dt)) > 1975 THEN 'date' ELSE 'real' END FROM f")
    return (f"WITH {X.SQL_FRAME},\nf AS (SELECT *, (isodow(ship_dt) - 1) % 4 AS dow FROM frame)\n"
            + "\nUNION ALL ".join(parts))


@query("infer_types", sql=_infer_sql())
def infer_types_q(spark, sf):
    """Inferred types of the frame's columns (dates, strings, few integral values)."""
    f = _frame(spark, sf).withColumn("dow", F.weekday("ship_dt") % 4)
    t = W.infer_types(f.drop("sample"), "target", exclude=["k"])
    rows = [(c, "date" if isinstance(v, tuple) else v) for c, v in t.items()]
    return spark.createDataFrame(rows, "feature string, ftype string")


@query("small_categories", sql=_coded_sql() + """
SELECT cc.feature, cc.xc, cc.n, cc.n < th.t AS small FROM cc, th""")
def small_categories(spark, sf):
    """E5: category counts with the small flag (count < th_cat)."""
    _, _, cats = _coded(spark, sf)
    return cats


@query("apply_policy", sql=_coded_sql() + """
SELECT feature, code, spec, count(*) AS n FROM coded GROUP BY ALL""")
def apply_policy_q(spark, sf):
    """Rows per (feature, code, special) after the small/missing policy."""
    coded, _, _ = _coded(spark, sf)
    return coded.groupBy("feature", "code", "spec").agg(F.count(F.lit(1)).alias("n"))


@query("date_parts", sql=f"""WITH {X.SQL_FRAME}
SELECT k, CAST(isodow(ship_dt) - 1 AS DOUBLE) AS ship_dt__F__wd, CAST(month(ship_dt) AS DOUBLE) AS ship_dt__F__m,
       CAST(year(ship_dt) AS DOUBLE) AS ship_dt__F__y, CAST(day(ship_dt) AS DOUBLE) AS ship_dt__F__d
FROM frame""")
def date_parts_q(spark, sf):
    """date -> weekday (Mon=0), month, year, day features."""
    f = _frame(spark, sf).select("k", "ship_dt")
    d, _ = W.expand_dates(f, {"ship_dt": (None, ("wd", "m", "y", "d"))})
    return d.drop("ship_dt")


@query("freq_encode", sql=f"""WITH {X.SQL_FRAME},
lf AS ({X.sql_long([], X.FEATURES_CAT)}),
vc AS (SELECT feature, xc, count(*) AS n FROM lf WHERE xc IS NOT NULL GROUP BY 1, 2),
kept AS (SELECT feature, xc, n + (row_number() OVER (PARTITION BY feature ORDER BY n DESC, xc) - 1)
                 / count(*) OVER (PARTITION BY feature) AS freq FROM vc WHERE n >= 2)
SELECT vc.feature, vc.xc, round(coalesce(kept.freq, 0.0), 6) AS freq
FROM vc LEFT JOIN kept ON vc.feature = kept.feature AND vc.xc = kept.xc""")
def freq_encode_q(spark, sf):
    """Frequency encoding with tie-break fractions; singletons -> 0."""
    long, _ = _long(spark, sf)
    return W.freq_encode(long.where(F.col("feature").isin(X.FEATURES_CAT)))


# ------------------------------------------------------------------ step 5: WoE core

@query("bin_stats", sql=_coded_sql() + ",\n" + _stats_sql() + """
SELECT feature, bin, spec, n, CAST(n1 AS BIGINT) AS n1, CAST(n0 AS BIGINT) AS n0 FROM st""")
def bin_stats_q(spark, sf):
    """Per (feature, bin, special) size / events / non-events — one job for all features."""
    binned_cat, real_stats, _ = _stats_parts(spark, sf)
    return W.bin_stats(binned_cat).unionByName(real_stats)


@query("woe_table", sql=WOE_SQL + """
SELECT feature, CAST(bin AS DOUBLE) AS bin, spec, n, CAST(n1 AS BIGINT) AS n1, CAST(n0 AS BIGINT) AS n0,
       round(woe, 6) AS woe, round(iv, 6) AS iv FROM woe""")
def woe_table_q(spark, sf):
    """WoE per bin (zero counts -> 0.5), IV per feature, `_0` specials -> 0."""
    t, _ = _woe_pd(spark, sf)
    t = t.assign(n=t["n"].astype("int64"), n1=t["n1"].astype("int64"), n0=t["n0"].astype("int64"))
    return spark.createDataFrame(t[["feature", "bin", "spec", "n", "n1", "n0", "woe", "iv"]],
                                 "feature string, bin double, spec string, n bigint, n1 bigint, n0 bigint, "
                                 "woe double, iv double")


@query("iv", sql=WOE_SQL + """
SELECT DISTINCT feature, round(iv, 6) AS iv FROM woe""")
def iv_q(spark, sf):
    """Information value per feature."""
    t, _ = _woe_pd(spark, sf)
    iv = t.groupby("feature", as_index=False)["iv"].first()
    return spark.createDataFrame(iv, "feature string, iv double")


@query("oof_mean_target", sql=_coded_sql(True) + """,
per AS (SELECT feature, code, fold, count(*) AS n_f, sum(target) AS s_f FROM coded
        WHERE code IS NOT NULL AND spec IS NULL AND feature IN ('l_returnflag', 'l_linestatus') GROUP BY 1, 2, 3),
tot AS (SELECT feature, code, sum(n_f) AS n_c, sum(s_f) AS s_c FROM per GROUP BY 1, 2),
fs AS (SELECT feature, fold, sum(n_f) AS nf, sum(s_f) AS sf FROM per GROUP BY 1, 2),
gs AS (SELECT feature, sum(nf) AS ng, sum(sf) AS sg FROM fs GROUP BY 1),
g AS (SELECT fs.feature, fs.fold, (gs.sg - fs.sf) / (gs.ng - fs.nf) AS m_f FROM fs JOIN gs USING (feature))
SELECT per.feature, per.code, per.fold, per.n_f AS n, CAST(per.s_f AS DOUBLE) AS n1,
       round(CASE WHEN tot.n_c - per.n_f > 0 THEN ((tot.s_c - per.s_f) + 1.0 * g.m_f) / ((tot.n_c - per.n_f) + 1.0) END, 6) AS enc
FROM per JOIN tot USING (feature, code) JOIN g ON per.feature = g.feature AND per.fold = g.fold""")
def oof_mean_target(spark, sf):
    """Out-of-fold smoothed mean-target encoding (alpha = 1), totals minus fold."""
    coded, _, _ = _coded(spark, sf, with_folds=True)
    return W.mean_target_oof(coded.where(F.col("feature").isin(X.FEATURES_CAT)), alpha=1.0)


ENC_SPLITS = [0.22, 0.3]


@query("reverse_encode", sql=_coded_sql(True) + f""",
per AS (SELECT feature, code, fold, count(*) AS n_f, sum(target) AS s_f FROM coded
        WHERE code IS NOT NULL AND spec IS NULL AND feature IN ('l_returnflag', 'l_linestatus') GROUP BY 1, 2, 3),
tot AS (SELECT feature, code, sum(n_f) AS n_c, sum(s_f) AS s_c FROM per GROUP BY 1, 2),
fs AS (SELECT feature, fold, sum(n_f) AS nf, sum(s_f) AS sf FROM per GROUP BY 1, 2),
gs AS (SELECT feature, sum(nf) AS ng, sum(sf) AS sg FROM fs GROUP BY 1),
g AS (SELECT fs.feature, fs.fold, (gs.sg - fs.sf) / (gs.ng - fs.nf) AS m_f FROM fs JOIN gs USING (feature)),
e AS (SELECT per.feature, per.code, per.n_f AS n,
        CASE WHEN tot.n_c - per.n_f > 0 THEN ((tot.s_c - per.s_f) + 1.0 * g.m_f) / ((tot.n_c - per.n_f) + 1.0) END AS enc
      FROM per JOIN tot USING (feature, code) JOIN g ON per.feature = g.feature AND per.fold = g.fold),
b AS (SELECT feature, code, CASE WHEN enc IS NULL THEN {len(ENC_SPLITS)} ELSE
        {" + ".join(f"CASE WHEN enc > {s} THEN 1 ELSE 0 END" for s in ENC_SPLITS)} END AS bin, sum(n) AS n
      FROM e GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY feature, code ORDER BY n DESC, bin) AS rn FROM b)
SELECT feature, code, CAST(bin AS INTEGER) AS bin FROM r WHERE rn = 1""")
def reverse_encode_q(spark, sf):
    """Category -> bin holding most of its out-of-fold encoded rows."""
    coded, _, _ = _coded(spark, sf, with_folds=True)
    enc = W.mean_target_oof(coded.where(F.col("feature").isin(X.FEATURES_CAT)), alpha=1.0)
    sp = spark.createDataFrame([(f, ENC_SPLITS) for f in X.FEATURES_CAT], "feature string, splits array<double>")
    return W.reverse_encode(enc, sp)


def _woe_case_sql(f: str) -> str:
    """WoE of feature f for a frame row, from the `woe` CTE (scalar subqueries)."""
    if TYPES[f] == "real":
        splits = FIX_SPLITS[f]
        b = " + ".join(f"CASE WHEN {f} > {v} THEN 1 ELSE 0 END" for v in splits)
        nan = (f"(SELECT CASE WHEN max(spec) = '__NaN_0__' THEN 0.0 ELSE max(woe) END FROM woe "
               f"WHERE feature = '{f}' AND spec LIKE '__NaN%')")
        return (f"CASE WHEN {f} IS NULL THEN coalesce({nan}, 0.0) ELSE coalesce((SELECT max(woe) FROM woe "
                f"WHERE feature = '{f}' AND bin = {b}), 0.0) END")
    return (f"coalesce((SELECT max(woe) FROM woe WHERE feature = '{f}' AND spec = {f}), "
            f"(SELECT max(woe) FROM woe WHERE feature = '{f}' AND spec LIKE '__Small%'), 0.0)")


@query("woe_transform", sql=WOE_SQL + """
SELECT k, """ + ",\n       ".join(f"round({_woe_case_sql(f)}, 6) AS woe__{f}" for f in FIX_WEIGHTS) + """
FROM frame""")
def woe_transform(spark, sf):
    """Value -> bin -> WoE as column expressions (a projection, no shuffle)."""
    m = _fixed_model(spark, sf)
    return m.woe_columns(_frame(spark, sf)).select("k", *[f"woe__{f}" for f in FIX_WEIGHTS])


@query("oof_woe", sql=_coded_sql(True) + ",\n" + _stats_sql("fold") + """,
tt AS (SELECT feature, bin, spec, sum(n) AS n, sum(n1) AS n1, sum(n0) AS n0 FROM st GROUP BY ALL),
folds AS (SELECT DISTINCT fold FROM st),
rest AS (SELECT tt.feature, folds.fold, tt.bin, tt.spec, tt.n - coalesce(st.n, 0) AS n,
                tt.n1 - coalesce(st.n1, 0) AS n1, tt.n0 - coalesce(st.n0, 0) AS n0
         FROM tt CROSS JOIN folds LEFT JOIN st ON tt.feature = st.feature AND folds.fold = st.fold
           AND tt.bin IS NOT DISTINCT FROM st.bin AND tt.spec IS NOT DISTINCT FROM st.spec),
tot AS (SELECT feature, fold, greatest(sum(n1), 0.5) AS t1, greatest(sum(n0), 0.5) AS t0 FROM rest GROUP BY 1, 2),
w AS (SELECT rest.feature, rest.fold, rest.bin, rest.spec,
        CASE WHEN rest.spec IN ('__NaN_0__', '__Small_0__') THEN 0.0 ELSE
        ln(((CASE WHEN n0 = 0 THEN 0.5 ELSE n0 END) / t0) / ((CASE WHEN n1 = 0 THEN 0.5 ELSE n1 END) / t1)) END AS woe
      FROM rest JOIN tot ON rest.feature = tot.feature AND rest.fold = tot.fold),
rows AS (SELECT k, feature, fold, bin, CASE WHEN spec IS NOT NULL THEN spec WHEN bin IS NULL THEN code END AS sk FROM coded)
SELECT rows.k, rows.feature, round(w.woe, 6) AS woe
FROM rows LEFT JOIN w ON rows.feature = w.feature AND rows.fold = w.fold
  AND rows.bin IS NOT DISTINCT FROM w.bin AND rows.sk IS NOT DISTINCT FROM w.spec""")
def oof_woe(spark, sf):
    """Out-of-fold WoE — fold f's rows get WoE from the other folds' counts."""
    binned, _ = _binned(spark, sf, with_folds=True)
    return W.woe_oof(binned, "fold").select("k", "feature", "woe")


# ------------------------------------------------------------------ step 6: binning

@query("quantile_bins", sql=f"""WITH {X.SQL_FRAME},
lf AS ({X.sql_long(X.FEATURES_REAL, [])}),
q AS (SELECT feature, unnest(list_distinct(quantile_cont(xr, [0.2, 0.4, 0.6, 0.8, 1.0]))) AS split
      FROM lf WHERE xr IS NOT NULL GROUP BY feature)
SELECT feature, round(split, 6) AS split FROM q""")
def quantile_bins(spark, sf):
    """Percentile splits at step 100/q (last = 100), unique — exact here, to be checked."""
    long, _ = _long(spark, sf)
    xs = long.where(F.col("feature").isin(X.FEATURES_REAL) & F.col("xr").isNotNull())
    q = B.quantile_splits(xs, 5, "xr", exact=True)
    return q.select("feature", F.explode("splits").alias("split"))


# ------------------------------------------------------------------ step 7: selection

def _auc_woe_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, target, {_woe_case_sql(f)} AS w FROM frame" for f in X.FEATURES)
    return f""",
lw AS ({parts}),
c AS (SELECT feature, w AS s, sum(target) AS pos, sum(1 - target) AS neg FROM lw GROUP BY 1, 2),
r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY feature ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cn FROM c),
a AS (SELECT feature, sum(pos * (cn + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM r GROUP BY feature)"""


AUC_TH = 0.505


@query("auc_filter", sql=WOE_SQL + _auc_woe_sql() + f"""
SELECT feature, round(1 - auc, 6) AS auc_woe, (1 - auc) >= {AUC_TH} AS keep FROM a""")
def auc_filter(spark, sf):
    """L4/R2: 1 - AUC of each candidate's WoE column, kept when >= auc_th (one job)."""
    w = _fixed_model(spark, sf, X.FEATURES).woe_columns(_frame(spark, sf), X.FEATURES)
    long = w.select("target", *[F.col(f"woe__{f}").alias(f) for f in X.FEATURES]).unpivot(
        ["target"], X.FEATURES, "feature", "w")
    a = T.auc(long, "target", "w", by=["feature"])
    return a.select("feature", (1 - F.col("auc")).alias("auc_woe"), ((1 - F.col("auc")) >= AUC_TH).alias("keep"))


@query("const_woe", sql=WOE_SQL + """,
lw AS (""" + " UNION ALL ".join(f"SELECT '{f}' AS feature, {_woe_case_sql(f)} AS w FROM frame" for f in X.FEATURES) + """)
SELECT feature, round(stddev_pop(w), 6) AS sd, stddev_pop(w) = 0 AS is_const FROM lw GROUP BY feature""")
def const_woe(spark, sf):
    """L3: single-valued WoE columns (stddev 0) of all candidates."""
    w = _fixed_model(spark, sf, X.FEATURES).woe_columns(_frame(spark, sf), X.FEATURES)
    long = w.select(*[F.col(f"woe__{f}").alias(f) for f in X.FEATURES]).unpivot([], X.FEATURES, "feature", "w")
    return long.groupBy("feature").agg(F.stddev_pop("w").alias("sd"), (F.stddev_pop("w") == 0).alias("is_const"))


@query("topk_features", sql=WOE_SQL + """
SELECT feature, round(iv, 6) AS iv FROM (SELECT DISTINCT feature, iv FROM woe) ORDER BY iv DESC, feature LIMIT 3""")
def topk_features(spark, sf):
    """Top-k features by information value (the limit is the feature)."""
    from scoria.operators.select import topk
    t, _ = _woe_pd(spark, sf)
    iv = spark.createDataFrame(t.groupby("feature", as_index=False)["iv"].first(), "feature string, iv double")
    return topk(iv, 3, by="iv")


# ------------------------------------------------------------------ steps 8-9: scoring and report tables

def _lin_sql() -> str:
    return f"{FIX_INTERCEPT} + " + " + ".join(f"{w} * ({_woe_case_sql(f)})" for f, w in FIX_WEIGHTS.items())


@query("score_sql", sql=WOE_SQL + f"""
SELECT k, round(1 / (1 + exp(-({_lin_sql()}))), 6) AS prob FROM frame""")
def score_sql(spark, sf):
    """Scorecard probability as plain column expressions (no shuffle in the plan)."""
    m = _fixed_model(spark, sf)
    return m.transform(_frame(spark, sf)).select("k", "prob")


@query("woe_bars", sql=WOE_SQL + """,
lw AS (""" + " UNION ALL ".join(f"SELECT sample, target, '{f}' AS feature, round({_woe_case_sql(f)}, 3) AS w FROM frame"
                                 for f in FIX_WEIGHTS) + """),
c AS (SELECT sample, feature, w, count(*) AS n, avg(target) AS rate FROM lw GROUP BY 1, 2, 3)
SELECT sample, feature, w AS woe, n, round(n / sum(n) OVER (PARTITION BY sample, feature), 6) AS share,
       round(rate, 6) AS rate FROM c""")
def woe_bars(spark, sf):
    """Frequency, share and event rate per WoE value (rounded 3), train vs test."""
    m = _fixed_model(spark, sf)
    w = m.woe_columns(_frame(spark, sf))
    long = w.select("sample", "target", *[F.round(f"woe__{f}", 3).alias(f) for f in FIX_WEIGHTS]).unpivot(
        ["sample", "target"], list(FIX_WEIGHTS), "feature", "woe")
    c = long.groupBy("sample", "feature", "woe").agg(F.count(F.lit(1)).alias("n"), F.avg("target").alias("rate"))
    tot = c.groupBy("sample", "feature").agg(F.sum("n").alias("_t"))
    return c.join(F.broadcast(tot), ["sample", "feature"]).select(
        "sample", "feature", "woe", "n", (F.col("n") / F.col("_t")).alias("share"), "rate")


@query("backlash", sql=WOE_SQL + f""",
sc AS (SELECT *, 1 / (1 + exp(-({_lin_sql()}))) AS prob FROM frame),
lw AS (""" + " UNION ALL ".join(f"SELECT target, prob, '{f}' AS feature, round({_woe_case_sql(f)}, 3) AS w FROM sc"
                                 for f in FIX_WEIGHTS) + """)
SELECT feature, w AS woe, round(avg(prob), 6) AS mean_pred, round(avg(target), 6) AS mean_target
FROM lw GROUP BY 1, 2""")
def backlash(spark, sf):
    """Mean prediction vs mean target per WoE value."""
    m = _fixed_model(spark, sf)
    d = m.transform(m.woe_columns(_frame(spark, sf)))
    long = d.select("target", "prob", *[F.round(f"woe__{f}", 3).alias(f) for f in FIX_WEIGHTS]).unpivot(
        ["target", "prob"], list(FIX_WEIGHTS), "feature", "woe")
    return long.groupBy("feature", "woe").agg(F.avg("prob").alias("mean_pred"), F.avg("target").alias("mean_target"))


@query("scorecard_points", sql=WOE_SQL + """,
pts AS (""" + " UNION ALL ".join(
    f"SELECT '{f}' AS variable, coalesce(CAST(CAST(bin AS INTEGER) AS VARCHAR), spec) AS value, woe, {w} AS coef FROM woe "
    f"WHERE feature = '{f}'" for f, w in FIX_WEIGHTS.items()) + f""")
SELECT variable, value, round(woe, 6) + 0.0 AS woe, round(coef, 6) AS coef, round(woe * coef, 6) + 0.0 AS points FROM pts
UNION ALL SELECT 'Intercept', '', NULL, {FIX_INTERCEPT}, {FIX_INTERCEPT}""")
def scorecard_points(spark, sf):
    """Scorecard table (variable, value, WoE, coefficient, points); intercept row first."""
    t, _ = _woe_pd(spark, sf)
    rows = [("Intercept", "", None, FIX_INTERCEPT, FIX_INTERCEPT)]
    for f, w in FIX_WEIGHTS.items():
        for r in t[t["feature"] == f].itertuples():
            v = str(int(r.bin)) if r.spec is None else r.spec
            rows.append((f, v, float(r.woe), w, float(r.woe) * w))
    return spark.createDataFrame(rows, "variable string, value string, woe double, coef double, points double")


# ------------------------------------------------------------------ step 10: call-only filters

@query("gini_filter", sql=f"""WITH {X.SQL_FRAME},
lf AS ({X.sql_long(X.FEATURES_REAL, [])}),
c AS (SELECT sample, feature, xr AS s, sum(target) AS pos, sum(1 - target) AS neg FROM lf WHERE xr IS NOT NULL GROUP BY 1, 2, 3),
r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY sample, feature ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cn FROM c),
a AS (SELECT sample, feature, 100 * abs(2 * sum(pos * (cn + neg / 2.0)) / (sum(pos) * sum(neg)) - 1) AS g FROM r GROUP BY 1, 2),
p AS (SELECT t.feature, t.g AS gini_train, o.g AS gini_oot FROM a t JOIN a o ON t.feature = o.feature
      WHERE t.sample = 'train' AND o.sample = 'oot')
SELECT feature, round(gini_train, 6) AS gini_train, round(gini_oot, 6) AS gini_oot,
       (gini_train >= 5 AND abs(gini_train - gini_oot) <= 5
        AND abs(gini_train - gini_oot) <= 0.1 * gini_train) AS keep FROM p""")
def gini_filter(spark, sf):
    """|Gini| per feature on train and OOT; keep when >= 5 with small absolute/relative drift."""
    f = _frame(spark, sf)
    long = T.to_long(f, X.FEATURES_REAL, ["sample", "target"], value="xr")
    a = T.auc(long, "target", "xr", by=["sample", "feature"]).select(
        "sample", "feature", (100 * F.abs(F.col("gini"))).alias("g"))
    tr = a.where(F.col("sample") == "train").select("feature", F.col("g").alias("gini_train"))
    oo = a.where(F.col("sample") == "oot").select("feature", F.col("g").alias("gini_oot"))
    p = tr.join(oo, "feature")
    d = F.abs(F.col("gini_train") - F.col("gini_oot"))
    keep = (F.col("gini_train") >= 5) & (d <= 5) & (d <= 0.1 * F.col("gini_train"))
    return p.select("feature", "gini_train", "gini_oot", keep.alias("keep"))


PSI_TH = 0.01


@query("psi_filter", sql=f"""WITH {X.SQL_FRAME},
lf AS ({X.sql_long(X.FEATURES_REAL, X.FEATURES_CAT)}),
v AS (SELECT sample, feature, coalesce(CAST(xr AS VARCHAR), xc) AS value FROM lf),
c AS (SELECT feature, value, sum(CASE WHEN sample = 'train' THEN 1 ELSE 0 END) AS n_tr,
             sum(CASE WHEN sample = 'oot' THEN 1 ELSE 0 END) AS n_te FROM v GROUP BY feature, value),
s AS (SELECT feature, n_tr / sum(n_tr) OVER (PARTITION BY feature) AS tr,
             n_te / sum(n_te) OVER (PARTITION BY feature) AS te FROM c),
p AS (SELECT feature, sum((tr - te) * ln((tr + 0.001) / (te + 0.001))) AS psi FROM s GROUP BY feature)
SELECT feature, round(psi, 6) AS psi, psi < {PSI_TH} AS keep FROM p""")
def psi_filter(spark, sf):
    """PSI train vs OOT per feature; keep when below the threshold."""
    f = _frame(spark, sf)
    p = T.psi(f.where(F.col("sample") == "train"), f.where(F.col("sample") == "oot"), X.FEATURES)
    return p.select("feature", "psi", (F.col("psi") < PSI_TH).alias("keep"))


# ------------------------------------------------------------------ more report tables (R9, R10, R19, W1) and CSV I/O

@query("roc_by_feature", sql=WOE_SQL + """,
lw AS (""" + " UNION ALL ".join(f"SELECT '{f}' AS feature, target, -({_woe_case_sql(f)}) AS s FROM frame WHERE sample = 'oot'"
                                 for f in FIX_WEIGHTS) + """),
c AS (SELECT feature, round(s, 6) AS s, sum(target) AS pos, sum(1 - target) AS neg FROM lw GROUP BY 1, 2),
r AS (SELECT feature, s, sum(pos) OVER (PARTITION BY feature ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cp,
             sum(neg) OVER (PARTITION BY feature ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cn,
             sum(pos) OVER (PARTITION BY feature) AS P, sum(neg) OVER (PARTITION BY feature) AS N FROM c)
SELECT feature, s AS threshold, round(cn / N, 6) AS fpr, round(cp / P, 6) AS tpr FROM r""")
def roc_by_feature(spark, sf):
    """ROC points per WoE feature on the out-of-time sample (score = -WoE)."""
    m = _fixed_model(spark, sf)
    w = m.woe_columns(_frame(spark, sf).where(F.col("sample") == "oot"))
    long = w.select("target", *[F.round(-F.col(f"woe__{c}"), 6).alias(c) for c in FIX_WEIGHTS]).unpivot(
        ["target"], list(FIX_WEIGHTS), "feature", "s")
    return T.roc_points(long, "target", "s", by=["feature"])


def _prob_bins_sql(n: int) -> str:
    from scoria.plans.q_metrics import _ew_bin_sql
    return WOE_SQL + f""",
sc AS (SELECT sample, target, 1 / (1 + exp(-({_lin_sql()}))) AS prob FROM frame),
e AS (SELECT min(prob) AS lo, max(prob) AS hi FROM sc WHERE sample = 'train'),
b AS (SELECT sample, target, prob, {_ew_bin_sql('prob', n)} AS bin FROM sc, e)"""


def _prob_bins(spark, sf, n: int):
    m = _fixed_model(spark, sf)
    d = m.transform(_frame(spark, sf))
    edges = T.equal_width_edges(d.where(F.col("sample") == "train"), "prob", n)
    return d.withColumn("bin", T.cut("prob", edges))


@query("describe_score_bins", sql=_prob_bins_sql(20) + """
SELECT sample, bin, count(prob) AS count, round(avg(prob), 6) AS mean, round(stddev_samp(prob), 6) AS std,
       round(min(prob), 6) AS min, round(quantile_cont(prob, 0.25), 6) AS p25, round(quantile_cont(prob, 0.5), 6) AS p50,
       round(quantile_cont(prob, 0.75), 6) AS p75, round(max(prob), 6) AS max
FROM b GROUP BY sample, bin""")
def describe_score_bins(spark, sf):
    """Describe of the probability in 20 equal-width bins (edges from train), per sample.
    Exact percentiles: a scorecard has one distinct probability per bin combination."""
    return T.describe(_prob_bins(spark, sf, 20), "prob", by=["sample", "bin"])


@query("target_by_score_bin", sql=_prob_bins_sql(10) + """
SELECT bin, round(avg(CASE WHEN sample = 'train' THEN target END), 6) AS train,
       round(avg(CASE WHEN sample = 'oot' THEN target END), 6) AS oot
FROM b GROUP BY bin""")
def target_by_score_bin(spark, sf):
    """Mean target per score bin, train and test side by side (pivot with fixed values)."""
    b = _prob_bins(spark, sf, 10)
    return b.groupBy("bin").pivot("sample", ["train", "oot"]).agg(F.avg("target"))


@query("rank_weights", sql=f"""WITH {X.SQL_FRAME},
lf AS ({X.sql_long(X.FEATURES_REAL, [])}),
c AS (SELECT feature, xr AS s, sum(target) AS pos, sum(1 - target) AS neg FROM lf WHERE xr IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY feature ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cn FROM c),
a AS (SELECT feature, round(sum(pos * (cn + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM r GROUP BY feature)
SELECT feature, auc, round(least(greatest((rank() OVER (ORDER BY auc) + (count(*) OVER (PARTITION BY auc) - 1) / 2.0)
                                   / count(*) OVER (), 0.05), 0.95), 6) AS weight FROM a""")
def rank_weights(spark, sf):
    """Average-rank / n weights of features' AUCs, clipped to [0.05, 0.95] (one row per feature)."""
    from scoria.operators.select import rank_weights as rw
    f = _frame(spark, sf)
    long = T.to_long(f, X.FEATURES_REAL, ["target"], value="xr")
    a = T.auc(long, "target", "xr", by=["feature"]).select("feature", F.round("auc", 6).alias("auc"))
    return rw(a, "auc")


@query("csv_roundtrip", sql=f"""WITH {X.SQL_FRAME}
SELECT k, target, sample FROM frame""")
def csv_roundtrip(spark, sf):
    """Write a table twice (replaced, not doubled), export it as CSV with header and
    read that back with an explicit schema (no inference pass)."""
    import uuid

    from scoria.session import checkpoint_dir
    from scoria.sources.io import read_csv, write_csv, write_table
    out = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    d = _frame(spark, sf).select("k", "target", "sample")
    write_table(d, f"{out}-table")
    write_table(d, f"{out}-table")
    write_csv(spark.read.parquet(f"{out}-table"), out)
    return read_csv(spark, out, schema="k string, target int, sample string")



@query("json_dict", sql="""SELECT p_type || '''s' AS code, CAST(count(*) AS VARCHAR) AS name FROM part GROUP BY p_type
UNION ALL SELECT n_name, CAST(n_nationkey AS VARCHAR) FROM nation""")
def json_dict(spark, sf):
    """Part types (with an apostrophe) and nations written as one JSON object and read back as a table."""
    import uuid

    from scoria.session import checkpoint_dir
    from scoria.sources.io import read_json_dict, read_table
    out = f"{checkpoint_dir(spark).rstrip('/')}/json-{uuid.uuid4().hex}"
    part, nation = read_table(spark, "part", sf), read_table(spark, "nation", sf)
    names = part.groupBy(F.concat("p_type", F.lit("'s")).alias("code")).agg(F.count(F.lit(1)).cast("string").alias("name"))
    names = names.unionByName(nation.select(F.col("n_name").alias("code"), F.col("n_nationkey").cast("string").alias("name")))
    one = names.agg(F.map_from_entries(F.collect_list(F.struct("code", "name"))).alias("m"))
    one.select(F.to_json("m").alias("value")).write.text(out)
    return read_json_dict(spark, out)


@query("apply_policy_unseen", sql=f"""WITH {X.SQL_FRAME},
tr AS (SELECT * FROM frame WHERE sample = 'train'),
th AS (SELECT CAST(floor({TH} * count(*)) AS BIGINT) AS t FROM tr),
cc AS (SELECT l_returnflag AS xc, count(*) AS n FROM tr WHERE l_returnflag IS NOT NULL GROUP BY 1),
ss AS (SELECT coalesce(sum(CASE WHEN cc.n < th.t THEN cc.n ELSE 0 END), 0) AS s FROM cc, th),
nn AS (SELECT count(*) - count(l_returnflag) AS m FROM tr),
pol AS (SELECT CASE WHEN nn.m < th.t THEN '__NaN_0__' ELSE '__NaN__' END AS nan_key FROM nn, th),
te AS (SELECT * FROM frame WHERE sample = 'oot')
SELECT CASE WHEN te.l_returnflag IS NULL THEN pol.nan_key
            WHEN cc.n >= th.t THEN te.l_returnflag ELSE pol.nan_key END AS code, count(*) AS n
FROM te CROSS JOIN th CROSS JOIN pol LEFT JOIN cc ON te.l_returnflag = cc.xc
GROUP BY 1""")
def apply_policy_unseen(spark, sf):
    """Policy fitted on train applied to out-of-time rows; small and unseen
    categories sent to the missing code (``unseen="to_nan"`` variant)."""
    f = _frame(spark, sf)
    types = {"l_returnflag": "cat"}
    tr = W.to_long_mixed(f.where(F.col("sample") == "train"), types, ["target"])
    te = W.to_long_mixed(f.where(F.col("sample") == "oot"), types, ["target"])
    n = f.where(F.col("sample") == "train").count()
    pol, cats = W.fit_policy(tr, types, n, TH, TH)
    coded = W.apply_policy(te, pol, cats, unseen="to_nan")
    return coded.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
