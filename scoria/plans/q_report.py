"""Report tables on WoE columns and on the logit, SQL export, wide categories and odd inputs."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from scoria.functions.exprs import nan_to_null, try_date, try_double
from scoria.operators import metrics as T
from scoria.operators import model as M
from scoria.operators import woe as W
from scoria.plans import fixtures as X
from scoria.plans.q_metrics import _ew_bin_sql
from scoria.plans.q_woe import FIX_WEIGHTS, WOE_SQL, _coded, _coded_sql, _fixed_model, _frame, _lin_sql, _woe_case_sql
from scoria.plans.registry import query
from scoria.session import small_side

_WOE = list(FIX_WEIGHTS)


def _woe_frame(spark, sf):
    """sample, target and the WoE columns (rounded to 6 digits, under their features' names)."""
    w = _fixed_model(spark, sf).woe_columns(_frame(spark, sf))
    return w.select("sample", "target", *[F.round(f"woe__{f}", 6).alias(f) for f in _WOE])


_WOE_LONG = WOE_SQL + ",\nlw AS (" + " UNION ALL ".join(
    f"SELECT sample, target, '{f}' AS feature, round({_woe_case_sql(f)}, 6) AS w FROM frame" for f in _WOE) + ")"


@query("psi_woe", sql=_WOE_LONG + """,
p AS (SELECT 'all' AS part, * FROM lw UNION ALL SELECT 'class' || target, * FROM lw),
c AS (SELECT part, feature, w, sum(CASE WHEN sample = 'train' THEN 1 ELSE 0 END) AS a,
             sum(CASE WHEN sample = 'oot' THEN 1 ELSE 0 END) AS b FROM p GROUP BY 1, 2, 3),
s AS (SELECT part, feature, a / sum(a) OVER (PARTITION BY part, feature) AS tr,
             b / sum(b) OVER (PARTITION BY part, feature) AS te FROM c)
SELECT part, feature, round(sum((tr - te) * ln((tr + 0.001) / (te + 0.001))), 6) AS psi FROM s GROUP BY 1, 2""")
def psi_woe(spark, sf):
    """PSI of the WoE columns, train vs out-of-time, total and within each class."""
    w = _woe_frame(spark, sf)
    both = w.withColumn("part", F.explode(F.array(F.lit("all"), F.concat(F.lit("class"), F.col("target").cast("string")))))
    return T.psi(both.where("sample = 'train'"), both.where("sample = 'oot'"), _WOE, by=["part"])


@query("corr_woe", sql=WOE_SQL + ",\nx AS (SELECT " + ", ".join(f"{_woe_case_sql(f)} AS {f}" for f in _WOE)
       + " FROM frame)\n" + "\nUNION ALL ".join(f"SELECT '{a}' AS f1, '{b}' AS f2, round(corr({a}, {b}), 6) AS corr FROM x"
                                               for i, a in enumerate(_WOE) for b in _WOE[i + 1:]))
def corr_woe(spark, sf):
    """Pairwise correlations of the WoE columns."""
    w = _fixed_model(spark, sf).woe_columns(_frame(spark, sf))
    return T.corr_pairs(w.select(*[F.col(f"woe__{f}").alias(f) for f in _WOE]), _WOE)


def _logit_sql(n: int) -> str:
    return WOE_SQL + f""",
sc AS (SELECT sample, target, {_lin_sql()} AS lg FROM frame),
e AS (SELECT min(lg) AS lo, max(lg) AS hi FROM sc WHERE sample = 'train'),
b AS (SELECT sample, target, lg, {_ew_bin_sql('lg', n)} AS bin FROM sc, e)"""


def _logit_bins(spark, sf, n: int):
    """Equal-width bins of the logit, edges from train."""
    m = _fixed_model(spark, sf)
    d = m.attach(_frame(spark, sf)).select("sample", "target", m.linear().alias("lg"))
    edges = T.equal_width_edges(d.where("sample = 'train'"), "lg", n)
    return d.withColumn("bin", T.cut("lg", edges))


@query("score_bins_logit", sql=_logit_sql(10) + """,
p AS (SELECT 'all' AS part, sample, bin FROM b UNION ALL SELECT 'class' || target, sample, bin FROM b),
c AS (SELECT part, sample, bin, count(*) AS n FROM p GROUP BY 1, 2, 3)
SELECT part, sample, bin, n, round(n / sum(n) OVER (PARTITION BY part, sample), 6) AS share FROM c""")
def score_bins_logit(spark, sf):
    """Rows and shares per logit bin, total and per class, train and out-of-time."""
    b = _logit_bins(spark, sf, 10)
    both = b.withColumn("part", F.explode(F.array(F.lit("all"), F.concat(F.lit("class"), F.col("target").cast("string")))))
    return T.shares(both, ["bin"], within=["part", "sample"]).select("part", "sample", "bin", "n", "share")


@query("describe_logit_bins", sql=_logit_sql(20) + """
SELECT sample, bin, count(lg) AS count, round(avg(lg), 6) AS mean, round(stddev_samp(lg), 6) AS std,
       round(min(lg), 6) AS min, round(quantile_cont(lg, 0.25), 6) AS p25, round(quantile_cont(lg, 0.5), 6) AS p50,
       round(quantile_cont(lg, 0.75), 6) AS p75, round(max(lg), 6) AS max FROM b GROUP BY sample, bin""")
def describe_logit_bins(spark, sf):
    """Describe of the logit per bin and sample; exact percentiles (one logit per combination of bins)."""
    return T.describe(_logit_bins(spark, sf, 20), "lg", by=["sample", "bin"], exact=True)


@query("target_by_logit_bin", sql=_logit_sql(10) + """
SELECT bin, round(avg(CASE WHEN sample = 'train' THEN target END), 6) AS train,
       round(avg(CASE WHEN sample = 'oot' THEN target END), 6) AS oot FROM b GROUP BY bin""")
def target_by_logit_bin(spark, sf):
    """Mean target per logit bin, train and out-of-time side by side."""
    return _logit_bins(spark, sf, 10).groupBy("bin").pivot("sample", ["train", "oot"]).agg(F.avg("target"))


@query("backlash_train", sql=WOE_SQL + f""",
sc AS (SELECT *, 1 / (1 + exp(-({_lin_sql()}))) AS prob FROM frame WHERE sample = 'train'),
lw AS (""" + " UNION ALL ".join(f"SELECT target, prob, '{f}' AS feature, round({_woe_case_sql(f)}, 3) AS w FROM sc"
                                 for f in _WOE) + """)
SELECT feature, w AS woe, round(avg(prob), 6) AS mean_pred, round(avg(target), 6) AS mean_target FROM lw GROUP BY 1, 2""")
def backlash_train(spark, sf):
    """Mean prediction and mean target per WoE value, on train."""
    m = _fixed_model(spark, sf)
    d = m.transform(m.woe_columns(_frame(spark, sf).where("sample = 'train'")))
    long = d.select("target", "prob", *[F.round(f"woe__{f}", 3).alias(f) for f in _WOE]).unpivot(
        ["target", "prob"], _WOE, "feature", "woe")
    return long.groupBy("feature", "woe").agg(F.avg("prob").alias("mean_pred"), F.avg("target").alias("mean_target"))


@query("nan_difference", sql=f"""WITH {X.SQL_FRAME},
lf AS ({X.sql_long(X.FEATURES_REAL, X.FEATURES_CAT)}),
s AS (SELECT feature, avg(CASE WHEN xr IS NULL AND xc IS NULL THEN 1 ELSE 0 END) FILTER (WHERE sample = 'train') AS train,
             avg(CASE WHEN xr IS NULL AND xc IS NULL THEN 1 ELSE 0 END) FILTER (WHERE sample = 'oot') AS oot FROM lf GROUP BY 1)
SELECT feature, round(train, 6) AS train, round(oot, 6) AS oot, round(oot - train, 6) AS difference FROM s""")
def nan_difference(spark, sf):
    """Missing shares side by side and their difference."""
    c = T.missing_compare(_frame(spark, sf), X.FEATURES)
    p = c.groupBy("feature").pivot("sample", ["train", "oot"]).agg(F.first("share_missing"))
    return p.withColumn("difference", F.col("oot") - F.col("train"))


# ------------------------------------------------------------------ scoring forms

@query("sql_export", sql=WOE_SQL + f"""
SELECT k, round(1 / (1 + exp(-({_lin_sql()}))), 6) AS prob FROM frame""")
def sql_export(spark, sf):
    """M7: the exported SQL text, run by Spark, gives the model's probabilities."""
    m, name = _fixed_model(spark, sf), f"sql_export_{uuid.uuid4().hex}"
    _frame(spark, sf).createOrReplaceTempView(name)
    return spark.sql(m.to_sql(name, keep=["k"], digits=15))


# fixed values of the wide category: clients c0 .. c899 are learnt, c900 .. c996 are not; every 50th is missing
_WIDE = {"n": 997, "seen": 900, "woe": {0: 0.5, 1: -0.25, 2: 0.1}, "nan_bin": 1, "small_bin": 2}
_WIDE_WOE = ("CASE WHEN client IS NULL OR client = 'nan' THEN -0.25 WHEN CAST(substr(client, 2) AS INTEGER) >= 900 THEN 0.1 "
             "ELSE CASE CAST(substr(client, 2) AS INTEGER) % 3 WHEN 0 THEN 0.5 WHEN 1 THEN -0.25 ELSE 0.1 END END")


@query("score_high_card", sql=f"""WITH {X.SQL_FRAME},
c AS (SELECT k, CASE WHEN grp % 50 = 0 THEN NULL WHEN grp % 50 = 1 THEN 'nan' ELSE 'c' || (grp % 997) END AS client FROM frame),
p AS (SELECT k, round(1 / (1 + exp(-(-0.5 + -1.0 * ({_WIDE_WOE})))), 6) AS prob FROM c)
SELECT form, k, prob FROM p, (VALUES ('literal'), ('table'), ('sql_literal'), ('sql_table')) AS f(form)""")
def score_high_card(spark, sf):
    """Map-literal and table-backed categories, and the SQL of both, agree on learnt, missing,
    'nan' and unseen codes (the special codes' WoE comes from the bins they were put in)."""
    f = _frame(spark, sf).select("k", F.when(F.col("grp") % 50 == 0, None).when(F.col("grp") % 50 == 1, "nan").otherwise(
        F.concat(F.lit("c"), (F.col("grp") % _WIDE["n"]).cast("string"))).alias("client"))
    special = {W.NAN_KEY: _WIDE["nan_bin"], W.SMALL_KEY: _WIDE["small_bin"]}
    learnt = {f"c{i}": i % 3 for i in range(_WIDE["seen"])}
    table = spark.createDataFrame(sorted({**learnt, **special}.items()), "code string, bin int")
    bins = lambda cats, t: M.ScorecardModel({"client": M.FeatureBins(
        "client", "cat", [], cats, dict(_WIDE["woe"]), W.NAN_KEY, W.SMALL_KEY, cat_table=t)}, {"client": -1.0}, -0.5)
    literal, backed = bins({**learnt, **special}, None), bins(special, table)
    rows, more, codes = (f"{n}_{uuid.uuid4().hex}" for n in ("wide", "more", "codes"))
    small_side(table).createOrReplaceTempView(codes)
    # one pass: each form adds its probabilities to the rows of the form before ("code": the SQL's "client" is its WoE)
    d = backed.transform(literal.transform(f, "literal"), "table")
    d.withColumn("code", F.col("client")).createOrReplaceTempView(rows)
    d = spark.sql(literal.to_sql(rows, keep=["k", "code", "literal", "table"]))
    d = d.withColumnsRenamed({"code": "client", "prob": "sql_literal"})
    d.createOrReplaceTempView(more)
    d = spark.sql(backed.to_sql(more, keep=["k", "literal", "table", "sql_literal"], maps={"client": codes}))
    return d.withColumnRenamed("prob", "sql_table").unpivot(
        "k", ["literal", "table", "sql_literal", "sql_table"], "form", "prob").select("form", "k", "prob")


# ------------------------------------------------------------------ odd inputs

@query("missing_inputs", sql=f"""WITH {X.SQL_FRAME}
SELECT k, CASE WHEN grp % 7 IN (0, 1, 2) THEN NULL ELSE l_extendedprice END AS num,
       CASE WHEN grp % 5 IN (0, 1) THEN NULL ELSE l_linestatus END AS cat,
       CASE WHEN grp % 11 = 0 THEN NULL ELSE CAST(ship_dt AS VARCHAR) END AS dt FROM frame""")
def missing_inputs(spark, sf):
    """Numbers and dates as text, with 'nan', no numbers, bad dates and nulls planted."""
    g = F.col("grp")
    f = _frame(spark, sf).select(
        "k", F.when(g % 7 == 0, "nan").when(g % 7 == 1, "abc").when(g % 7 == 2, None)
        .otherwise(F.col("l_extendedprice").cast("string")).alias("num"),
        F.when(g % 5 == 0, "NaN").when(g % 5 == 1, None).otherwise(F.col("l_linestatus")).alias("cat"),
        F.when(g % 11 == 0, "31.02.2001x").otherwise(F.date_format("ship_dt", "dd.MM.yyyy")).alias("dt"))
    return f.select("k", try_double("num").alias("num"), nan_to_null("cat").alias("cat"),
                    try_date("dt", "%d.%m.%Y").cast("date").cast("string").alias("dt"))


@query("infer_types_codes", sql="""SELECT * FROM (VALUES ('zip', 'cat'), ('day', 'date'), ('part', 'real')) AS t(feature, ftype)""")
def infer_types_codes(spark, sf):
    """Five-digit codes as text are categories, not dates of far years."""
    (o,) = X.tables(spark, sf, "orders")
    f = o.select((F.col("o_custkey") % 80000 + 10000).cast("string").alias("zip"), F.to_date("o_orderdate").cast("string").alias("day"),
                 F.col("o_totalprice").alias("part"), F.lit(1).alias("target"))
    t = W.infer_types(f, "target")
    return spark.createDataFrame([(c, "date" if isinstance(v, tuple) else v) for c, v in t.items()], "feature string, ftype string")


@query("pivot_null_client", sql="""
WITH t AS (SELECT CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS client, o_orderstatus AS c, o_totalprice AS v FROM orders)
SELECT client, """ + ", ".join(f"round(coalesce({a}(CASE WHEN c = '{c}' THEN v END), 0) / 100.0, 6) AS {c}_{a}_amt"
                               for c in "FO" for a in ("sum", "max", "min")) + """
FROM t GROUP BY client""")
def pivot_null_client(spark, sf):
    """Zeros fill the features, a null client stays null."""
    from scoria.operators.mart import pivot_features
    (o,) = X.tables(spark, sf, "orders")
    t = o.select(F.when(F.col("o_custkey") % 10 == 0, None).otherwise(F.col("o_custkey")).alias("client"),
                 F.col("o_orderstatus").alias("column_name"), F.col("o_totalprice").alias("v"))
    agg = t.groupBy("client", "column_name").agg(F.sum("v").alias("sum_amt"), F.max("v").alias("max_amt"), F.min("v").alias("min_amt"))
    return pivot_features(agg, ["client"], ["F", "O"])


@query("oof_mean_target_plain", sql=_coded_sql(True) + """,
per AS (SELECT feature, code, fold, count(*) AS n_f, sum(target) AS s_f FROM coded
        WHERE code IS NOT NULL AND spec IS NULL AND feature IN ('l_returnflag', 'l_linestatus') GROUP BY 1, 2, 3),
tot AS (SELECT feature, code, sum(n_f) AS n_c, sum(s_f) AS s_c FROM per GROUP BY 1, 2)
SELECT per.feature, per.code, per.fold, round(CASE WHEN tot.n_c > per.n_f THEN (tot.s_c - per.s_f) / (tot.n_c - per.n_f) END, 6) AS enc
FROM per JOIN tot USING (feature, code)""")
def oof_mean_target_plain(spark, sf):
    """Out-of-fold mean target without smoothing (alpha = 0)."""
    coded, _, _ = _coded(spark, sf, with_folds=True)
    return W.mean_target_oof(coded.where(F.col("feature").isin(X.FEATURES_CAT)), alpha=0.0).select("feature", "code", "fold", "enc")


@query("profile_left", sql="""
WITH f AS (SELECT o_custkey AS client_id, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2),
p AS (SELECT c_custkey AS client_id, c_mktsegment AS segment FROM customer WHERE c_acctbal >= 0)
SELECT f.client_id, f.day, f.n, p.segment FROM f LEFT JOIN p ON f.client_id = p.client_id""")
def profile_left(spark, sf):
    """A client profile attached by a left join, its bookkeeping columns dropped; clients without one stay."""
    from scoria.operators.labels import attach_profile
    o, c = X.tables(spark, sf, "orders", "customer")
    f = o.groupBy(F.col("o_custkey").alias("client_id"), F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    p = c.where("c_acctbal >= 0").select(F.col("c_custkey").alias("client_id"), F.col("c_mktsegment").alias("segment"),
                                         F.lit("x").alias("ctl_loading"), F.current_date().alias("report_dt"))
    return attach_profile(f, p, ["client_id"], how="left")


def _card_sql() -> str:
    """Scorecard rows of the fixed model: labels from the fixed splits, WoE from the `woe` table."""
    from scoria.functions.exprs import interval_label
    from scoria.plans.q_woe import FIX_INTERCEPT, FIX_SPLITS, TYPES
    parts = []
    for f, w in FIX_WEIGHTS.items():
        if TYPES[f] == "real":
            ends = [None, *FIX_SPLITS[f], None]
            for i, (lo, hi) in enumerate(zip(ends, ends[1:])):
                parts.append(f"SELECT '{f}' AS variable, '{interval_label(lo, hi, f)}' AS value, coalesce((SELECT max(woe) FROM woe "
                             f"WHERE feature = '{f}' AND bin = {i}), 0.0) AS woe, {w} AS coef")
        else:
            parts.append(f"SELECT '{f}', spec, woe, {w} FROM woe WHERE feature = '{f}' AND NOT starts_with(spec, '__')")
            parts.append(f"SELECT '{f}', small_key, 0.0, {w} FROM pol WHERE feature = '{f}' AND small_key = '__Small_0__'")
            parts.append(f"SELECT '{f}', spec, woe, {w} FROM woe WHERE feature = '{f}' AND spec = '__Small__'")
        parts.append(f"SELECT '{f}', nan_key, 0.0, {w} FROM pol WHERE feature = '{f}' AND nan_key = '__NaN_0__'")
        parts.append(f"SELECT '{f}', spec, woe, {w} FROM woe WHERE feature = '{f}' AND spec = '__NaN__'")
    return WOE_SQL + ",\npts AS (" + "\nUNION ALL ".join(parts) + f""")
SELECT variable, value, round(woe, 6) + 0.0 AS woe, round(coef, 6) AS coef, round(woe * coef, 6) + 0.0 AS points FROM pts
UNION ALL SELECT 'Intercept', '', NULL, {FIX_INTERCEPT}, {FIX_INTERCEPT}"""


@query("scorecard_rows", sql=_card_sql())
def scorecard_rows(spark, sf):
    """The model's own scorecard, labels with the feature's name."""
    t = _fixed_model(spark, sf).scorecard()
    rows = [(r.variable, r.value, None if r.woe is None or r.woe != r.woe else float(r.woe), float(r.coef), float(r.points))
            for r in t.itertuples()]
    return spark.createDataFrame(rows, "variable string, value string, woe double, coef double, points double")


@query("scorecard_joined", sql="""
WITH b AS (SELECT n_regionkey AS bin, string_agg(n_name, ', ' ORDER BY n_name) AS value FROM nation GROUP BY 1),
c AS (SELECT n_regionkey AS bin, sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS bad, sum(CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 END) AS good
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
w AS (SELECT bin, ln(((bad + 0.5) / (sum(bad) OVER () + 0.5)) / ((good + 0.5) / (sum(good) OVER () + 0.5))) AS woe FROM c)
SELECT 'nation' AS variable, value, round(woe, 6) AS woe, -0.8 AS coef, round(-0.8 * woe, 6) AS points FROM w JOIN b USING (bin)
UNION ALL SELECT 'Intercept', '', NULL, 0.25, 0.25""")
def scorecard_joined(spark, sf):
    """Categories of one bin stand joined, in order, in one scorecard row (nations in bins by region)."""
    c, n = X.tables(spark, sf, "customer", "nation")
    per = c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_regionkey").agg(
        F.sum((F.col("c_acctbal") < 0).cast("int")).alias("bad"), F.sum((F.col("c_acctbal") >= 0).cast("int")).alias("good")).collect()
    bad, good = sum(r.bad for r in per), sum(r.good for r in per)
    woe = {r.n_regionkey: math.log(((r.bad + 0.5) / (bad + 0.5)) / ((r.good + 0.5) / (good + 0.5))) for r in per}
    bins = {r.n_name: r.n_regionkey for r in n.collect() if r.n_regionkey in woe}
    t = M.ScorecardModel({"nation": M.FeatureBins("nation", "cat", [], bins, woe, W.NAN_KEY, W.SMALL_KEY)}, {"nation": -0.8}, 0.25).scorecard()
    rows = [(r.variable, r.value, None if r.woe is None or r.woe != r.woe else float(r.woe), float(r.coef), float(r.points))
            for r in t.itertuples()]
    return spark.createDataFrame(rows, "variable string, value string, woe double, coef double, points double")
