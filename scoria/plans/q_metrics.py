"""Queries for build step 3: the metric kernel (AUC/Gini, ROC, PSI, correlation, describe)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoria.functions.exprs import logit
from scoria.operators import metrics as T
from scoria.plans import fixtures as X
from scoria.plans.registry import query

# Linear stand-in score on the planted frame (missing features count as 0).
SCORE_SQL = "(0.06 * coalesce(l_quantity, 0) + 10.0 * coalesce(l_discount, 0))"


def _score(f):
    s = F.lit(0.06) * F.coalesce("l_quantity", F.lit(0.0)) + F.lit(10.0) * F.coalesce("l_discount", F.lit(0.0))
    return f.withColumn("score", s)


def _auc_sql(src: str, by: str, score: str = "score", label: str = "target") -> str:
    """AUC with ties counted half, grouped by ``by`` (empty string = global)."""
    part = f"PARTITION BY {by}" if by else ""
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""c AS (SELECT {sel}{score} AS s, sum({label}) AS pos, sum(1 - {label}) AS neg
      FROM {src} WHERE {score} IS NOT NULL AND NOT isnan({score}) GROUP BY {sel}{score}),
r AS (SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cn FROM c),
a AS (SELECT {sel}sum(pos * (cn + neg / 2.0)) AS num, sum(pos) AS p, sum(neg) AS n FROM r {grp})
"""


_AUC_SELECT = """CASE WHEN p > 0 AND n > 0 THEN round(num / (p * n), 6) END AS auc,
       CASE WHEN p > 0 AND n > 0 THEN round(2 * num / (p * n) - 1, 6) END AS gini,
       CAST(p AS BIGINT) AS n_pos, CAST(n AS BIGINT) AS n_neg"""


@query("auc_by_feature", sql=f"""WITH {X.SQL_FRAME},
lf AS ({X.sql_long(X.FEATURES_REAL, [])}),
{_auc_sql('lf', 'feature', 'xr')}
SELECT feature, {_AUC_SELECT} FROM a""")
def auc_by_feature(spark, sf):
    """AUC of every real feature against the target in one job (long form)."""
    f = X.scorecard_frame(spark, sf)
    long = T.to_long(f, X.FEATURES_REAL, ["target"], value="xr")
    return T.auc(long, "target", "xr", by=["feature"])


@query("gini", sql=f"""WITH {X.SQL_FRAME},
sc AS (SELECT sample, target, {SCORE_SQL} AS score FROM frame),
{_auc_sql('sc', 'sample')}
SELECT sample, round(100 * num / (p * n), 2) AS auc100, round(100 * (2 * num / (p * n) - 1), 2) AS gini100 FROM a""")
def gini(spark, sf):
    """AUC and Gini (x100, 2 decimals) of a score per sample."""
    a = T.auc(_score(X.scorecard_frame(spark, sf)), "target", "score", by=["sample"])
    return a.select("sample", F.round(100 * F.col("auc"), 2).alias("auc100"),
                    F.round(100 * F.col("gini"), 2).alias("gini100"))


@query("roc_points", sql=f"""WITH {X.SQL_FRAME},
c AS (SELECT sample, {SCORE_SQL} AS s, sum(target) AS pos, sum(1 - target) AS neg FROM frame GROUP BY 1, 2),
r AS (SELECT sample, s, sum(pos) OVER (PARTITION BY sample ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cp,
             sum(neg) OVER (PARTITION BY sample ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cn,
             sum(pos) OVER (PARTITION BY sample) AS P, sum(neg) OVER (PARTITION BY sample) AS N FROM c)
SELECT sample, round(s, 6) AS threshold, round(cn / N, 6) AS fpr, round(cp / P, 6) AS tpr FROM r""")
def roc_points(spark, sf):
    """ROC points (one per distinct score) per sample."""
    return T.roc_points(_score(X.scorecard_frame(spark, sf)), "target", "score", by=["sample"])


_PAIRS = [(a, b) for i, a in enumerate(X.FEATURES_REAL) for b in X.FEATURES_REAL[i + 1:]]


@query("corr_pairs", sql=f"""WITH {X.SQL_FRAME}
""" + "\nUNION ALL ".join(f"SELECT '{a}' AS f1, '{b}' AS f2, round(corr({a}, {b}), 6) AS corr FROM frame"
                          for a, b in _PAIRS))
def corr_pairs(spark, sf):
    """Pairwise Pearson correlations (upper triangle)."""
    return T.corr_pairs(X.scorecard_frame(spark, sf), X.FEATURES_REAL)


@query("describe_sample", sql=f"""WITH {X.SQL_FRAME}
SELECT sample, count(l_quantity) AS count, round(avg(l_quantity), 6) AS mean,
       round(stddev_samp(l_quantity), 6) AS std, round(min(l_quantity), 6) AS min,
       round(quantile_cont(l_quantity, 0.25), 6) AS p25, round(quantile_cont(l_quantity, 0.5), 6) AS p50,
       round(quantile_cont(l_quantity, 0.75), 6) AS p75, round(max(l_quantity), 6) AS max
FROM frame GROUP BY sample""")
def describe_sample(spark, sf):
    """Describe (count, mean, std, min, quartiles, max) per group, exact percentiles."""
    return T.describe(X.scorecard_frame(spark, sf), "l_quantity", by=["sample"])


@query("describe_price", sql=f"""WITH {X.SQL_FRAME}
SELECT CASE WHEN l_returnflag IN ('A', 'N', 'R') THEN l_returnflag END AS flag, count(l_extendedprice) AS count,
       round(avg(l_extendedprice), 6) AS mean, round(stddev_samp(l_extendedprice), 6) AS std, round(min(l_extendedprice), 6) AS min,
       round(quantile_cont(l_extendedprice, 0.25), 6) AS p25, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
       round(quantile_cont(l_extendedprice, 0.75), 6) AS p75, round(max(l_extendedprice), 6) AS max
FROM frame GROUP BY 1""")
def describe_price(spark, sf):
    """Exact percentiles of a continuous column, null group included."""
    f = X.scorecard_frame(spark, sf).withColumn("flag", F.when(F.col("l_returnflag").isin("A", "N", "R"), F.col("l_returnflag")))
    return T.describe(f, "l_extendedprice", by=["flag"])


@query("auc_null_group", sql=f"""WITH {X.SQL_FRAME},
c AS (SELECT CASE WHEN l_returnflag IN ('A', 'N', 'R') THEN l_returnflag END AS flag, l_extendedprice AS s,
             sum(target) AS pos, sum(1 - target) AS neg FROM frame GROUP BY 1, 2),
r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY flag ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cn FROM c)
SELECT flag, round(sum(pos * (cn + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc, sum(pos)::BIGINT AS n_pos FROM r GROUP BY flag""")
def auc_null_group(spark, sf):
    """AUC by a column with nulls; null is a group like any other."""
    f = X.scorecard_frame(spark, sf).withColumn("flag", F.when(F.col("l_returnflag").isin("A", "N", "R"), F.col("l_returnflag")))
    return T.auc(f, "target", "l_extendedprice", by=["flag"]).select("flag", "auc", "n_pos")


N_BINS = 20


def _ew_bin_sql(x: str, n: int) -> str:
    """Right-closed equal-width bin of x with edges lo + i*step (columns lo, hi)."""
    inner = " + ".join(f"CASE WHEN {x} > lo + {i} * ((hi - lo) / {n}) THEN 1 ELSE 0 END" for i in range(1, n))
    return f"CASE WHEN {x} > lo - (hi - lo) * 0.001 AND {x} <= hi THEN CAST({inner} AS INTEGER) END"


@query("equal_width_bins", sql=f"""WITH {X.SQL_FRAME},
sc AS (SELECT sample, target, {SCORE_SQL} AS s FROM frame),
e AS (SELECT min(s) AS lo, max(s) AS hi FROM sc WHERE sample = 'train'),
b AS (SELECT sample, target, s, {_ew_bin_sql('s', N_BINS)} AS bin FROM sc, e)
SELECT sample, bin, count(*) AS n, round(avg(target), 6) AS rate FROM b GROUP BY sample, bin""")
def equal_width_bins(spark, sf):
    """Equal-width score bins learnt on train, applied to both samples."""
    f = _score(X.scorecard_frame(spark, sf))
    edges = T.equal_width_edges(f.where(F.col("sample") == "train"), "score", N_BINS)
    return (f.withColumn("bin", T.cut("score", edges)).groupBy("sample", "bin")
             .agg(F.count(F.lit(1)).alias("n"), F.avg("target").alias("rate")))


@query("psi_feature", sql=f"""WITH {X.SQL_FRAME},
lf AS ({X.sql_long(X.FEATURES_REAL, X.FEATURES_CAT)}),
v AS (SELECT sample, feature, coalesce(CAST(xr AS VARCHAR), xc) AS value FROM lf),
c AS (SELECT feature, value, sum(CASE WHEN sample = 'train' THEN 1 ELSE 0 END) AS n_tr,
             sum(CASE WHEN sample = 'oot' THEN 1 ELSE 0 END) AS n_te FROM v GROUP BY feature, value),
s AS (SELECT feature, n_tr / sum(n_tr) OVER (PARTITION BY feature) AS tr,
             n_te / sum(n_te) OVER (PARTITION BY feature) AS te FROM c)
SELECT feature, round(sum((tr - te) * ln((tr + 0.001) / (te + 0.001))), 6) AS psi FROM s GROUP BY feature""")
def psi_feature(spark, sf):
    """PSI of every feature, train vs out-of-time (missing = own value)."""
    f = X.scorecard_frame(spark, sf)
    return T.psi(f.where(F.col("sample") == "train"), f.where(F.col("sample") == "oot"), X.FEATURES)


@query("psi_by_class", sql=f"""WITH {X.SQL_FRAME},
lf AS ({X.sql_long(X.FEATURES_REAL, X.FEATURES_CAT)}),
v AS (SELECT target, sample, feature, coalesce(CAST(xr AS VARCHAR), xc) AS value FROM lf),
c AS (SELECT target, feature, value, sum(CASE WHEN sample = 'train' THEN 1 ELSE 0 END) AS n_tr,
             sum(CASE WHEN sample = 'oot' THEN 1 ELSE 0 END) AS n_te FROM v GROUP BY 1, 2, 3),
s AS (SELECT target, feature, n_tr / sum(n_tr) OVER (PARTITION BY target, feature) AS tr,
             n_te / sum(n_te) OVER (PARTITION BY target, feature) AS te FROM c)
SELECT target, feature, round(sum((tr - te) * ln((tr + 0.001) / (te + 0.001))), 6) AS psi FROM s GROUP BY 1, 2""")
def psi_by_class(spark, sf):
    """PSI within target = 0 and target = 1."""
    f = X.scorecard_frame(spark, sf)
    return T.psi(f.where(F.col("sample") == "train"), f.where(F.col("sample") == "oot"), X.FEATURES,
                 by=["target"])


@query("psi_score", sql=f"""WITH {X.SQL_FRAME},
sc AS (SELECT sample, target, ln(p / (1 - p)) AS lg FROM (
        SELECT sample, target, 1 / (1 + exp(-({SCORE_SQL} - 3.0))) AS p FROM frame)),
e AS (SELECT min(lg) AS lo, max(lg) AS hi FROM sc WHERE sample = 'train'),
b AS (SELECT sample, target, CAST({_ew_bin_sql('lg', 10)} AS VARCHAR) AS bin FROM sc, e),
grp AS (SELECT 'all' AS part, sample, bin FROM b UNION ALL
        SELECT 'class' || CAST(target AS VARCHAR), sample, bin FROM b),
c AS (SELECT part, bin, sum(CASE WHEN sample = 'train' THEN 1 ELSE 0 END) AS n_tr,
             sum(CASE WHEN sample = 'oot' THEN 1 ELSE 0 END) AS n_te FROM grp GROUP BY 1, 2),
s AS (SELECT part, n_tr / sum(n_tr) OVER (PARTITION BY part) AS tr, n_te / sum(n_te) OVER (PARTITION BY part) AS te FROM c)
SELECT part, round(sum((tr - te) * ln((tr + 0.001) / (te + 0.001))), 6) AS psi FROM s GROUP BY part""")
def psi_score(spark, sf):
    """PSI of a probability in 10 equal-width logit bins — total and per class."""
    f = X.scorecard_frame(spark, sf)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(0.06) * F.coalesce("l_quantity", F.lit(0.0))
                                          + F.lit(10.0) * F.coalesce("l_discount", F.lit(0.0)) - F.lit(3.0))))
    f = f.withColumn("lg", logit(p))
    edges = T.equal_width_edges(f.where(F.col("sample") == "train"), "lg", 10)
    f = f.withColumn("bin", T.cut("lg", edges))
    both = (f.select(F.lit("all").alias("part"), "sample", "bin")
            .unionByName(f.select(F.concat(F.lit("class"), F.col("target").cast("string")).alias("part"),
                                  "sample", "bin")))
    r = T.psi(both.where(F.col("sample") == "train"), both.where(F.col("sample") == "oot"), ["bin"], by=["part"])
    return r.select("part", "psi")


@query("nan_compare", sql=f"""WITH {X.SQL_FRAME},
lf AS ({X.sql_long(X.FEATURES_REAL, X.FEATURES_CAT)})
SELECT feature, sample, CAST(sum(CASE WHEN xr IS NULL AND xc IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing,
       CAST(sum(CASE WHEN xr IS NULL AND xc IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS n_present,
       round(avg(CASE WHEN xr IS NULL AND xc IS NULL THEN 1 ELSE 0 END), 6) AS share_missing
FROM lf GROUP BY feature, sample""")
def nan_compare(spark, sf):
    """Missing vs present per feature and sample."""
    return T.missing_compare(X.scorecard_frame(spark, sf), X.FEATURES)


@query("sample_summary", sql=f"""WITH {X.SQL_FRAME}
SELECT sample, count(*) AS n, CAST(sum(target) AS BIGINT) AS n_pos, CAST(sum(1 - target) AS BIGINT) AS n_neg,
       round(avg(target) * 100, 6) AS pos_pct FROM frame GROUP BY sample""")
def sample_summary(spark, sf):
    """Count, positives, negatives and positive share per sample."""
    return T.sample_summary(X.scorecard_frame(spark, sf), "target")


@query("score_shares", sql=f"""WITH {X.SQL_FRAME},
c AS (SELECT target, l_returnflag, count(*) AS n FROM frame GROUP BY 1, 2)
SELECT target, l_returnflag, n, round(n / sum(n) OVER (PARTITION BY target), 6) AS share FROM c""")
def score_shares(spark, sf):
    """Count per category and its share within each class."""
    return T.shares(X.scorecard_frame(spark, sf), ["l_returnflag"], within=["target"])
