"""Rank and distribution statistics.

All of them are aggregates over long-form rows grouped by whatever the
caller groups by (feature, sample, class, replicate ...), so one job
serves all features.  AUC and ROC reduce rows to distinct scores first and
then use distributed running sums (``ranking.running_sums``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoria.functions.exprs import bin_index
from scoria.operators.ranking import join_null_safe, running_sums
from scoria.session import cut_lineage

__all__ = ["score_counts", "auc", "roc_points", "psi", "corr_matrix", "corr_pairs",
           "vif", "quantiles", "describe", "equal_width_edges", "cut", "missing_compare",
           "sample_summary", "shares", "wilson", "to_long"]


def to_long(df: DataFrame, features: Sequence[str], keep: Sequence[str], value: str = "value",
            cast: str = "double") -> DataFrame:
    """Unpivot ``features`` into ``(keep..., feature, value)`` rows (one stack)."""
    return df.unpivot(list(keep), list(features), "feature", value) if cast is None else \
        df.select(*keep, *[F.col(f).cast(cast).alias(f) for f in features]).unpivot(
            list(keep), list(features), "feature", value)


def score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows -> (by..., score, pos, neg); nulls in score are dropped (like ``dropna``)."""
    y = F.col(label).cast("int")
    return (df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score)))
              .groupBy(*by, score)
              .agg(F.sum(y).cast("bigint").alias("pos"), F.sum(1 - y).cast("bigint").alias("neg")))


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), counts: bool = False,
        slices: int | None = None) -> DataFrame:
    """ROC AUC per group with ties counted half (Mann-Whitney form).

    ``AUC = sum_s pos(s) * (neg(< s) + neg(s)/2) / (P * N)``.  Also returns
    ``gini = 2*AUC - 1``.  Groups with a single class get NULL.
    ``counts=True`` means ``df`` already is (by..., score, pos, neg).
    """
    by = list(by)
    c = df if counts else score_counts(df, label, score, by)
    r = running_sums(c, by, [score], ["neg"], slices=slices)
    a = r.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") + F.col("neg") / 2.0)).alias("_num"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    v = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
               F.col("_num") / (F.col("n_pos").cast("double") * F.col("n_neg")))
    return a.select(*by, v.alias("auc"), (2 * v - 1).alias("gini"),
                    F.col("n_pos").cast("bigint").alias("n_pos"), F.col("n_neg").cast("bigint").alias("n_neg"))


def roc_points(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
               slices: int | None = None) -> DataFrame:
    """One ROC point per distinct score (threshold), highest score first:
    ``fpr = neg(>= t)/N``, ``tpr = pos(>= t)/P``."""
    by = list(by)
    c = score_counts(df, label, score, by).withColumn("_desc", -F.col(score))
    r = running_sums(c, by, ["_desc"], ["pos", "neg"], inclusive=True, slices=slices)
    if by:
        # one row per group; AQE broadcasts it when its measured size is small
        tot = c.groupBy(*by).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
        r = join_null_safe(r, tot, by)
    else:
        t = c.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
        r = r.withColumn("_P", F.lit(t["P"])).withColumn("_N", F.lit(t["N"]))
    return r.select(*by, F.col(score).alias("threshold"),
                    (F.col("cum_neg") / F.col("_N")).alias("fpr"),
                    (F.col("cum_pos") / F.col("_P")).alias("tpr"))


def psi(train: DataFrame, test: DataFrame, features: Sequence[str], by: Sequence[str] = (),
        eps: float = 1e-3, value_cast: str = "string") -> DataFrame:
    """Population stability per feature: shares by distinct value, train vs test,
    ``sum (tr - te) * ln((tr + eps)/(te + eps))``.  Missing is its own value."""
    keep = list(by)
    u = (train.select(*keep, *features).withColumn("_s", F.lit(1))
         .unionByName(test.select(*keep, *features).withColumn("_s", F.lit(0))))
    # group on typed values (numbers as doubles, the rest as strings): the same
    # groups as a string cast, without formatting every number
    dtypes = dict(u.dtypes)
    num = [f for f in features if dtypes[f] in ("double", "float", "int", "bigint", "smallint", "tinyint")
           or dtypes[f].startswith("decimal")] if value_cast == "string" else []
    oth = [f for f in features if f not in num]
    parts = []
    if num:
        parts.append(u.select(*keep, "_s", *[F.col(f).cast("double").alias(f) for f in num])
                      .unpivot(keep + ["_s"], num, "feature", "vr").withColumn("vc", F.lit(None).cast("string")))
    if oth:
        parts.append(u.select(*keep, "_s", *[F.col(f).cast(value_cast).alias(f) for f in oth])
                      .unpivot(keep + ["_s"], oth, "feature", "vc").withColumn("vr", F.lit(None).cast("double"))
                      .select(*keep, "_s", "feature", "vr", "vc"))
    long = parts[0]
    for q in parts[1:]:
        long = long.unionByName(q)
    cnt = long.groupBy(*keep, "feature", "vr", "vc").agg(
        F.sum("_s").alias("n_tr"), F.sum(1 - F.col("_s")).alias("n_te"))
    # per-(by, feature) totals joined back (AQE broadcasts them at run time
    # when small); a window per feature would put all distinct values of a
    # feature in one task.
    tot = cnt.groupBy(*keep, "feature").agg(F.sum("n_tr").alias("_ttr"), F.sum("n_te").alias("_tte"))
    sh = join_null_safe(cnt, tot, keep + ["feature"]).select(
        *keep, "feature", (F.col("n_tr") / F.col("_ttr")).alias("tr"), (F.col("n_te") / F.col("_tte")).alias("te"))
    sh = sh.fillna(0.0, ["tr", "te"])
    term = (F.col("tr") - F.col("te")) * F.log((F.col("tr") + eps) / (F.col("te") + eps))
    return sh.groupBy(*keep, "feature").agg(F.sum(term).alias("psi"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """k x k Pearson correlation of the rows without missing values (one centred Gram matrix, MLlib).

    Only the k x k matrix reaches the driver.  Off the diagonal, zero-variance columns give NaN.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    cols = list(cols)
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    v = VectorAssembler(inputCols=cols, outputCol="__v").transform(d).select("__v")
    c = Correlation.corr(v, "__v").first()[0].toArray()
    return c


#: Columns up to which the pairs are expressions of one aggregate; beyond, sums travel by blocks of this many columns.
CORR_BLOCK = 64


def corr_pairs(df: DataFrame, cols: Sequence[str], absolute: bool = False, min_abs: float | None = None,
               block: int = CORR_BLOCK) -> DataFrame:
    """Upper-triangle pair table (f1, f2, corr); each pair over the rows that have both.

    The correlation is null where a pair has no spread.  ``min_abs`` keeps the pairs of at least
    that absolute correlation.  More than ``block`` columns are summed by pairs of column blocks,
    so neither a plan nor the driver holds all pairs; a NaN or infinite value there makes all
    pairs of its column null.
    """
    cols = list(cols)
    if len(cols) < 2:
        out = df.sparkSession.createDataFrame([], "f1 string, f2 string, corr double")
    elif len(cols) <= block:
        pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
        # one short expression a pair and one aggregate; the pairs are exploded from the single row
        one = df.agg(F.array(*[F.struct(F.lit(a).alias("f1"), F.lit(b).alias("f2"), _corr(a, b).alias("corr"))
                               for a, b in pairs]).alias("p"))
        out = one.select(F.explode("p").alias("p")).select("p.*")
    else:
        out = _corr_blocks(df, cols, block)
    if min_abs is not None:
        out = out.where(F.abs("corr") >= min_abs)
    return out.withColumn("corr", F.abs("corr")) if absolute else out


def _corr(a: str, b: str) -> Column:
    """Correlation as an aggregate; null without spread, where ``corr`` would divide by zero in ANSI mode."""
    x, y = (F.col("`" + c.replace("`", "``") + "`").cast("double") for c in (a, b))
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y)))


def _corr_blocks(df: DataFrame, cols: list[str], block: int) -> DataFrame:
    """Pair correlations from sums that each task adds up per pair of column blocks.

    Values are shifted by their column's middle, which leaves correlations as they are and the
    sums small.  A task sends the sums of its rows once: n, x, y, xx, yy and xy of every pair.
    """
    quoted = [F.col("`" + c.replace("`", "``") + "`").cast("double") for c in cols]
    ends = df.agg(F.array(*[F.min(c) for c in quoted]).alias("lo"), F.array(*[F.max(c) for c in quoted]).alias("hi")).first()
    shift = np.array([0.0 if a is None or not np.isfinite(a + b) else a if a == b else a / 2 + b / 2 for a, b in zip(*ends)])
    cuts = [(a, min(a + block, len(cols))) for a in range(0, len(cols), block)]
    spans = [(i, j) for i in range(len(cuts)) for j in range(i, len(cuts))]
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("sums", pa.binary())])

    def add(batches):
        total: dict = {}
        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - shift
            there = ~np.column_stack([c.is_null().to_numpy(zero_copy_only=False) for c in batch.columns])
            x, m = np.where(there, rows, 0.0), there.astype(np.float64)
            xx = x * x
            for i, j in spans:
                a, b = slice(*cuts[i]), slice(*cuts[j])
                got = np.stack([m[:, a].T @ m[:, b], x[:, a].T @ m[:, b], m[:, a].T @ x[:, b],
                                xx[:, a].T @ m[:, b], m[:, a].T @ xx[:, b], x[:, a].T @ x[:, b]])
                if (i, j) in total:
                    total[i, j] += got
                else:
                    total[i, j] = got
        for (i, j), sums in total.items():
            yield pa.RecordBatch.from_pydict({"i": [i], "j": [j], "sums": [sums.tobytes()]}, schema=schema)

    def pairs(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j = (k.as_py() for k in key)
        (a, b), (c, d) = cuts[i], cuts[j]
        sums = np.zeros((6, b - a, d - c))
        for batch in batches:
            for part in batch.column("sums"):
                sums += np.frombuffer(part.as_py()).reshape(sums.shape)
        n, x, y, xx, yy, xy = sums
        with np.errstate(all="ignore"):
            vx, vy = xx - x * x / n, yy - y * y / n
            r = (xy - x * y / n) / np.sqrt(vx * vy)
            # what rounding leaves of a constant is no spread
            known = np.isfinite(r) & (vx > 1e-13 * xx) & (vy > 1e-13 * yy)
        f, g = np.meshgrid(np.arange(a, b), np.arange(c, d), indexing="ij")
        up = f < g
        yield pa.RecordBatch.from_pydict({
            "f1": pa.array([cols[q] for q in f[up]], pa.string()), "f2": pa.array([cols[q] for q in g[up]], pa.string()),
            "corr": pa.array(np.clip(r[up], -1.0, 1.0), mask=~known[up])})

    sent = df.select(*[c.alias(f"c{k}") for k, c in enumerate(quoted)]).mapInArrow(add, "i int, j int, sums binary")
    return sent.groupBy("i", "j").applyInArrow(pairs, "f1 string, f2 string, corr double")


def vif(corr: np.ndarray, ridge: float = 0.0) -> np.ndarray:
    """Diagonal of the inverse correlation matrix (k x k on the driver)."""
    k = corr.shape[0]
    return np.diag(np.linalg.inv(corr + ridge * np.eye(k)))


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), name: str = "q") -> DataFrame:
    """(by..., ``name`` array<double>): exact quantiles per group, interpolated linearly (like pandas); nulls do not count.

    Order statistics are found by running counts over distinct values, so no task holds a
    group: a quantile at place ``p * (n - 1)`` lies between the values whose running counts
    cover the places on either side.  A group without values has no row.
    """
    by = list(by)
    c = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    c = cut_lineage(c)
    r = running_sums(c, by, ["__v"], ["__n"], prefix="__below", materialise=False)
    if by:  # a row per group
        r = join_null_safe(r, c.groupBy(*by).agg(F.sum("__n").alias("__all")), by)
    else:
        r = r.withColumn("__all", F.lit(c.agg(F.sum("__n")).first()[0]))
    found = []
    for i, p in enumerate(probs):
        place = F.lit(float(p)) * (F.col("__all") - 1)
        for side, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("__below__n") <= at) & (at < F.col("__below__n") + F.col("__n"))
            found.append(F.max(F.when(here, F.col("__v"))).alias(f"__{side}{i}"))
    g = r.groupBy(*by).agg(F.max("__all").alias("__all"), *found)
    share = [F.lit(float(p)) * (F.col("__all") - 1) - F.floor(F.lit(float(p)) * (F.col("__all") - 1)) for p in probs]
    value_at = [F.when(w == 0, F.col(f"__lo{i}")).otherwise(F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * w)
                for i, w in enumerate(share)]
    return g.where(F.col("__all").isNotNull()).select(*by, F.array(*value_at).alias(name))


def describe(df: DataFrame, value: str, by: Sequence[str] = (), exact: bool = True,
             accuracy: int = 10000) -> DataFrame:
    """Count, mean, std, min, 25/50/75 % (linear, like pandas), max per group.

    Quantiles are exact order statistics from distributed running counts;
    ``exact=False`` takes observed values from a sketch in the same aggregate instead."""
    v, by = F.col(value), list(by)
    sketch = [] if exact else [F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy).alias("__q")]
    base = df.groupBy(*by).agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                               F.min(v).alias("min"), F.max(v).alias("max"), *sketch)
    if exact:
        key = by or ["__one"]  # without groups both sides have one row
        if not by:
            base, df = base.withColumn("__one", F.lit(1)), df.withColumn("__one", F.lit(1))
        base = join_null_safe(base, quantiles(df, value, (0.25, 0.5, 0.75), key, "__q"), key, "left")
    q = [F.col("__q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))]
    return base.select(*by, "count", "mean", "std", "min", *q, "max")


def equal_width_edges(df: DataFrame, value: str, bins: int) -> list[float]:
    """``pd.cut(x, bins)``-style edges learnt from min/max (one aggregate).

    Edges are ``lo + i * (hi - lo) / bins``; the first is lowered by 0.1 % of
    the range so the minimum falls in bin 0; intervals are right-closed.
    """
    r = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi = float(r["lo"]), float(r["hi"])
    if lo == hi:
        pad = 0.001 * abs(lo) if lo else 0.001
        lo, hi = lo - pad, hi + pad
        step = (hi - lo) / bins
        return [lo + i * step for i in range(bins)] + [hi]
    step = (hi - lo) / bins
    e = [lo + i * step for i in range(bins)] + [hi]
    e[0] = lo - (hi - lo) * 0.001
    return e


def cut(x, edges: Sequence[float]):
    """Right-closed bin number 0..len(edges)-2; outside the edges -> NULL."""
    inner = list(edges[1:-1])
    c = F.col(x) if isinstance(x, str) else x
    return F.when((c > F.lit(float(edges[0]))) & (c <= F.lit(float(edges[-1]))), bin_index(c, inner))


def missing_compare(samples: DataFrame, features: Sequence[str], sample_col: str = "sample") -> DataFrame:
    """Missing and present counts and shares per (feature, sample)."""
    long = samples.select(sample_col, *[F.col(f).isNull().cast("int").alias(f) for f in features]).unpivot(
        [sample_col], list(features), "feature", "miss")
    return long.groupBy("feature", sample_col).agg(
        F.sum("miss").cast("bigint").alias("n_missing"),
        F.sum(1 - F.col("miss")).cast("bigint").alias("n_present"),
        F.avg("miss").alias("share_missing"))


def sample_summary(df: DataFrame, label: str, by: Sequence[str] = ("sample",)) -> DataFrame:
    """Count, positives, negatives, positive share per sample."""
    y = F.col(label).cast("int")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(y).cast("bigint").alias("n_pos"),
                               F.sum(1 - y).cast("bigint").alias("n_neg"),
                               (F.avg(y) * 100).alias("pos_pct"))


def shares(df: DataFrame, by: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Count per group and its share of the total (optionally within ``within``)."""
    cnt = df.groupBy(*within, *by).agg(F.count(F.lit(1)).alias("n"))
    # totals joined back (no single-partition window over all groups)
    if within:
        tot = cnt.groupBy(*within).agg(F.sum("n").alias("_tot"))
        return join_null_safe(cnt, tot, list(within)).withColumn("share", F.col("n") / F.col("_tot")).drop("_tot")
    t = cnt.agg(F.sum("n").alias("t")).first()["t"]
    return cnt.withColumn("share", F.col("n") / F.lit(float(t or 1)))


def wilson(k: float, n: float, alpha: float = 0.05) -> tuple[float, float]:
    """Wilson score interval for a proportion (closed form)."""
    from statistics import NormalDist
    if n <= 0:
        return 0.0, 1.0
    z = NormalDist().inv_cdf(1 - alpha / 2)
    p = k / n
    den = 1 + z * z / n
    mid = (p + z * z / (2 * n)) / den
    half = z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / den
    return float(mid - half), float(mid + half)
