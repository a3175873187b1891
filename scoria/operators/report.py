"""Validation statistics needing resampling or refits.

Bootstraps work on aggregated cells — (score or category, class) counts —
never on rows: each replicate draws Poisson(count) weights per cell
(the standard distributed bootstrap) as column expressions over md5 of
(cell, replicate), so SQL can check them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoria.functions.draws import poisson_pairs, strings
from scoria.operators.metrics import auc, corr_matrix, score_counts, vif
from scoria.operators.ranking import running_sums
from scoria.session import cut_lineage

__all__ = ["poisson_weight", "gini_ci", "woe_bootstrap", "vif_table", "loo_contribution", "coef_table"]


def _replicates(cells: DataFrame, n: int) -> DataFrame:
    return cells.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


#: Up to this mean a Poisson weight is read off its distribution function, beyond by a corrected normal.
LADDER = 32


def _ladder(mean: int) -> list[float]:
    """The distribution function of Poisson(``mean``) at 0, 1, 2, ... until it is 1 to 12 digits."""
    p = total = math.exp(-mean)
    out = [total]
    while 1 - total > 1e-12 and len(out) < 200:
        p *= mean / len(out)
        total += p
        out.append(total)
    return out


LADDERS = [[2.0], *(_ladder(m) for m in range(1, LADDER + 1))]


def poisson_weight(count: Column, key: Column) -> Column:
    """A Poisson(``count``) draw that depends on ``key`` alone, so any retry or partitioning draws the same.

    md5 of the key gives two uniforms.  Means of up to ``LADDER`` count the steps of the distribution
    function below the first; larger ones use Box-Muller with the skewness correction (z * z - 1) / 6.
    """
    h = F.md5(key)
    u, v = (F.conv(F.substring(h, a, 8), 16, 10).cast("double") / F.lit(4294967296.0) for a in (1, 9))
    steps = F.array(*[F.array(*[F.lit(x) for x in ladder]) for ladder in LADDERS])
    ladder = F.element_at(steps, (F.least(count, F.lit(LADDER)) + 1).cast("int"))
    # a variable of its own: else the uniform would be computed again for every step
    small = F.transform(F.array(u), lambda x: F.size(F.filter(ladder, lambda c: c <= x)))[0]
    z = F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * math.pi * v)
    large = F.greatest(F.lit(0.0), F.floor(count + F.sqrt(count.cast("double")) * z + (z * z - 1) / 6 + 0.5))
    return F.when(count == 0, F.lit(0.0)).when(count <= LADDER, small.cast("double")).otherwise(large.cast("double"))


def gini_ci(df: DataFrame, label: str, score: str, by: Sequence[str] = (), n: int = 1000,
            p: float = 0.05, seed: int = 0) -> DataFrame:
    """Bootstrap confidence interval of Gini per group.

    Rows become distinct scores with class counts; each replicate draws Poisson weights per score and
    class (the distributed bootstrap) and takes its AUC by running sums within slices of sorted scores and over
    the slices.  No task holds the scores of a replicate, so a continuous score works, too.  Replicates without either class
    do not count.  Returns (by..., gini_lo, gini_hi), rounded 3.
    """
    by = list(by)
    cells = score_counts(df, label, score, by).withColumn("__n", F.col("pos") + F.col("neg"))
    group = [F.coalesce(F.concat(F.lit("0"), F.col(c).cast("string")), F.lit("1")) for c in by]
    # the number of rows below names a score within its group
    cells = cut_lineage(running_sums(cells, by, [score], ["__n"], prefix="__below").select(
        *by, F.col("__below__n").alias("__at"), "pos", "neg", F.to_json(F.array(F.lit(""), *group)).alias("__g")))
    key = F.concat(F.concat_ws("|", F.lit(str(seed)), *group, F.col("__at").cast("string")), F.lit("|"))
    # cells are sorted and drawn for all replicates in place: no replicate of a cell is ever a row
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    placed = cells.repartitionByRange(slices, "__g", "__at").sortWithinPartitions("__g", "__at").select("__g", key.alias("key"), "neg", "pos")
    sums = cut_lineage(placed.mapInArrow(_slice_sums(n), "__g string, rep long, slice long, area double, pos double, neg double"))
    below = Window.partitionBy("__g", "rep").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    a = sums.withColumn("below", F.coalesce(F.sum("neg").over(below), F.lit(0.0))).groupBy("__g", "rep").agg(
        F.sum(F.col("area") + F.col("pos") * F.col("below")).alias("area"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    a = a.where("pos > 0 AND neg > 0").withColumn("gini", 2 * (F.col("area") / (F.col("pos") * F.col("neg"))) - 1)
    q = F.percentile("gini", F.array(F.lit(p / 2), F.lit(1 - p / 2)))  # n values a group
    r = a.groupBy("__g").agg(q.alias("_q")).join(cells.select("__g", *by).distinct(), "__g")
    return r.select(*by, F.round(F.col("_q")[0], 3).alias("gini_lo"), F.round(F.col("_q")[1], 3).alias("gini_hi"))


#: Draws that are made at once (their arrays stay in the processor's cache).
DRAWS = 1 << 16


def _slice_sums(n: int):
    """Per slice, group and replicate of sorted cells (group, key, neg, pos): the weights drawn for both classes and the
    area ``pos * (negatives below in the slice + neg / 2)``."""
    def run(batches):
        from pyspark import TaskContext
        here, sums = TaskContext.get().partitionId(), {}  # group -> (area, pos, neg) by replicate
        suffixes = [[f"{rep}|{k}".encode() for rep in range(n)] for k in (0, 1)]
        step = max(1, DRAWS // n)
        for b in filter(len, batches):
            names, (data, begin, length) = b.column(0).dictionary_encode(), strings(b.column(1))
            group = names.indices.to_numpy()
            counts = [b.column(c).fill_null(0).to_numpy() for c in (2, 3)]
            own = [sums.setdefault(g, np.zeros((3, n))) for g in names.dictionary.to_pylist()]
            ends = np.nonzero(np.diff(group, append=-1))[0] + 1
            for first, end in zip([0, *ends[:-1]], ends):  # the cells of a group
                area, pos, below = own[group[first]]
                for lo in range(first, end, step):
                    at = slice(lo, min(end, lo + step))
                    w = [poisson_pairs(data, begin[at], length[at], c[at], s, LADDERS) for c, s in zip(counts, suffixes)]
                    less = np.cumsum(w[0], axis=0)
                    area += (w[1] * (below + less - w[0] / 2)).sum(0)
                    pos += w[1].sum(0)
                    below += less[-1]
        for g, (area, pos, neg) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([g] * n), pa.array(np.arange(n)), pa.array(np.full(n, here)), *map(pa.array, (area, pos, neg))],
                                             names=["__g", "rep", "slice", "area", "pos", "neg"])
    return run


def woe_bootstrap(df: DataFrame, feature: str, label: str, n: int = 300, seed: int = 0) -> DataFrame:
    """WoE per category for ``n`` bootstrap replicates (+0.5 smoothing):
    ``woe = ln(((n0+.5)/(N0+.5)) / ((n1+.5)/(N1+.5)))``.  Returns (rep, category, woe); a missing
    category is a null one.  A replicate's totals are summed apart, so a feature of many categories
    is in no single task."""
    y = F.col(label).cast("int")
    cells = df.groupBy(F.col(feature).cast("string").alias("category")).agg(
        F.sum(1 - y).cast("bigint").alias("n0"), F.sum(y).cast("bigint").alias("n1"))
    name = F.coalesce(F.concat(F.lit("0"), F.col("category")), F.lit("1"))
    key = F.concat_ws("|", F.lit(str(seed)), name, F.col("rep").cast("string"))
    reps = cut_lineage(_replicates(cells, n).select("rep", "category", *[
        poisson_weight(F.col(f"n{i}"), F.concat(key, F.lit(f"|{i}"))).alias(f"n{i}") for i in (0, 1)]))
    total = reps.groupBy("rep").agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    part = [(F.col(f"n{i}") + 0.5) / (F.col(f"t{i}") + 0.5) for i in (0, 1)]
    return reps.join(total, "rep").select("rep", "category", F.log(part[0] / part[1]).alias("woe"))


def vif_table(df: DataFrame, features: Sequence[str]) -> pd.DataFrame:
    """diag(corr^-1) with signed correlations, round 6, descending."""
    c = corr_matrix(df, features)
    v = vif(c)
    t = pd.DataFrame({"feature": list(features), "vif": np.round(v, 6)})
    return t.sort_values(["vif", "feature"], ascending=[False, True]).reset_index(drop=True)


def coef_table(weights: dict, intercept: float, p_values: dict | None = None, p_values_valid: dict | None = None) -> pd.DataFrame:
    """Coefficients by rising value, with p-values on train and on the held sample; round 6."""
    coef = pd.Series({**weights, "Intercept_": intercept}, dtype=float)
    t = pd.DataFrame({"coef": coef, "p_value": pd.Series(p_values or {}, dtype=float), "p_value_valid": pd.Series(p_values_valid or {}, dtype=float)},
                     index=coef.sort_values(kind="stable").index).round(6)
    return t.rename_axis("feature").reset_index()


def loo_contribution(train_comp: DataFrame, test_comp: DataFrame, features: Sequence[str]) -> pd.DataFrame:
    """Refit without each feature (unpenalised, all refits in one batch),
    AUC drop on test (round 4).  < 2 features -> empty."""
    from scoria.operators.model import glm_fit
    feats = list(features)
    if len(feats) < 2:
        return pd.DataFrame(columns=["feature", "auc_drop"])
    models = [{"id": 0, "lam": 0.0}] + [{"id": i + 1, "lam": 0.0, "active": [j for j in range(len(feats)) if j != i]}
                                         for i in range(len(feats))]
    fits = glm_fit(train_comp, feats, models)
    # score every test cell under each model: k+1 literal expressions, exploded
    # (a projection; no join)
    pairs = []
    for m in sorted(fits):
        b = fits[m]["beta"]
        z = F.lit(float(b[-1]))
        for i, f in enumerate(feats):
            z = z + F.lit(float(b[i])) * F.col(f)
        pairs.append(F.struct(F.lit(m).alias("model"), z.alias("score")))
    sc = test_comp.select("n", "n1", F.explode(F.array(*pairs)).alias("m")).select("n", "n1", "m.*")
    counts = sc.groupBy("model", "score").agg(F.sum("n1").cast("bigint").alias("pos"),
                                              F.sum(F.col("n") - F.col("n1")).cast("bigint").alias("neg"))
    a = {r["model"]: r["auc"] for r in auc(counts, "y", "score", by=["model"], counts=True).collect()}
    return pd.DataFrame([(f, round(a[0] - a[i + 1], 4)) for i, f in enumerate(feats)],
                        columns=["feature", "auc_drop"])
