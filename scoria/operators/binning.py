"""Supervised binning.

Work split:
* Spark builds the histogram ``(feature, qbin, fold, n, n1, lo, hi)`` —
  at most ``max_bins`` quantile bins per feature — from the long form in
  two aggregate jobs (quantile sketch, then counts).  Rows are first
  reduced to distinct values, so the bin lookup runs once per distinct
  value, not per row.
* ``groupBy(feature).applyInPandas`` searches split points on that
  histogram: best-first growth on the logistic gain (one boosting step
  from the base rate), leaf-size, gain and monotone constraints; the
  parameter grid is scored by cross-validated AUC where the training part
  of fold f is ``total - fold f`` (histograms are additive), so no data
  is re-scanned per fold or per candidate.
* Merge procedures (Wilson-interval overlap, fold stability) run the same
  way on per-feature bin count tables.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoria.functions.exprs import bin_index
from scoria.session import by_group, cut_lineage

__all__ = ["quantile_edges", "histogram", "histogram_wide", "fit_splits", "tree_bins", "best_first_splits",
           "hist_auc", "merge_ci", "merge_folds", "special_points", "special_stats", "held_in", "merge_special",
           "merged_splits", "quantile_splits", "DEFAULT_GRID"]

MAX_HIST_BINS = 255


def quantile_edges(xs: DataFrame, value: str = "x", max_bins: int = MAX_HIST_BINS,
                   accuracy: int = 10000) -> DataFrame:
    """Per-feature approximate quantile edges (distinct, sorted): ``(feature, edges)``."""
    probs = [i / max_bins for i in range(1, max_bins)]
    e = xs.groupBy("feature").agg(F.percentile_approx(value, probs, accuracy).alias("edges"))
    return e.select("feature", F.array_sort(F.array_distinct("edges")).alias("edges"))


def histogram(xs: DataFrame, value: str = "x", fold: str = "fold", target: str = "target",
              max_bins: int = MAX_HIST_BINS) -> DataFrame:
    """``(feature, qbin, fold, n, n1, lo, hi)`` with qbin = number of edges < x."""
    edges = quantile_edges(xs, value, max_bins)
    distinct = xs.groupBy("feature", value, fold).agg(F.count(F.lit(1)).alias("n"),
                                                      F.sum(target).cast("bigint").alias("n1"))
    # edges: one row per feature (schema-bounded) -> broadcast
    d = distinct.join(F.broadcast(edges), "feature")
    qbin = F.size(F.filter("edges", lambda e: e < F.col(value)))
    return (d.groupBy("feature", qbin.alias("qbin"), fold)
             .agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"),
                  F.min(value).alias("lo"), F.max(value).alias("hi")))


def histogram_wide(df: DataFrame, features: Sequence[str], fold: str | Sequence[str] = "fold",
                   target: str = "target", max_bins: int = MAX_HIST_BINS, rel_err: float = 1e-3) -> DataFrame:
    """Histogram straight from the wide frame (real features).

    Edges: one ``approxQuantile`` pass for all columns (features x max_bins
    numbers to the driver).  Bucketing: MLlib ``Bucketizer`` with one split
    array per column — a JVM binary search per value, inside one projection.
    Then one unpivot + aggregate.  Missing values are dropped (they are the
    missing-value bin, handled by the policy).
    """
    from pyspark.ml.feature import Bucketizer
    feats = list(features)
    folds = [fold] if isinstance(fold, str) else list(fold)
    if not feats:
        return df.sparkSession.createDataFrame(
            [], "feature string, qbin int, fold int, n bigint, n1 bigint, lo double, hi double")
    probs = [i / max_bins for i in range(1, max_bins)]
    d = df.select(*folds, target, *[F.col(f).cast("double").alias(f) for f in feats])
    qs = d.approxQuantile(feats, probs, rel_err)
    splits = []
    for q in qs:
        inner = sorted({float(v) for v in q if v is not None and not math.isnan(v)})
        splits.append([-math.inf] + inner + [math.inf])
    qcols = [f"__q{i}" for i in range(len(feats))]
    b = Bucketizer(splitsArray=splits, inputCols=feats, outputCols=qcols, handleInvalid="keep")
    # Bucketizer rejects nulls: feed NaN, drop it after the unpivot
    z = d.fillna(float("nan"), feats)
    bz = b.transform(z)
    pairs = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("x"), F.col(q).cast("int").alias("qbin"))
             for f, q in zip(feats, qcols)]
    long = bz.select(*folds, target, F.explode(F.array(*pairs)).alias("p")).select(*folds, target, "p.*")
    long = long.where(~F.isnan("x"))
    return (long.groupBy("feature", "qbin", *folds)
                .agg(F.count(F.lit(1)).alias("n"), F.sum(target).cast("bigint").alias("n1"),
                     F.min("x").alias("lo"), F.max("x").alias("hi")))


# ------------------------------------------------------------------ split search (pandas, per feature)

def _merge_min_bin(n: np.ndarray, min_data_in_bin: int) -> list[int]:
    """Group adjacent histogram bins so every group holds >= min_data_in_bin rows.
    Returns the index of the last bin of each group (candidate cut positions)."""
    cuts, acc = [], 0
    for i, v in enumerate(n):
        acc += v
        if acc >= min_data_in_bin:
            cuts.append(i)
            acc = 0
    if not cuts or cuts[-1] != len(n) - 1:
        if cuts:
            cuts[-1] = len(n) - 1
        else:
            cuts = [len(n) - 1]
    return cuts


def best_first_splits(n: np.ndarray, n1: np.ndarray, num_leaves: int, min_data_in_leaf: int,
                      min_data_in_bin: int = 1, min_gain_to_split: float = 0.0,
                      monotone: int = 0, base_rate: float | None = None) -> list[int]:
    """Cut positions (index of the last histogram bin of each left part).

    Gain of a split: GL^2/HL + GR^2/HR - G^2/H with g = p0 - y,
    h = p0 (1 - p0) (first boosting step from the base rate p0).  Leaves
    are intervals; a split is allowed when both sides keep
    ``min_data_in_leaf`` rows, gain > ``min_gain_to_split`` and, with a
    monotone constraint, leaf values stay ordered along the axis.
    """
    n = np.asarray(n, float)
    n1 = np.asarray(n1, float)
    tot = n.sum()
    if tot <= 0 or len(n) < 2:
        return []
    p0 = base_rate if base_rate is not None else n1.sum() / tot
    p0 = min(max(p0, 1e-12), 1 - 1e-12)
    g = n * p0 - n1
    h = n * p0 * (1 - p0)
    cand = _merge_min_bin(n, max(min_data_in_bin, 1))[:-1]
    cg, ch, cn = np.cumsum(g), np.cumsum(h), np.cumsum(n)

    def seg(a, b):  # sums over bins a..b inclusive
        G = cg[b] - (cg[a - 1] if a > 0 else 0.0)
        H = ch[b] - (ch[a - 1] if a > 0 else 0.0)
        N = cn[b] - (cn[a - 1] if a > 0 else 0.0)
        return G, H, N

    def val(G, H):
        return -G / H if H > 0 else 0.0

    cand = np.asarray(cand, int)
    leaves = [(0, len(n) - 1)]
    cuts: list[int] = []
    while len(leaves) < num_leaves:
        best = None
        vals = [val(*seg(a, b)[:2]) for a, b in leaves]
        for li, (a, b) in enumerate(leaves):
            c = cand[(cand >= a) & (cand < b)]
            if c.size == 0:
                continue
            G, H, N = seg(a, b)
            parent = G * G / H if H > 0 else 0.0
            off_g = cg[a - 1] if a > 0 else 0.0
            off_h = ch[a - 1] if a > 0 else 0.0
            off_n = cn[a - 1] if a > 0 else 0.0
            GL, HL, NL = cg[c] - off_g, ch[c] - off_h, cn[c] - off_n
            GR, HR, NR = G - GL, H - HL, N - NL
            ok = (NL >= min_data_in_leaf) & (NR >= min_data_in_leaf) & (HL > 0) & (HR > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ok, GL * GL / HL + GR * GR / HR - parent, -np.inf)
                if monotone:
                    vl, vr = -GL / HL, -GR / HR
                    good = (vr - vl) * monotone >= 0
                    if li > 0:
                        good &= (vl - vals[li - 1]) * monotone >= 0
                    if li + 1 < len(leaves):
                        good &= (vals[li + 1] - vr) * monotone >= 0
                    gain = np.where(good, gain, -np.inf)
            gain = np.where(gain > min_gain_to_split, gain, -np.inf)
            i = int(np.argmax(gain))
            if np.isfinite(gain[i]) and (best is None or gain[i] > best[0]):
                best = (float(gain[i]), li, int(c[i]))
        if best is None:
            break
        _, li, c = best
        a, b = leaves[li]
        leaves[li:li + 1] = [(a, c), (c + 1, b)]
        cuts.append(c)
    return sorted(cuts)


def hist_auc(score: np.ndarray, n1: np.ndarray, n0: np.ndarray) -> float:
    """AUC of per-bin scores with ties counted half (bins with equal score tie)."""
    u, inv = np.unique(np.asarray(score, float), return_inverse=True)
    p = np.bincount(inv, weights=np.asarray(n1, float), minlength=len(u))
    q = np.bincount(inv, weights=np.asarray(n0, float), minlength=len(u))
    P, N = p.sum(), q.sum()
    if P <= 0 or N <= 0:
        return float("nan")
    cn = np.concatenate([[0.0], np.cumsum(q)[:-1]])
    return float((p * (cn + q / 2)).sum() / (P * N))


def _leaf_scores(n, n1, cuts, base_rate):
    """Per histogram bin: the leaf value (event-rate direction) of its leaf."""
    bounds = [-1] + list(cuts) + [len(n) - 1]
    s = np.empty(len(n))
    for a, b in zip(bounds[:-1], bounds[1:]):
        N, P = n[a + 1:b + 1].sum(), n1[a + 1:b + 1].sum()
        s[a + 1:b + 1] = (P / N - base_rate) if N > 0 else 0.0
    return s


DEFAULT_GRID = {"min_data_in_bin_mults": (1, 2, 4), "min_gain_to_split": (0.0, 0.5, 1.0)}


def fit_splits(h: pd.DataFrame, max_bin_count: int = 5, min_bin_size: int = 1,
               min_bin_mults: Sequence[float] = (2, 4), min_gains: Sequence[float] = (0.0, 0.5, 1.0),
               monotone: int = 0, cv: bool = True, mdb: int | None = None) -> tuple[list[float], dict]:
    """E10/E11/E13 for one feature's histogram (columns qbin, fold, n, n1, hi).

    Grid: min_data_in_bin in {mbs, m*mbs...} x min_gain x num_leaves 2..max;
    score = median fold AUC (tie -> smaller std); final fit on all folds.
    Returns (thresholds, chosen params).  No rows -> ``[-inf]``.
    """
    if h.empty or h["n"].sum() == 0:
        return [-math.inf], {}
    tot = h.groupby("qbin", sort=True).agg(n=("n", "sum"), n1=("n1", "sum"), hi=("hi", "max"))
    qb = tot.index.to_numpy()
    n, n1, hi = tot["n"].to_numpy(float), tot["n1"].to_numpy(float), tot["hi"].to_numpy(float)
    min_data_in_bin = ([mdb] if mdb is not None else
                       [min_bin_size] + [int(m * min_bin_size) for m in min_bin_mults])
    grid = list(itertools.product(min_data_in_bin, min_gains, range(2, max(max_bin_count, 2) + 1)))
    # Every fold assignment present (cv seeds "cvf*", else "fold") x its folds
    fold_cols = [c for c in h.columns if (c.startswith("cvf") or c == "fold") and h[c].notna().any()]
    best_key, best_params = None, None
    per_fold = {}
    for fc in (fold_cols if cv else []):
        for f in sorted(h[fc].dropna().unique()):
            part = h[h[fc] == f].groupby("qbin").agg(n=("n", "sum"), n1=("n1", "sum")).reindex(qb, fill_value=0)
            per_fold[(fc, f)] = (part["n"].to_numpy(float), part["n1"].to_numpy(float))
    if cv and len(per_fold) > 1:
        for mdb, mg, nl in grid:
            scores = []
            for f in per_fold:
                fn, fn1 = per_fold[f]
                tn, tn1 = n - fn, n1 - fn1
                if tn.sum() <= 0:
                    continue
                br = tn1.sum() / tn.sum()
                cuts = best_first_splits(tn, tn1, nl, min_bin_size, mdb, mg, monotone, br)
                s = _leaf_scores(tn, tn1, cuts, br)
                a = hist_auc(s, fn1, fn - fn1)
                if not math.isnan(a):
                    scores.append(a)
            if not scores:
                continue
            key = (float(np.median(scores)), -float(np.std(scores)))
            if best_key is None or key > best_key:
                best_key, best_params = key, (mdb, mg, nl)
    if best_params is None:
        best_params = (min_data_in_bin[0], min_gains[0], max(max_bin_count, 2))
    mdb, mg, nl = best_params
    cuts = best_first_splits(n, n1, nl, min_bin_size, mdb, mg, monotone)
    thresholds = sorted({float(hi[c]) for c in cuts})
    return thresholds, {"min_data_in_bin": mdb, "min_gain_to_split": mg, "num_leaves": nl,
                        "cv_auc": None if best_key is None else best_key[0]}


def tree_bins(hist: DataFrame, max_bin_count: int | Mapping[str, int] = 5, min_bin_size: int = 1,
              min_bin_mults: Sequence[float] = (2, 4), min_gains: Sequence[float] = (0.0, 0.5, 1.0),
              monotone: Mapping[str, int] | None = None, cv: bool = True,
              single_split: Mapping[str, int] | None = None) -> DataFrame:
    """E10/E11 for all features: ``groupBy(feature).applyInPandas`` on the
    histogram (<= 255 x folds rows per feature).  Returns
    ``(feature, splits ARRAY<DOUBLE>, num_leaves INT, cv_auc DOUBLE)``."""
    mono = dict(monotone or {})
    mbc = max_bin_count if isinstance(max_bin_count, Mapping) else None
    mbc_default = 5 if mbc is not None else int(max_bin_count)

    single = dict(single_split or {})

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        f = pdf["feature"].iloc[0]
        k = int(mbc.get(f, mbc_default)) if mbc is not None else mbc_default
        if f in single:
            # One split with a leaf as small as the non-dominant rows
            s, p = fit_splits(pdf, 2, int(single[f]), (), (0.0,), int(mono.get(f, 0)), False, mdb=3)
        else:
            s, p = fit_splits(pdf, k, min_bin_size, min_bin_mults, min_gains, int(mono.get(f, 0)), cv)
        return pd.DataFrame({"feature": [f], "splits": [s], "num_leaves": [p.get("num_leaves", 1)],
                             "cv_auc": [p.get("cv_auc")]})

    return by_group(hist, "feature").groupBy("feature").applyInPandas(
        run, "feature string, splits array<double>, num_leaves int, cv_auc double")


# ------------------------------------------------------------------ merging

def _wilson(k: np.ndarray, n: np.ndarray, alpha: float) -> np.ndarray:
    """Wilson interval ends (2 x bins) of event rates k / n; (0, 1) for an empty bin."""
    from statistics import NormalDist
    z = NormalDist().inv_cdf(1 - alpha / 2)
    m = np.maximum(n, 1)
    mid, half = k / m + z * z / (2 * m), z * np.sqrt(np.maximum(k / m * (1 - k / m) / m + z * z / (4 * m * m), 0))
    ends = np.stack((mid - half, mid + half)) / (1 + z * z / m)
    return np.where(n > 0, ends, np.array([[0.0], [1.0]]))


def _log_odds(events: np.ndarray, n: np.ndarray, t1: float, t0: float) -> np.ndarray:
    """Local WoE of bins; an empty class counts 0.5."""
    return np.log((np.maximum(events, 0.5) / t1) / (np.maximum(n - events, 0.5) / t0))


def _totals(n, n1) -> tuple[float, float]:
    return max(float(np.sum(n1)), 0.5), max(float(np.sum(n) - np.sum(n1)), 0.5)


def _pairs(n_nodes: int, special: Sequence[int]) -> list[tuple[int, int]]:
    """The neighbours: bins in a line, and each special point (the last nodes) with the bin that holds its value."""
    n_bins = n_nodes - len(special)
    return [(i, i + 1) for i in range(n_bins - 1)] + [(b, n_bins + j) for j, b in enumerate(special)]


def _merge(n_nodes: int, pairs: Sequence[tuple[int, int]], most: float, worst) -> list[int]:
    """Join neighbouring groups one pair at a time, until two are left.

    ``worst(group, a, b, forced)`` gets each node's group (its first node) and the pairs (a, b) of groups
    that touch, and names the next pair to join, or None.  A joined group touches what its parts touched.
    Returns each node's group, numbered by first node.
    """
    group = np.arange(n_nodes)
    while len(np.unique(group)) > 2:
        touching = sorted({(min(group[i], group[j]), max(group[i], group[j])) for i, j in pairs if group[i] != group[j]})
        if not touching:
            break
        a, b = np.array(touching).T
        i = worst(group, a, b, len(np.unique(group)) > most)
        if i is None:
            break
        group[group == b[i]] = a[i]
    return np.unique(group, return_inverse=True)[1].tolist()


def merge_ci(n: Sequence[float], n1: Sequence[float], max_bin_count: int | None = None,
             alpha: float = 0.05, order: str = "overlap", special: Sequence[int] = ()) -> list[int]:
    """Merge neighbouring bins by overlap of their Wilson intervals (mapped to WoE).

    ``order="overlap"``: while some neighbours overlap (> 0) or there
    are too many bins, merge the most overlapping pair.  ``"as_written"``
    reproduces the original loop (merge the least overlapping pair while
    any overlap is < 0).  Stops at 2 bins.  The last ``len(special)`` entries of
    ``n`` and ``n1`` are special points, heaped values counted apart; ``special`` names
    the bin each hangs on, its only neighbour until they merge.  Returns, for each
    bin and point, its merged group index.
    """
    n, n1 = np.asarray(n, float), np.asarray(n1, float)
    t1, t0 = _totals(n, n1)

    def worst(group, a, b, forced):
        size, events = np.bincount(group, n, len(n)), np.bincount(group, n1, len(n))
        low, high = _log_odds(np.maximum(np.trunc(_wilson(events, size, alpha) * size), 0.5), size, t1, t0)
        overlap = np.minimum(high[a], high[b]) - np.maximum(low[a], low[b])
        i = int(overlap.argmin() if order == "as_written" else overlap.argmax())
        wanted = overlap[i] < 0 if order == "as_written" else overlap[i] > 0
        return i if wanted or forced else None

    return _merge(len(n), _pairs(len(n), special), math.inf if max_bin_count is None else max_bin_count, worst)


def merge_folds(n: np.ndarray, n1: np.ndarray, fold_n: np.ndarray, fold_n1: np.ndarray,
                max_bin_count: int, special: Sequence[int] = ()) -> list[int]:
    """Fold-stability merging.  ``fold_n[f, b]`` are fold-f counts.

    Penalty of a neighbouring pair = how much the folds' WoE contradict the
    full-sample order of the two bins (0 when every fold agrees).  Merges the
    lowest-penalty pair until at most ``max_bin_count`` bins remain (the
    statistic is never negative, so only the bin cap triggers merging).
    ``special`` as in ``merge_ci``.
    """
    k = len(fold_n)
    share = (k - 1) / k if k > 1 else 1.0
    t1, t0 = _totals(n, n1)
    # rows: the whole sample, then each fold
    every_n, every_1 = np.vstack((n, fold_n)).astype(float), np.vstack((n1, fold_n1)).astype(float)
    scale = np.concatenate(([1.0], np.full(k, share)))[:, None]

    def against(a, b, folds_b):
        """Per pair: how far the folds put b on the other side of a than the whole sample does."""
        d = (b - a) * (folds_b - a)
        return np.where((d > 0).all(axis=0), 0.0, -np.minimum(d, 0).sum(axis=0))

    def worst(group, a, b, forced):
        size, events = (np.stack([np.bincount(group, r, len(r)) for r in rows]) for rows in (every_n, every_1))
        w = _log_odds(events, size, t1 * scale, t0 * scale)
        left, right = w[:, a], w[:, b]
        penalty = np.minimum(against(left[0], right[0], right[1:]), against(right[0], left[0], left[1:]))
        return int(penalty.argmin()) if forced else None

    return _merge(len(n), _pairs(len(n), special), max(max_bin_count, 2), worst)


def special_points(df: DataFrame, features: Sequence[str], share: float = 0.05) -> dict[str, list[float]]:
    """The heaped values of each feature: those that at least ``share`` of its non-missing rows have.

    One aggregate by value; at most ``1 / share`` values per feature reach the driver."""
    long = df.select(*[F.col(f).cast("double").alias(f) for f in features]).unpivot([], list(features), "feature", "x")
    counts = long.where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy("feature", "x").agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(counts)
    total = counts.groupBy("feature").agg(F.sum("n").alias("all"))
    got = counts.join(total, "feature").where(F.col("n") >= share * F.col("all")).orderBy("feature", "x").collect()
    return {f: [r.x for r in got if r.feature == f] for f in features}


def special_stats(df: DataFrame, splits: dict[str, Sequence[float]], special: dict[str, Sequence[float]],
                  target: str = "target", by: Sequence[str] = ()) -> DataFrame:
    """(feature, node, by..., n, n1): rows and events of the bins 0 .. len(splits), special values left out,
    then of the special values in their order.  Missing values are in no node."""
    nodes = []
    for f, s in splits.items():
        x = F.col(f).cast("double")
        at = bin_index(x, s)
        for j, v in enumerate(special.get(f, ())):
            at = F.when(x == F.lit(float(v)), F.lit(len(s) + 1 + j)).otherwise(at)
        nodes.append(F.when(~F.isnan(x), at).alias(f))
    long = df.select(*by, F.col(target).cast("int").alias("__y"), *nodes).unpivot([*by, "__y"], list(splits), "feature", "node")
    return long.where(F.col("node").isNotNull()).groupBy("feature", "node", *by).agg(
        F.count(F.lit(1)).alias("n"), F.sum("__y").cast("bigint").alias("n1"))


def held_in(splits: Sequence[float], special: Sequence[float]) -> list[int]:
    """The bin that holds each special value: the one at its left border."""
    return [int(np.searchsorted(splits, v, side="left")) for v in special]


def merge_special(stats: DataFrame, splits: dict[str, Sequence[float]], special: dict[str, Sequence[float]],
                  max_bin_count: int = 5, fold: str = "fold") -> DataFrame:
    """(feature, node, special, n, n1, group_ci, group_folds) from ``special_stats`` by ``fold``: both merges
    over bins and special points, one group of nodes x folds rows per feature."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        f = pdf["feature"].iloc[0]
        k, hang = len(splits[f]) + 1, held_in(splits[f], special.get(f, ()))
        nodes = range(k + len(hang))
        t = pdf.pivot_table(index="node", columns=fold, values=["n", "n1"], aggfunc="sum", fill_value=0)
        fn, fn1 = (t[c].reindex(nodes, fill_value=0).to_numpy(float).T for c in ("n", "n1"))
        n, n1 = fn.sum(0), fn1.sum(0)
        return pd.DataFrame({"feature": f, "node": list(nodes), "special": [i >= k for i in nodes], "n": n.astype("int64"),
                             "n1": n1.astype("int64"), "group_ci": merge_ci(n, n1, max_bin_count, special=hang),
                             "group_folds": merge_folds(n, n1, fn, fn1, max_bin_count, special=hang)})

    return by_group(stats, "feature").groupBy("feature").applyInPandas(
        run, "feature string, node int, special boolean, n long, n1 long, group_ci long, group_folds long")


def merged_splits(splits: Sequence[float], groups: Sequence[int]) -> list[float]:
    """Thresholds that survive a merge: keep s_i when bins i and i+1 differ in group."""
    return [s for i, s in enumerate(splits) if groups[i] != groups[i + 1]]


def quantile_splits(xs: DataFrame, q: int, value: str = "x", exact: bool = False,
                    accuracy: int = 10000) -> DataFrame:
    """Per-feature percentiles at step 100/q (last = 100), unique, as splits.

    ``exact`` interpolates order statistics (``metrics.quantiles``); the default takes observed
    values from a sketch."""
    probs = [min(i / q, 1.0) for i in range(1, q + 1)]
    if exact:
        from scoria.operators.metrics import quantiles
        got = quantiles(xs, value, probs, ["feature"])
    else:
        got = xs.groupBy("feature").agg(F.percentile_approx(value, probs, accuracy).alias("q"))
    return got.select("feature", F.array_sort(F.array_distinct("q")).alias("splits"))
