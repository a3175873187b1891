"""End-to-end scorecard fit (M5): types -> filters -> policy -> folds ->
encode + bin -> WoE -> selection -> refit.

Each stage is a handful of Spark aggregates over the long form; the
driver only holds per-feature tables, k x k matrices and path tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoria.operators import binning as B
from scoria.operators import model as M
from scoria.operators import select as S
from scoria.operators import woe as W
from scoria.operators.metrics import auc, corr_matrix
from scoria.functions.exprs import md5_bucket
from scoria.operators.sampling import assign_folds
from scoria.session import cut_lineage, spread

__all__ = ["ScorecardEstimator", "FitArtifacts"]


class FitArtifacts(dict):
    """Intermediate tables of a fit (policy, splits, WoE table, path ...)."""


def _tick(art, name):
    """Time since the fit's last tick, by stage."""
    import time
    now, last = time.time(), getattr(art, "at", None)
    if last:
        art.setdefault("timings", {})[name] = round(now - last, 2)
    art.at = now


#: Values of ``imp_type``.
IMPORTANCE = (None, "feature_imp", "perm_imp")
#: Values of ``order_by``: of two correlated features the one with the larger AUC or information value stays.
ORDERS = ("auc", "iv")


class ScorecardEstimator:
    """Interpretable WoE logistic scorecard on Spark DataFrames.

    Parameter names and defaults are fixed values (public interface); fractions
    in [0, 1) of ``th_const``, ``th_nan``, ``th_cat``, ``min_bin_size`` are
    fractions of the training rows.
    """

    def __init__(self, interpreted_model: bool = True, monotonic: bool = False, max_bin_count: int = 5,
                 select_type: int | None = None, pearson_th: float = 0.9, auc_th: float = 0.505,
                 vif_th: float = 5.0, imp_th: float = 0.001, th_const: float = 0.005,
                 th_nan: float = 0.005, th_cat: float = 0.005, woe_diff_th: float = 0.01,
                 min_bin_size: float = 0.01, min_bin_mults: Sequence[float] = (2, 4),
                 min_gains_to_split: Sequence[float] = (0.0, 0.5, 1.0), auc_tol: float = 1e-4,
                 cat_alpha: float = 1.0, cat_merge_to: str = "to_woe_0", nan_merge_to: str = "to_woe_0",
                 oof_woe: bool = False, n_folds: int = 6, l1_base_step: int = 20, l1_exp_step: float = 4.0,
                 imp_type: str | None = "feature_imp", regularized_refit: bool = True, p_val: float = 0.05,
                 key: str = "k", cv_binning: bool = True, fold_method: str = "hash",
                 force_single_split: bool = False, drop_features: Sequence[str] = (),
                 max_cat_literal: int = 256, cv_seeds: int = 3, cv_folds: int = 5, order_by: str = "auc"):
        self.p = dict(locals())
        self.p.pop("self")
        if imp_type not in IMPORTANCE:
            raise ValueError(f"imp_type must be one of {IMPORTANCE}, not {imp_type!r}")
        if order_by not in ORDERS:
            raise ValueError(f"order_by must be one of {ORDERS}, not {order_by!r}")

    # ------------------------------------------------------------------
    def fit(self, df: DataFrame, target: str, features_type: Mapping | None = None,
            group_kf: str | None = None, max_bin_count: Mapping[str, int] | None = None,
            features_monotone_constraints: Mapping[str, str] | None = None,
            validation: DataFrame | None = None, features: Sequence[str] | None = None) -> M.ScorecardModel:
        p = self.p
        key = p["key"]
        declared = dict(features_type or {})
        if target in declared or (group_kf and group_kf in declared):
            raise ValueError("target / group column cannot be a feature")
        exclude = [key, target] + ([group_kf] if group_kf else [])
        if features is not None:
            df = df.select(*exclude, *features)
        # User exclusions (drop_features / never-used lists)
        df = df.drop(*[c for c in p["drop_features"] if c in df.columns and c not in exclude])
        # the (projected) input feeds type inference, folds and the training
        # frame: compute it once
        df_in = spread(df).persist()
        df = df_in
        n = df.count()
        th_const = W.resolve_threshold(p["th_const"], n)
        min_bin = W.resolve_threshold(p["min_bin_size"], n)
        art = FitArtifacts()

        _tick(art, 'start')
        # Types and date expansion (one aggregate)
        types = W.infer_types(df, target, declared, exclude=exclude)
        dfx, priv = W.expand_dates(df, types)
        feats = list(priv)
        # feature -> None (kept) or (reason code, measured value, other feature)
        history: dict[str, tuple | None] = {f: None for f in feats}

        _tick(art, 'types')
        # Folds (a column; no positional indices)
        dfx = assign_folds(dfx, p["n_folds"], key, target=None if group_kf else target, group=group_kf,
                           method=p["fold_method"])
        # the projected training frame feeds ~10 aggregate jobs: keep it
        # (MEMORY_AND_DISK; released at the end of fit)
        dfx = dfx.select(key, target, "fold", *feats).persist()
        # the row key is not needed once folds exist: keep the long form narrow
        long = W.to_long_mixed(dfx, priv, [target, "fold"])

        _tick(art, 'folds')
        # Constant / mostly-missing filter.  Categories and missing rows are counted
        # exactly; a real value that holds most rows is the middle one, so counting that
        # one is enough and no continuous value becomes a group
        vc = cut_lineage(W.value_counts(long.where(F.col("xr").isNull())))
        counted = {r["feature"]: r for r in W.profile_from_counts(vc).collect()}
        reals = [f for f in feats if priv[f] == "real"]
        if 2 * th_const < n:
            tops = W.middle_counts(dfx, reals)
        else:  # the limit is below half of the rows: any value may reach it
            tops = {r["feature"]: r["top_count"] for r in W.profile(long).collect()}
        prof = pd.DataFrame([(f, n, counted[f]["n_null"] if f in counted else 0,
                              tops.get(f, 0) if priv[f] == "real" else counted[f]["top_count"]) for f in feats],
                            columns=["feature", "n_rows", "n_null", "top_count"])
        for r in prof.itertuples():
            if r.n_null >= n - th_const:
                history[r.feature] = ("missing", r.n_null / n, None)
            elif r.top_count >= n - th_const:
                history[r.feature] = ("one_value", r.top_count / n, None)
        feats = [f for f in feats if history[f] is None]

        _tick(art, 'const')
        # L1/L2: importance filter (optional)
        if p["imp_type"] and feats:
            imp = S.fit_importance(dfx, [f for f in feats if priv[f] == "real"],
                                   [f for f in feats if priv[f] == "cat"], key, target, kind=p["imp_type"])
            keep = (set(imp.sort_values(ascending=False, kind="stable").index[:p["select_type"]])
                    if isinstance(p["select_type"], int) else set(imp.index[imp > p["imp_th"]]))
            for f in feats:
                if f not in keep:
                    history[f] = ("importance", float(imp[f]), None)
            feats = [f for f in feats if f in keep]
            art["importance"] = imp
            if not feats:
                raise ValueError("no feature passes the importance filter")
        ftypes = {f: priv[f] for f in feats}
        real_feats = [f for f in feats if ftypes[f] == "real"]
        cat_feats = [f for f in feats if ftypes[f] == "cat"]
        long = long.where(F.col("feature").isin(feats))

        _tick(art, 'importance')
        # Monotone constraints ('auto' -> sign(AUC - 0.5), one job)
        mono_in = dict(features_monotone_constraints or {})
        check = {"auto"} | ({"0", 0, None} if p["monotonic"] else set())
        need = [f for f in feats if ftypes[f] == "real" and mono_in.get(f) in check]
        mono: dict[str, int] = {}
        if need:
            a = auc(long.where(F.col("feature").isin(need)), target, "xr", by=["feature"]).toPandas()
            sgn = {r.feature: (0 if r.auc is None or np.isnan(r.auc) else int(np.sign(r.auc - 0.5)))
                   for r in a.itertuples()}
            mono.update(sgn)
        for f in feats:
            if ftypes[f] == "cat":
                mono[f] = 1
            elif f not in mono:
                v = mono_in.get(f)
                mono[f] = int(v) if v not in (None, "auto", "0", 0) else 0

        _tick(art, 'monotone')
        # Small categories and missing values
        pol, cats = W.fit_policy(long, ftypes, n, p["th_nan"], p["th_cat"], p["cat_merge_to"],
                                 p["nan_merge_to"], counts=vc.where(F.col("feature").isin(feats)))
        # only categorical features go through the long form; real ones are
        # binned and counted straight from the wide frame
        long_cat = W.to_long_mixed(dfx, {f: "cat" for f in cat_feats}, [target, "fold"]) if cat_feats else \
            long.where(F.lit(False))
        coded = W.apply_policy(long_cat, pol, cats).persist()
        art["policy"] = pol

        _tick(art, 'policy')
        # E8 + histogram (E10 input): real rows directly, cat rows via OOF encoding
        enc = W.mean_target_oof(coded, alpha=p["cat_alpha"], target=target)
        # (category, fold) rows, used by the histogram and the reverse map: cut
        # from lineage (reliable checkpoint) so later plans stay small
        enc = cut_lineage(enc)
        coded.count()
        _tick(art, 'bin_encode')
        cat_rows = enc.where(F.col("enc").isNotNull()).select(
            "feature", F.col("enc").alias("x"), "fold", F.col("n"), F.col("n1"))
        # Binning CV uses its own 3 seeds x 5 folds (hash folds, no shuffle)
        cvf = [f"cvf{i}" for i in range(p["cv_seeds"])]
        dcv = dfx.select(target, *real_feats, *[
            F.floor(md5_bucket(F.concat(F.col(key).cast("string"), F.lit(f"|cv{i}"))) * p["cv_folds"])
             .cast("int").alias(c) for i, c in enumerate(cvf)])
        hist_real = B.histogram_wide(dcv, real_feats, cvf, target)
        hist_cat = self._cat_histogram(cat_rows)
        hist = hist_real.unionByName(hist_cat, allowMissingColumns=True)
        mbc = {f: int((max_bin_count or {}).get(f, p["max_bin_count"])) for f in feats}
        single = {}
        if p["force_single_split"]:
            # When min_bin_size blocks every split but the non-dominant rows
            # exceed th_const, allow one split with a leaf of that size
            for r in prof.itertuples():
                small = int(r.n_rows - r.top_count)
                if r.feature in mbc and th_const < small < min_bin:
                    single[r.feature] = small
        _tick(art, 'bin_hist_edges')
        splits_df = B.tree_bins(hist, mbc, min_bin, p["min_bin_mults"], p["min_gains_to_split"], mono,
                                cv=p["cv_binning"], single_split=single)
        splits_pd = splits_df.toPandas()
        _tick(art, 'bin_tree')
        splits = {r.feature: [float(x) for x in r.splits] for r in splits_pd.itertuples()}
        for f in feats:
            splits.setdefault(f, [-np.inf])
        art["splits"] = splits
        sp = df.sparkSession
        sdf = sp.createDataFrame([(f, s) for f, s in splits.items()], "feature string, splits array<double>")

        _tick(art, 'binning')
        # Categories -> bins
        cat_map_pd = pd.DataFrame(columns=["feature", "code", "bin"])
        cat_map = None
        big_cat: dict[str, DataFrame] = {}
        if cat_feats:
            cat_map = cut_lineage(W.reverse_encode(enc, sdf.where(F.col("feature").isin(cat_feats))))
            sizes = {r["feature"]: r["count"] for r in cat_map.groupBy("feature").count().collect()}
            small_f = [f for f in cat_feats if sizes.get(f, 0) <= p["max_cat_literal"]]
            # only small maps reach the driver (they become map literals), of the others
            # just the bins of the special codes: both forms score alike
            codes = sorted({c for f in cat_feats for c in (pol[f].nan_key, pol[f].small_key)})
            cat_map_pd = cat_map.where(F.col("feature").isin(small_f) | F.col("code").isin(codes)).toPandas()
            for f in cat_feats:
                if f not in small_f:
                    big_cat[f] = cat_map.where(F.col("feature") == f).select("code", "bin")
        real_splits = sdf.where(F.col("feature").isin(real_feats))

        _tick(art, 'reverse')
        # WoE table (one aggregate) -> per-feature dicts
        binned = W.assign_bins(coded, None, cat_map) if cat_feats else None
        real_stats = W.real_bin_stats(dfx, {f: splits[f] for f in real_feats}, pol, target)
        table = W.woe_table(binned, p["woe_diff_th"], extra_stats=real_stats)
        art["woe_table"] = table
        bins = self._feature_bins(feats, ftypes, pol, splits, cat_map_pd, table, types)
        for f, t in big_cat.items():
            bins[f].cat_table = t
        model = M.ScorecardModel(bins, {}, 0.0, history=history)

        _tick(art, 'woe')
        # training WoE frame: a projection; out-of-fold WoE has one table of WoE values a fold
        if p["oof_woe"]:
            st = W.real_bin_stats(dfx, {f: splits[f] for f in real_feats}, pol, target, by=["fold"])
            if binned is not None:
                st = W.bin_stats(binned, by=["fold"], target=target).unionByName(st)
            per_fold = {}
            for k, t in W.oof_tables(st, "fold", p["woe_diff_th"]).items():
                fb = self._feature_bins(feats, ftypes, pol, splits, cat_map_pd, t, types)
                for f, big in big_cat.items():
                    fb[f].cat_table = big
                per_fold[k] = fb
            art["oof_bins"] = per_fold
            d = model.attach(dfx, feats, expanded=True)
            wide = d.select(key, target, "fold", *[
                F.coalesce(*[F.when(F.col("fold") == k, fb[f].expr(expanded=True)) for k, fb in per_fold.items()]).alias(f)
                for f in feats])
        else:
            wide = model.woe_columns(dfx.withColumnRenamed(target, "__y"), feats, expanded=True)
            wide = wide.select(key, F.col("__y").alias(target), "fold",
                               *[F.col(f"woe__{f}").alias(f) for f in feats])
        wide = wide.persist()

        _tick(art, 'wide')
        # Selection on WoE columns
        cand = list(feats)
        for f in S.const_woe(wide, cand):
            history[f] = ("constant_woe", 0.0, None)
        cand = [f for f in cand if history[f] is None]
        aucs = S.woe_aucs(wide, cand, target) if cand else pd.Series(dtype=float)
        for f in cand:
            if not aucs[f] >= p["auc_th"]:
                history[f] = ("auc", float(aucs[f]), None)
        cand = [f for f in cand if history[f] is None]
        if cand:
            corr = pd.DataFrame(np.abs(corr_matrix(wide, cand)), index=cand, columns=cand)
            cand, vif_drop = S.vif_filter(corr, cand, p["vif_th"])
            for f, v in vif_drop.items():
                history[f] = ("vif", v, None)
            # By AUC, or by information value (then only correlations above the limit count)
            rank = aucs if p["order_by"] == "auc" else table.groupby("feature")["iv"].first().astype(float)
            cand, cdrop = S.corr_filter(corr, rank, cand, p["pearson_th"], strict=p["order_by"] == "iv")
            for f, h in cdrop.items():
                history[f] = ("correlated", float(corr.loc[f, h]), h)
        if not cand:
            raise ValueError("no features left after selection")

        _tick(art, 'select')
        # L1 path over predefined folds (all C x folds fitted together)
        # distinct (WoE vector, fold) cells: small; every Newton iteration plans a
        # job over it, so give it a flat lineage
        comp = cut_lineage(M.compress(wide, cand, target, ["fold"]))
        folds = sorted(int(r[0]) for r in comp.select("fold").distinct().collect())
        path, fits = M.l1_path(comp, cand, folds, p["l1_base_step"], p["l1_exp_step"])
        best_c, keep, ctab = M.select_c(path, cand, p["interpreted_model"], p["auc_tol"])
        art["l1_path"] = ctab
        art["auc"] = aucs
        art["unconverged"] = sum(not f["converged"] for f in fits.values())
        for f in cand:
            if f not in keep:
                history[f] = ("l1_path", 0.0, None)

        _tick(art, 'l1path')
        # M1 / M2: refit
        if p["regularized_refit"]:
            w, b = M.refit_l1(comp, keep, best_c, p["l1_base_step"], p["l1_exp_step"],
                              p["interpreted_model"])
            pv = None
        else:
            vcomp = None
            if validation is not None:
                vw = model.woe_columns(validation, keep)
                vcomp = M.compress(vw.select(target, *[F.col(f"woe__{f}").alias(f) for f in keep]),
                                   keep, target, [])
            r = M.refit_backward(comp, keep, p["p_val"], p["interpreted_model"], vcomp)
            w, b, pv = r["weights"], r["intercept"], r["p_values"]
        for f in keep:
            if f not in w:
                history[f] = ("refit", 0.0, None)
        model.weights = dict(w)
        model.intercept = float(b)
        model.p_values = pv
        coded.unpersist()
        df_in.unpersist()
        dfx.unpersist()
        wide.unpersist()
        _tick(art, 'refit')
        self.artifacts = art
        return model

    # ------------------------------------------------------------------
    @staticmethod
    def _cat_histogram(cat_rows: DataFrame, max_bins: int = B.MAX_HIST_BINS) -> DataFrame:
        """Histogram of encoded categories: weights are the (category, fold) counts."""
        edges = B.quantile_edges(cat_rows, "x", max_bins)
        d = cat_rows.join(F.broadcast(edges), "feature")
        qbin = F.size(F.filter("edges", lambda e: e < F.col("x")))
        return (d.groupBy("feature", qbin.alias("qbin"), "fold")
                 .agg(F.sum("n").cast("bigint").alias("n"), F.sum("n1").cast("bigint").alias("n1"),
                      F.min("x").alias("lo"), F.max("x").alias("hi")))

    @staticmethod
    def _feature_bins(feats, ftypes, pol, splits, cat_map_pd, table, types) -> dict[str, M.FeatureBins]:
        out = {}
        for f in feats:
            t = table[table["feature"] == f]
            woe: dict = {}
            for r in t.itertuples():
                if r.spec is not None:
                    woe[r.spec] = float(r.woe)
                elif not pd.isna(r.bin):
                    woe[int(r.bin)] = float(r.woe)
            for k, v in pol[f].spec.items():
                if v is not None:
                    woe[k] = float(v)
            src, part = f, None
            if "__F__" in f:
                base, part = f.rsplit("__F__", 1)
                if isinstance(types.get(base), tuple):
                    src = base
                else:
                    part = None
            if ftypes[f] == "cat":
                cm = cat_map_pd[cat_map_pd["feature"] == f]
                cat_bins = {str(r.code): int(r.bin) for r in cm.itertuples()}
                out[f] = M.FeatureBins(f, "cat", [], cat_bins, woe, pol[f].nan_key, pol[f].small_key, src, part)
            else:
                out[f] = M.FeatureBins(f, "real", list(splits[f]), {}, woe, pol[f].nan_key, None, src, part)
        return out
