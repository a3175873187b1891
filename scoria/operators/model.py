"""Logistic scorecard fitting, scoring and SQL export.

Fitting strategy at scale
-------------------------
WoE columns are discrete, so rows are first compressed to distinct
``(woe vector, fold)`` with event / non-event counts (``compress``) — one
aggregate whose output is bounded by the bin combinations, not by rows.
All models of a path (every C x every held-out fold) are then fitted
*together* by Newton / IRLS: each iteration is ONE Spark job computing, per
model, the gradient and Hessian over its training rows; the L1 step is
coordinate descent on those matrices on the driver.  Frames so wide that the
Hessians of all models pass ``STATS_BUDGET`` numbers go along the path with
warm starts, and a job computes the Hessian among each model's working set
only; KKT conditions on all columns decide when the set is whole.
The Hessian at the optimum gives the Wald variances for free.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoria.session import small_side

__all__ = ["compress", "glm_fit", "l1_min_c", "l1_path", "select_c", "refit_l1",
           "refit_backward", "wald_pvalues", "ScorecardModel", "FeatureBins"]

#: Numbers that a job of statistics takes from each task at most (unless one model needs more).
STATS_BUDGET = 1_000_000


def compress(df: DataFrame, features: Sequence[str], label: str = "target",
             extra: Sequence[str] = ("fold",)) -> DataFrame:
    """Distinct feature vectors with counts: ``(features..., extra..., n, n1)``."""
    y = F.col(label).cast("double")
    return df.groupBy(*features, *extra).agg(F.count(F.lit(1)).cast("double").alias("n"),
                                             F.sum(y).alias("n1"))


# ------------------------------------------------------------------ distributed Newton statistics

def _stats_job(comp: DataFrame, features: Sequence[str], models: list[dict]) -> dict[int, tuple]:
    """One Spark job: per model m, over the rows it trains on (x with a trailing 1 for the intercept),
    ``H = sum w p(1-p) x x'`` among its working columns ``m["work"]`` and ``g = sum (y - n p) x`` of all columns."""
    feats = list(features)
    k = len(feats) + 1
    spec = [(m["id"], np.asarray(m["work"], int), np.asarray(m["beta"], float)[m["work"]], m.get("exclude_fold")) for m in models]
    has_fold = "fold" in comp.columns
    cols = feats + (["fold"] if has_fold else []) + ["n", "n1"]

    def part(it):
        acc = {mid: (np.zeros((len(work), len(work))), np.zeros(k)) for mid, work, _, _ in spec}
        for pdf in it:
            if pdf.empty:
                continue
            X = np.column_stack([pdf[feats].to_numpy(float), np.ones(len(pdf))])
            n = pdf["n"].to_numpy(float)
            n1 = pdf["n1"].to_numpy(float)
            fold = pdf["fold"].to_numpy() if has_fold else None
            for mid, work, beta, ex in spec:
                mask = np.ones(len(pdf), bool) if (ex is None or fold is None) else (fold != ex)
                if not mask.any():
                    continue
                Xw = X[np.ix_(mask, work)]
                p = 1.0 / (1.0 + np.exp(-(Xw @ beta)))
                w = n[mask] * p * (1 - p)
                H, g = acc[mid]
                H += (Xw * w[:, None]).T @ Xw
                g += (n1[mask] - n[mask] * p) @ X[mask]
        # the lower half of H, then g
        rows = [(mid, np.concatenate([H[np.tril_indices(len(H))], g]).tolist()) for mid, (H, g) in acc.items()]
        yield pd.DataFrame(rows, columns=["model", "s"])

    parts = comp.select(*cols).mapInPandas(part, "model int, s array<double>")
    red = (parts.select("model", F.posexplode("s").alias("i", "v"))
                .groupBy("model", "i").agg(F.sum("v").alias("v")).toArrow().sort_by([("model", "ascending"), ("i", "ascending")]))
    ids, v = red["model"].to_numpy(), red["v"].to_numpy()
    out = {}
    for mid, work, _, _ in spec:
        own = v[np.searchsorted(ids, mid):np.searchsorted(ids, mid, "right")]
        if len(own):
            H = np.zeros((len(work), len(work)))
            H[np.tril_indices(len(work))] = own[:len(own) - k]
            out[mid] = (H + np.tril(H, -1).T, own[len(own) - k:])
    return out


def _stats(comp: DataFrame, features: Sequence[str], models: list[dict], budget: int) -> dict[int, tuple]:
    """``_stats_job`` over models taken together up to ``budget`` numbers a job (or one model)."""
    out: dict[int, tuple] = {}
    some, size = [], 0
    for m in models:
        more = _n_stats(len(m["work"]), len(features) + 1)
        if some and size + more > budget:
            out.update(_stats_job(comp, features, some))
            some, size = [], 0
        some.append(m)
        size += more
    return {**out, **(_stats_job(comp, features, some) if some else {})}


def _n_stats(work: int, k: int) -> int:
    """Numbers that a model with ``work`` of ``k`` columns at work takes from a job."""
    return work * (work + 1) // 2 + k


def _cd_step(H: np.ndarray, g: np.ndarray, beta: np.ndarray, lam: float, nonpos: bool = False,
             iters: int = 10_000, tol: float = 1e-10) -> tuple[np.ndarray, bool]:
    """Minimise the quadratic model  -g'd + d'Hd/2 + lam*|beta+d|_1 (intercept unpenalised)
    by coordinate descent; returns the new beta and whether it settled."""
    k = len(beta)
    b = beta.copy()
    left = g.copy()  # g - H (b - beta), kept up to date
    for _ in range(iters):
        mx = 0.0
        for j in range(k):
            hjj = H[j, j]
            if hjj <= 0:
                continue
            nb = b[j] + left[j] / hjj
            if j < k - 1 and lam > 0:
                nb = math.copysign(max(abs(nb) - lam / hjj, 0.0), nb)
            if nonpos and j < k - 1:
                nb = min(nb, 0.0)
            d = nb - b[j]
            if d != 0:
                left -= H[j] * d
                b[j] = nb
                mx = max(mx, abs(d))
        if mx < tol:
            return b, True
    return b, False


def glm_fit(comp: DataFrame, features: Sequence[str], models: list[dict], max_iter: int = 100,
            tol: float = 1e-7, budget: int = STATS_BUDGET) -> dict[int, dict]:
    """Fit many L1/unpenalised logistic models at once.

    ``models``: dicts with ``id``, ``lam`` (L1 weight = 1/C; 0 = none) and
    optional ``exclude_fold`` and ``active`` (features that may enter, by
    number).  Returns per id: ``beta`` (coefs..., intercept), ``H`` (Hessian at
    the solution of unpenalised fits, else None), ``iters`` and ``converged``.
    A step is halved while it grows (separable data); fits that have not
    settled after ``max_iter`` steps are flagged and warned about, never passed
    silently.

    A job takes at most ``budget`` numbers from each task (or one model's).
    Where the Hessians of all models fit, all are fitted together over all
    columns.  Else the penalised ones go from the strongest penalty to the
    weakest, the models of one penalty together: each starts from the fit of
    the penalty before, over a working set of that fit's support and the
    columns whose gradient there passes the new penalty.  The gradient of
    every column comes with each job, so that a fit is checked by the KKT
    conditions as it settles; columns that break them join the working set
    and the fit goes on.  Both ways end in the same optimum.
    """
    k = len(features) + 1
    every = {m["id"]: np.arange(k) if m.get("active") is None else np.append(np.asarray(m["active"], int), k - 1) for m in models}
    state = {m["id"]: dict(m, beta=np.zeros(k), work=every[m["id"]], done=False, converged=False, iters=0) for m in models}
    ms = list(state.values())
    if sum(_n_stats(len(m["work"]), k) for m in ms) <= budget:
        waves = [ms]
    else:
        waves = [[m for m in ms if m["lam"] == lam] for lam in sorted({m["lam"] for m in ms if m["lam"] > 0}, reverse=True)]
        waves += [[m] for m in ms if m["lam"] == 0]
    before: dict = {}
    for wave in waves:
        for m in wave if wave is not ms else []:
            if m["lam"] > 0:
                last = before.get((m.get("exclude_fold"), tuple(every[m["id"]])))
                m["work"] = np.array([k - 1])
                if last is not None:
                    m["beta"] = last["beta"].copy()
                    enter = (np.abs(last["g"]) > m["lam"]) | (m["beta"] != 0)
                    m["work"] = np.append([j for j in every[m["id"]][:-1] if enter[j]], k - 1).astype(int)
        _newton(comp, features, wave, every, max_iter, tol, budget)
        before.update({(m.get("exclude_fold"), tuple(every[m["id"]])): m for m in wave if m["lam"] > 0 and "g" in m})
    late = [m["id"] for m in ms if not m["converged"]]
    if late:
        warnings.warn(f"{len(late)} of {len(ms)} logistic fits did not converge in {max_iter} steps", RuntimeWarning, stacklevel=2)
    # Hessian at the final beta (for Wald variances)
    free = [dict(m, work=np.arange(k)) for m in ms if m["lam"] == 0]
    fin = _stats(comp, features, free, budget)
    return {mid: {"beta": m["beta"], "H": fin[mid][0] if mid in fin else None, "iters": m["iters"],
                  "converged": m["converged"]} for mid, m in state.items()}


def _newton(comp: DataFrame, features: Sequence[str], models: list[dict], every: dict, max_iter: int, tol: float, budget: int) -> None:
    """Newton steps of ``models``, one batch of jobs a step, until each is settled and no column outside its
    working set breaks the KKT conditions."""
    while True:
        going = [m for m in models if not m["done"]]
        if not going:
            return
        st = _stats(comp, features, going, budget)
        for m in going:
            if m["id"] not in st:
                m["done"] = True
                continue
            H, m["g"] = st[m["id"]]
            idx = m["work"]
            Hs = H + 1e-10 * np.eye(len(idx))
            gs, bs = m["g"][idx], m["beta"][idx]
            settled = True
            if m["lam"] > 0:
                ns, settled = _cd_step(Hs, gs, bs, m["lam"])
            else:
                try:
                    ns = bs + np.linalg.solve(Hs, gs)
                except np.linalg.LinAlgError:
                    ns = bs + np.linalg.lstsq(Hs, gs, rcond=None)[0]
            nb = np.zeros(len(m["beta"]))
            nb[idx] = ns
            step = float(np.max(np.abs(nb - m["beta"])))
            if m["iters"] > 2 and step > 2 * m["step"]:
                nb = m["beta"] + (nb - m["beta"]) / 2
            m["beta"], m["step"] = nb, step
            m["iters"] += 1
            out = np.setdiff1d(every[m["id"]], idx) if step < 1e-2 else idx[:0]
            out = out[np.abs(m["g"][out]) > m["lam"] * (1 + 1e-6)]
            if len(out):
                m["work"], m["iters"] = np.union1d(idx, out), 0
            elif step < tol and settled:
                m["done"] = m["converged"] = True
            elif m["iters"] >= max_iter:
                m["done"] = True


def l1_min_c(comp: DataFrame, features: Sequence[str]) -> float:
    """Smallest C with a non-empty L1 model: ``2 / max_j |sum_i y_i x_ij|``, y in {-1,+1},
    intercept column included (log loss)."""
    ypm = F.col("n1") - (F.col("n") - F.col("n1"))  # sum over the row group of (+1/-1)
    aggs = [F.abs(F.sum(ypm * F.col(f))).alias(f) for f in features] + [F.abs(F.sum(ypm)).alias("_b")]
    r = comp.agg(*aggs).first()
    den = max(float(v or 0.0) for v in r)
    return 2.0 / den if den > 0 else 1.0


def l1_path(comp: DataFrame, features: Sequence[str], folds: Sequence[int], l1_base_step: int = 20,
            l1_exp_step: float = 4.0, cs: Sequence[float] | None = None) -> tuple[pd.DataFrame, dict]:
    """Fit the L1 path for every C and held-out fold in one batch of jobs;
    score each (C, fold) by AUC on the held-out fold.

    Returns (table with C, fold, auc, coefs per feature, intercept), fits.
    """
    from scoria.operators.metrics import auc as auc_op
    if cs is None:
        cs = l1_min_c(comp, features) * np.logspace(0, l1_exp_step, l1_base_step)
    models, meta = [], {}
    mid = 0
    for ci, c in enumerate(cs):
        for f in folds:
            models.append({"id": mid, "lam": 1.0 / c, "exclude_fold": f})
            meta[mid] = (ci, float(c), f)
            mid += 1
    fits = glm_fit(comp, features, models)
    rows = []
    for m, fit in fits.items():
        ci, c, f = meta[m]
        rows.append([m, ci, c, f, *fit["beta"].tolist(), fit["converged"]])
    coef = pd.DataFrame(rows, columns=["model", "ci", "C", "fold", *features, "intercept", "converged"])
    spark = comp.sparkSession
    # a dot product over arrays: the plan is as small for thousands of features as for ten
    cdf = spark.createDataFrame([(r[0], r[3], fits[r[0]]["beta"].tolist()) for r in rows], "model int, fold int, __w array<double>")
    # held-out scoring: each compressed row meets the models of its own fold
    # (len(cs) models per fold — a small broadcast table)
    j = comp.join(F.broadcast(cdf), "fold")
    terms = F.zip_with(F.array(*[F.col(f).cast("double") for f in features]), F.slice("__w", 1, len(features)), lambda x, w: x * w)
    score = F.aggregate(terms, F.element_at("__w", -1), lambda acc, x: acc + x)
    sc = j.select("model", score.alias("score"), "n", "n1")
    counts = sc.groupBy("model", "score").agg(F.sum("n1").cast("bigint").alias("pos"),
                                              F.sum(F.col("n") - F.col("n1")).cast("bigint").alias("neg"))
    a = auc_op(counts, "target", "score", by=["model"], counts=True).select("model", "auc").toPandas()
    coef = coef.merge(a, on="model", how="left")
    return coef, fits


def select_c(path: pd.DataFrame, features: Sequence[str], interpreted: bool = True,
             auc_tol: float = 1e-4) -> tuple[float, list[str], pd.DataFrame]:
    """L8 rule: mean AUC per C; candidates = C with all fold coefficients <= 0
    (interpretable); pick the smallest C whose score >= max - auc_tol
    (fallback: the last candidate); keep features whose min coefficient over
    folds is != 0."""
    g = path.groupby(["ci", "C"])
    res = []
    for (ci, c), d in g:
        w = d[list(features)].to_numpy()
        res.append({"ci": ci, "C": c, "score": float(d["auc"].mean()),
                    "is_neg": bool((w <= 0).all()) if interpreted else True,
                    "min_w": w.min(axis=0)})
    res.sort(key=lambda r: r["ci"])
    tab = pd.DataFrame([{k: v for k, v in r.items() if k != "min_w"} for r in res])
    neg = [r for r in res if r["is_neg"]]
    if not neg:
        raise ValueError("no C on the path gives all non-positive coefficients")
    ok = max(r["score"] for r in res) - auc_tol
    pick = next((r for r in neg if r["score"] >= ok), neg[-1])
    keep = [f for f, w in zip(features, pick["min_w"]) if w != 0]
    return pick["C"], keep, tab


def refit_l1(comp: DataFrame, features: Sequence[str], max_c: float, l1_base_step: int = 20,
             l1_exp_step: float = 4.0, interpreted: bool = True) -> tuple[dict[str, float], float]:
    """M1: L1 path on all rows up to ``max_c``; interpretable -> the strongest C
    on the path whose weights are all <= 0; zero weights dropped."""
    cs = l1_min_c(comp, features) * np.logspace(0, l1_exp_step, l1_base_step)
    cs = np.append(cs[cs < max_c], max_c)
    fits = glm_fit(comp, features, [{"id": i, "lam": 1.0 / c} for i, c in enumerate(cs)])
    path = pd.DataFrame([fits[i]["beta"] for i in range(len(cs))], columns=[*features, "_b"])
    allowed = path[(path[list(features)] <= 0).all(axis=1)] if interpreted else path
    if allowed.empty:
        raise ValueError("no negative weights on the path")
    best = allowed.iloc[-1]  # rows stand by rising C
    weights = best[list(features)]
    return weights[weights != 0].astype(float).to_dict(), float(best["_b"])


def wald_pvalues(H: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """M3: var = diag(H^-1); p = P(chi2_1 > beta^2/var) = erfc(|z|/sqrt 2).  Order: coefs, intercept."""
    var = np.diag(np.linalg.inv(H))
    z2 = beta ** 2 / var
    p = np.array([math.erfc(math.sqrt(max(w, 0.0) / 2.0)) for w in z2])
    return p, var


def refit_backward(comp: DataFrame, features: Sequence[str], p_val: float = 0.05,
                   interpreted: bool = True, valid: DataFrame | None = None) -> dict:
    """M2: unpenalised refit; while any coef >= 0 drop the largest; then while
    the max p-value > p_val drop it; optionally repeat the p-value test on a
    validation sample refitted there (M4)."""
    def tested(sample, feats):
        fit = glm_fit(sample, feats, [{"id": 0, "lam": 0.0}])[0]
        p, var = wald_pvalues(fit["H"], fit["beta"])
        names = [*feats, "Intercept_"]
        return pd.DataFrame({"beta": fit["beta"], "p": p, "var": var}, index=names)

    def worst(train, held) -> str | None:
        """The term to leave out next: a wrong sign first, then a p-value on train, then on the held sample."""
        rules = [(train["beta"], 0.0 if interpreted else math.inf, np.greater_equal), (train["p"], p_val, np.greater)]
        if held is not None:
            rules.append((held()["p"], p_val, np.greater))
        for value, limit, over in rules:
            value = value.drop("Intercept_")
            if over(value.max(), limit):
                return value.idxmax()
        return None

    feats = list(features)
    while feats:
        train = tested(comp, feats)
        out = worst(train, None) or (worst(train, lambda: tested(valid, feats)) if valid is not None else None)
        if out is None:
            return {"weights": train["beta"].drop("Intercept_").to_dict(), "intercept": float(train["beta"]["Intercept_"]),
                    "p_values": train["p"].to_dict(), "variances": train["var"].to_dict(),
                    "p_values_valid": tested(valid, feats)["p"].to_dict() if valid is not None else None}
        feats.remove(out)
    raise ValueError("no features left to fit")


# ------------------------------------------------------------------ the model object (M6, M7)

@dataclass
class FeatureBins:
    name: str
    ftype: str                               # real | cat
    splits: list[float] = field(default_factory=list)
    cat_bins: dict[str, int] = field(default_factory=dict)
    woe: dict = field(default_factory=dict)  # int bin or special code -> WoE
    nan_key: str = "__NaN__"
    small_key: str | None = None
    source: str | None = None                # raw column (dates: the date column)
    date_part: str | None = None
    cat_table: DataFrame | None = None       # (code, bin) kept distributed for many categories;
    # cat_bins then only holds the bins of the special codes

    @property
    def bin_col(self) -> str:
        return f"__bin__{self.name}"

    def special_woe(self, code: str | None) -> float:
        """WoE of a special code: its own, else that of the bin it was put in, else neutral."""
        v = self.woe.get(code) if code in self.woe else self.woe.get(self.cat_bins.get(code))
        return 0.0 if v is None or math.isnan(v) else float(v)

    def expr(self, col=None, expanded: bool = False):
        """WoE column; ``expanded`` = the frame already holds ``name`` (date parts expanded).
        Table-backed categorical features read the bin attached by ``attach``."""
        from scoria.operators.woe import woe_expr
        from scoria.functions.exprs import date_parts, is_missing
        if self.cat_table is not None:
            raw = F.col(self.name if expanded else (col or self.source or self.name))
            b = F.col(self.bin_col)
            e = F.when(is_missing(raw), F.lit(self.special_woe(self.nan_key)))
            for k, v in sorted((k, v) for k, v in self.woe.items() if isinstance(k, int)):
                e = e.when(b == F.lit(k), F.lit(float(v)))
            return e.otherwise(F.lit(self.special_woe(self.small_key)))
        if expanded:
            c = F.col(self.name)
        else:
            c = F.col(col or self.source or self.name)
            if self.date_part is not None:
                c = date_parts(c, "_", [self.date_part])[0]
        return woe_expr(c, self.ftype, self.splits, self.cat_bins, self.woe, self.nan_key, self.small_key)


@dataclass
class ScorecardModel:
    bins: dict[str, FeatureBins]
    weights: dict[str, float]
    intercept: float
    p_values: dict[str, float] | None = None
    history: dict[str, str] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return list(self.weights)

    def attach(self, df: DataFrame, features: Sequence[str] | None = None, expanded: bool = False) -> DataFrame:
        """Left-join the category -> bin tables of high-cardinality features
        (the only case where scoring is not a pure projection).  A table whose
        counted rows are few is broadcast: AQE would learn its size only after
        the scored rows are shuffled."""
        for f in list(features or self.features):
            fb = self.bins[f]
            if fb.cat_table is None:
                continue
            src = fb.name if expanded else (fb.source or fb.name)
            t = fb.cat_table.select(F.col("code").alias(f"__code__{f}"), F.col("bin").alias(fb.bin_col))
            df = df.join(small_side(t), F.col(src).cast("string") == F.col(f"__code__{f}"), "left").drop(f"__code__{f}")
        return df

    def _detach(self, df: DataFrame) -> DataFrame:
        return df.drop(*[b.bin_col for b in self.bins.values() if b.cat_table is not None])

    def woe_columns(self, df: DataFrame, features: Sequence[str] | None = None,
                    expanded: bool = False) -> DataFrame:
        """One WoE column per feature — a projection (plus a join only for
        table-backed high-cardinality categoricals)."""
        feats = list(features or self.features)
        d = self.attach(df, feats, expanded)
        return self._detach(d.select("*", *[self.bins[f].expr(expanded=expanded).alias(f"woe__{f}")
                                            for f in feats]))

    def linear(self):
        """Linear score column (requires ``attach`` first for table-backed features)."""
        z = F.lit(float(self.intercept))
        for f, w in self.weights.items():
            z = z + F.lit(float(w)) * self.bins[f].expr()
        return z

    def transform(self, df: DataFrame, prob: str = "prob") -> DataFrame:
        """M6: probability as plain column expressions."""
        d = self.attach(df)
        return self._detach(d.withColumn(prob, F.lit(1.0) / (F.lit(1.0) + F.exp(-self.linear()))))

    def to_sql(self, table: str, keep: Sequence[str] = (), digits: int = 6, dialect: str = "spark",
               maps: Mapping[str, str] | None = None) -> str:
        """M7: SQL text: normalise -> WoE CASE -> logistic.

        ``dialect="spark"`` quotes identifiers with backticks, ``"ansi"`` with
        double quotes (DuckDB, most databases); everything else is shared.
        Table-backed categorical features need ``maps={feature: table}``
        naming a (code, bin) table in the target database, which is joined
        once; of a code that it repeats, the largest bin counts.
        """
        maps = dict(maps or {})
        for f in self.features:
            if self.bins[f].cat_table is not None and f not in maps:
                raise ValueError(f"feature {f} keeps its categories in a table: pass maps={{'{f}': ...}}")
        def q(s):
            if dialect == "spark":
                return "`" + s.replace("`", "``") + "`"
            return '"' + s.replace('"', '""') + '"'

        def lit(v):
            return repr(round(float(v), digits))

        def sql_double(v):
            return f"CAST('{float(v)!r}' AS DOUBLE)"

        def w(fb, key):
            v = fb.woe.get(key)
            return lit(0.0 if v is None or (isinstance(v, float) and math.isnan(v)) else v)

        cases, joins = [], []
        for f in self.features:
            fb = self.bins[f]
            src = "i." + q(fb.source or fb.name)
            if fb.date_part is not None:
                part = {"y": "year", "m": "month", "d": "day", "h": "hour", "min": "minute"}
                wd = (f"weekday(CAST({src} AS DATE))" if dialect == "spark"
                      else f"(isodow(CAST({src} AS DATE)) - 1)")
                src = wd if fb.date_part == "wd" else f"{part[fb.date_part]}(CAST({src} AS DATE))"
            text = f"CAST({src} AS {'STRING' if dialect == 'spark' else 'VARCHAR'})"
            gone = f"WHEN {src} IS NULL OR lower({text}) = 'nan' THEN {lit(fb.special_woe(fb.nan_key))}"
            if fb.ftype == "real":
                # thresholds are written exactly: rounding one would move rows to another bin
                x = f"TRY_CAST({src} AS DOUBLE)"
                parts = [f"WHEN {x} IS NULL OR lower({text}) = 'nan' THEN {w(fb, fb.nan_key)}"]
                parts += [f"WHEN {x} <= {sql_double(s)} THEN {w(fb, i)}" for i, s in enumerate(fb.splits)]
                parts.append(f"ELSE {w(fb, len(fb.splits))}")
            elif fb.cat_table is not None:
                b = f"m{len(joins)}.bin"
                joins.append(f" LEFT JOIN (SELECT code, max(bin) AS bin FROM {maps[f]} GROUP BY code) m{len(joins)}"
                             f" ON m{len(joins)}.code = {text}")
                parts = [gone] + [f"WHEN {b} = {k} THEN {w(fb, k)}" for k in sorted(k for k in fb.woe if isinstance(k, int))]
                parts.append(f"ELSE {lit(fb.special_woe(fb.small_key))}")
            else:
                quoted = lambda k: "'" + k.replace("'", "''") + "'"
                by_bin: dict = {}
                for k, b in sorted(fb.cat_bins.items()):
                    by_bin.setdefault(b, []).append(quoted(k))
                parts = [gone] + [f"WHEN {text} IN ({', '.join(codes)}) THEN {w(fb, b)}" for b, codes in by_bin.items()]
                parts.append(f"ELSE {lit(fb.special_woe(fb.small_key))}")
            cases.append(f"CASE {' '.join(parts)} END AS {q(f)}")
        z = " + ".join([lit(self.intercept)] + [f"{lit(wt)} * {q(f)}" for f, wt in self.weights.items()])
        keep_in = ", ".join(f"i.{q(c)}" for c in keep)
        keep_out = ", ".join(f"t.{q(c)}" for c in keep)
        inner = ", ".join(([keep_in] if keep_in else []) + cases)
        sel = (keep_out + ", " if keep_out else "") + f"1 / (1 + exp(-({z}))) AS prob"
        return f"SELECT {sel} FROM (SELECT {inner} FROM {table} i{''.join(joins)}) t"

    def scorecard(self) -> pd.DataFrame:
        """Variable, value label, WoE, coefficient, points = WoE * coef; intercept first."""
        from scoria.functions.exprs import interval_label
        rows = [("Intercept", "", None, self.intercept, self.intercept)]
        for f, wt in self.weights.items():
            fb = self.bins[f]
            if fb.ftype == "real":
                s = fb.splits
                for i in range(len(s) + 1):
                    lo = s[i - 1] if i > 0 else None
                    hi = s[i] if i < len(s) else None
                    v = fb.woe.get(i, 0.0)
                    rows.append((f, interval_label(lo, hi, f), v, wt, v * wt))
            elif fb.cat_table is not None:
                for b in sorted(k for k in fb.woe if isinstance(k, int)):
                    v = fb.woe[b]
                    rows.append((f, f"bin {b} (categories in table)", v, wt, v * wt))
            else:
                by_bin: dict[int, list[str]] = {}
                for k, b in fb.cat_bins.items():
                    by_bin.setdefault(b, []).append(k)
                for b in sorted(by_bin):
                    v = fb.woe.get(b, 0.0)
                    rows.append((f, ", ".join(sorted(by_bin[b])), v, wt, v * wt))
            for k, v in fb.woe.items():
                if isinstance(k, str):
                    rows.append((f, k, v, wt, (v or 0.0) * wt))
        return pd.DataFrame(rows, columns=["variable", "value", "woe", "coef", "points"])

    def to_dict(self) -> dict:
        return {"features": {f: {"f_type": b.ftype, "splits": b.splits, "cat_map": b.cat_bins,
                                 "cod_dict": {str(k): v for k, v in b.woe.items()},
                                 "weight": self.weights[f], "nan_value": b.nan_key}
                             for f, b in self.bins.items() if f in self.weights},
                "intercept": self.intercept}
