"""Feature selection.

Statistics come from Spark in one job each (AUC per feature, a k x k
correlation matrix); the greedy rules then walk those small tables on the
driver.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoria.functions.exprs import md5_bucket
from scoria.operators.metrics import auc, score_counts
from scoria.session import cut_lineage, free_shuffles, small_side

__all__ = ["woe_aucs", "const_woe", "auc_filter", "vif_filter", "corr_filter", "topk",
           "encode_categories", "fit_importance", "tree_importance", "permutation_importance", "history_table", "rank_weights"]


def woe_aucs(woe_df: DataFrame, features: Sequence[str], target: str = "target") -> pd.Series:
    """1 - AUC(target, woe) for every WoE column, one job (long form)."""
    long = woe_df.select(target, *features).unpivot([target], list(features), "feature", "w")
    a = auc(long, target, "w", by=["feature"]).toPandas()
    return pd.Series((1 - a["auc"]).to_numpy(), index=a["feature"]).reindex(list(features))


def const_woe(woe_df: DataFrame, features: Sequence[str]) -> list[str]:
    """L3: WoE columns with a single value (stddev 0) — one aggregate."""
    r = woe_df.agg(*[F.stddev_pop(f).alias(f) for f in features]).first()
    return [f for f in features if not r[f] or r[f] == 0]


def auc_filter(aucs: pd.Series, auc_th: float) -> list[str]:
    """L4: keep features with 1 - AUC >= auc_th."""
    return [f for f, v in aucs.items() if v >= auc_th]


def vif_filter(corr: pd.DataFrame, candidates: Sequence[str], vif_th: float = 5.0,
               ridge: float = 1e-4) -> tuple[list[str], dict[str, float]]:
    """Drop the max-VIF feature while max VIF >= vif_th (|corr| + ridge*I)."""
    names = np.array(list(candidates), dtype=object)
    dropped: dict[str, float] = {}
    if not len(names):
        return [], dropped
    # the diagonal of the inverse holds the VIFs; leaving a feature out is a rank-one update of the inverse
    inverse = np.linalg.inv(corr.loc[names, names].abs().to_numpy() + ridge * np.eye(len(names)))
    alive = np.ones(len(names), bool)
    for _ in range(len(names) - 1):
        vif = np.where(alive, inverse.diagonal(), -np.inf)
        i = int(vif.argmax())
        if vif[i] < vif_th:
            break
        dropped[names[i]] = float(vif[i])
        alive[i] = False
        inverse = inverse - np.outer(inverse[:, i], inverse[i]) / inverse[i, i]
    return names[alive].tolist(), dropped


def corr_filter(corr: pd.DataFrame, order_by: pd.Series, candidates: Sequence[str], th: float = 0.9,
                strict: bool = False) -> tuple[list[str], dict[str, str]]:
    """Walk features by ``order_by`` desc; drop later ones whose |corr| with
    the current one is >= th (> th when ``strict``)."""
    names = sorted(candidates, key=lambda f: (-order_by[f], f))
    c = corr.loc[names, names].abs().to_numpy()
    i, j = np.nonzero(np.triu(c > th if strict else c >= th, 1))
    dropped: dict[str, str] = {}
    for a, b in zip(i.tolist(), j.tolist()):  # pairs over the limit, by rank of the better feature
        if names[a] not in dropped:
            dropped.setdefault(names[b], names[a])
    return [f for f in names if f not in dropped], dropped


def topk(scores: DataFrame, k: int | None, by: str = "imp", th: float = 0.0, name: str = "feature") -> DataFrame:
    """Top-k by score (ties by name), or everything above a threshold."""
    if k is None:
        return scores.where(F.col(by) > th)
    w = Window.orderBy(F.desc(by), F.asc(name))  # one row per feature: a small table
    return scores.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def _assemble(df: DataFrame, features: Sequence[str], out: str = "features"):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def encode_categories(df: DataFrame, cat: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Every categorical column replaced by its frequency encoding, whatever its width.

    The category tables stay distributed; a table is broadcast when its
    counted rows are few, else joined by Spark.  Missing stays missing.
    """
    from scoria.operators.woe import freq_encode, to_long_mixed
    if not cat:
        return df
    codes = cut_lineage(freq_encode(to_long_mixed(df if fit_on is None else fit_on, {c: "cat" for c in cat}, [])))
    for c in cat:
        own = small_side(codes.where(F.col("feature") == c).select(F.col("xc").alias("__xc"), F.col("freq").alias("__f")))
        df = df.join(own, F.col(c).cast("string") == F.col("__xc"), "left").withColumn(c, F.col("__f")).drop("__xc", "__f")
    return df


def _gbt(df: DataFrame, features: Sequence[str], target: str, held: str, max_iter: int, max_depth: int, seed: int):
    """Boosted trees on the rows that are not held out; the held rows end the boosting."""
    from pyspark.ml.classification import GBTClassifier
    return GBTClassifier(labelCol=target, featuresCol="features", validationIndicatorCol=held, maxIter=max_iter,
                         maxDepth=max_depth, seed=seed, maxBins=128, checkpointInterval=10).fit(df)


def _ready(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return _assemble(df.fillna(-1e30, list(features)), features)


def fit_importance(df: DataFrame, real: Sequence[str], cat: Sequence[str], key: str, target: str = "target",
                   kind: str = "feature_imp", max_iter: int = 20, max_depth: int = 5, hold_out: float = 0.2,
                   n_iter: int = 5, seed: int = 42) -> pd.Series:
    """L1/L2/P5: importance of each feature from boosted trees (MLlib GBT) with a hold-out by md5 of the key.

    ``feature_imp``: number of splits on the feature.  ``perm_imp``: least
    drop of the hold-out AUC over ``n_iter`` shuffles of the feature.
    Categories of any width enter by their frequency encoding.
    """
    features = list(real) + list(cat)
    held = md5_bucket(F.concat(F.col(key).cast("string"), F.lit("|imp"))) < hold_out
    d = encode_categories(df.select(key, target, *[F.col(f).cast("double").alias(f) for f in real], *cat), cat)
    d = d.withColumn("__held", held).persist()
    m = _gbt(_ready(d, features), features, target, "__held", max_iter, max_depth, seed)
    if kind == "feature_imp":
        splits = pd.Series(re.findall(r"If \(feature (\d+) ", m.toDebugString), dtype=int).value_counts()
        out = pd.Series([float(splits.get(i, 0)) for i in range(len(features))], index=features)
    elif kind == "perm_imp":
        from pyspark.ml.functions import vector_to_array

        def score(x: DataFrame) -> DataFrame:
            return m.transform(_ready(x, features)).withColumn("score", vector_to_array("probability")[1])

        out = permutation_importance(d.where("__held").drop("__held"), score, features, key, target, n_iter)
    else:
        raise ValueError(f"unknown importance {kind!r}")
    d.unpersist()
    return out


def tree_importance(df: DataFrame, real: Sequence[str], cat: Sequence[str], target: str = "target", key: str = "k",
                    max_iter: int = 20, max_depth: int = 5, seed: int = 42) -> pd.Series:
    """L1: split counts of boosted trees."""
    return fit_importance(df, real, cat, key, target, "feature_imp", max_iter, max_depth, seed=seed)


def permutation_importance(scored: DataFrame, score: Callable[[DataFrame], DataFrame], features: Sequence[str], key: str,
                           target: str = "target", n_iter: int = 5, reduce: str = "min",
                           tiebreak: Sequence[str] = ()) -> pd.Series:
    """L2: AUC drop when one column is shuffled, per feature and iteration.

    A shuffle is a join of ``row_number over key`` with ``row_number over
    md5(key || iter)``: each row meets another row, deterministically.  One
    join per iteration brings the other row's values of all features; the
    variants, one a feature, are exploded from it.  ``score`` adds a column
    ``score`` to a frame with the features.  Iterations follow one another, each leaves its counts by score only.
    """
    from scoria.operators.ranking import hash_row_number, stored_row_number
    rows = scored.select(*dict.fromkeys([key, target, *features, *tiebreak]))
    base, n = stored_row_number(rows, [key, *tiebreak], list(dict.fromkeys([key, target, *features])), name="_rk")
    names = [f"_p{i}" for i in range(len(features))]

    def counted(it: int) -> DataFrame:
        # rows of one hash follow each other by key and tiebreak, which is by their number
        other = hash_row_number(base.select(key, "_rk", *features), F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{it}"))), ["_rk"], features, n,
                                name="_to").select("_to", *[F.col(f).alias(p) for f, p in zip(features, names)])
        both = base.select("_rk", target, *features).join(other, F.col("_rk") == F.col("_to"))
        variants = F.array(*[F.struct(F.lit(f).alias("feature"), *[F.col(p if g == f else g).alias(g) for g, p in zip(features, names)])
                             for f in features])
        one = both.select(F.col(target), F.explode(variants).alias("v")).select(target, F.lit(it).alias("iter"), "v.*")
        return cut_lineage(score_counts(score(one).select(target, "feature", "iter", "score"), target, "score", ["feature", "iter"]))

    every = None
    for it in range(n_iter):
        one = counted(it)
        free_shuffles(scored.sparkSession)
        every = one if every is None else every.unionByName(one)
    base_auc = auc(score(base.select(target, *features)).select(target, "score"), target, "score").first()["auc"]
    a = auc(every, target, "score", by=["feature", "iter"], counts=True).toPandas()
    a["drop"] = base_auc - a["auc"]
    return a.groupby("feature")["drop"].agg(reduce).reindex(list(features))


def history_table(history: Mapping[str, tuple | None], **measures: Mapping[str, float]) -> pd.DataFrame:
    """Feature -> reason code, value and other feature of its removal (empty = kept), with measures such as
    Gini or IV by feature."""
    rows = [(f, *(h or (None, None, None)), *[m.get(f) for m in measures.values()]) for f, h in sorted(history.items())]
    return pd.DataFrame(rows, columns=["feature", "reason", "value", "other", *measures])


def rank_weights(df: DataFrame, score: str, lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Average-rank / n clipped to [lo, hi] (one row per feature input table)."""
    w = Window.orderBy(score)
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    r = F.rank().over(w)
    ties = F.count(F.lit(1)).over(Window.partitionBy(score))
    v = (r + (ties - 1) / 2.0) / n
    return df.withColumn("weight", F.least(F.greatest(v, F.lit(lo)), F.lit(hi)))
