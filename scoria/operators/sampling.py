"""Sampling, splitting and folds.

Reproducibility contract: a row's fate depends only on its key, through
``md5_bucket(key)`` — not on partitioning, task order or retries — so a
lost executor recomputes the same sample, and a SQL engine can check it.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoria.functions.exprs import md5_bucket
from scoria.operators.ranking import dist_row_number, join_null_safe
from scoria.session import small_side

__all__ = ["md5_sample", "stratified_sample", "class_counts", "adaptive_fractions",
           "time_split", "largest_first", "assign_folds", "md5_split", "exclude_fold"]


def md5_sample(df: DataFrame, key, fractions: Mapping, label: str | None = None,
               salt: str = "") -> DataFrame:
    """P1 (reproducible): keep a row when ``md5_bucket(key || salt) < fraction``.

    ``fractions`` maps class -> fraction (needs ``label``), or ``{None: f}``.
    """
    k = F.col(key) if isinstance(key, str) else key
    if salt:
        k = F.concat(k.cast("string"), F.lit(salt))
    u = md5_bucket(k)
    if label is None:
        return df.where(u < F.lit(float(fractions[None])))
    f = None
    for cls, frac in fractions.items():
        cond = F.col(label) == F.lit(cls)
        f = F.when(cond, F.lit(float(frac))) if f is None else f.when(cond, F.lit(float(frac)))
    return df.where(u < f.otherwise(F.lit(0.0)))


def stratified_sample(df: DataFrame, label: str, fractions: Mapping, seed: int = 42) -> DataFrame:
    """P1 (Spark's Bernoulli ``sampleBy``), seeded."""
    return df.sampleBy(label, dict(fractions), seed)


def class_counts(df: DataFrame, label: str) -> dict:
    """G5 collected *by key* (two rows) — never by list position."""
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}


def adaptive_fractions(counts: Mapping, targets: Mapping = None, mult: Mapping | float = 1.0) -> dict:
    """``fraction[c] = min(mult[c] * targets[c] / counts[c], 1)``."""
    targets = targets or {1: 100_000, 0: 1_900_000}
    out = {}
    for c, t in targets.items():
        m = mult[c] if isinstance(mult, Mapping) else mult
        n = counts.get(c, 0)
        out[c] = 1.0 if not n else min(m * t / n, 1.0)
    return out


def time_split(df: DataFrame, col: str, pivot) -> tuple[DataFrame, DataFrame]:
    """Train ``< pivot``, out-of-time ``>= pivot``."""
    c = F.col(col)
    p = F.lit(str(pivot)).cast("date")
    return df.where(c < p), df.where(c >= p)


def md5_split(df: DataFrame, key, weights: Sequence[float], name: str = "split",
              labels: Sequence[str] | None = None) -> DataFrame:
    """Label rows train/valid/test (or any weights) by md5 bucket of key."""
    k = F.col(key) if isinstance(key, str) else key
    u = md5_bucket(k)
    labels = list(labels or [str(i) for i in range(len(weights))])
    tot = float(sum(weights))
    edge, expr = 0.0, None
    for w, lab in zip(weights[:-1], labels[:-1]):
        edge += w / tot
        expr = F.when(u < edge, F.lit(lab)) if expr is None else expr.when(u < edge, F.lit(lab))
    expr = F.lit(labels[-1]) if expr is None else expr.otherwise(F.lit(labels[-1]))
    return df.withColumn(name, expr)


#: Groups that ``largest_first`` deals one by one; the rest are dealt by hash.
MAX_GROUPS = 100_000


def largest_first(sizes: DataFrame, k: int, group: str, name: str = "fold", max_groups: int = MAX_GROUPS) -> DataFrame:
    """(group, fold) of counted groups (group, n): from the largest on, each goes to the lightest fold.

    Equal sizes are dealt by rising group (null first), equal loads by rising fold.  Only the
    ``max_groups`` largest groups are dealt one by one, on the driver; the others, none of them larger
    than those, go to ``floor(md5_bucket(group) * k)``.
    """
    spark = sizes.sparkSession
    top = sizes.orderBy(F.desc("n"), F.asc_nulls_first(group)).limit(max_groups)
    loads, dealt = [(0, f) for f in range(k)], []
    for g, n in top.select(group, "n").collect():
        load, f = heapq.heappop(loads)
        heapq.heappush(loads, (load + n, f))
        dealt.append((g, f))
    table = spark.createDataFrame(dealt, f"`{group}` {sizes.schema[group].dataType.simpleString()}, `{name}` int")
    if len(dealt) < max_groups:
        return table
    rest = join_null_safe(sizes.select(group), table.withColumnRenamed(name, "__dealt"), [group], "left")
    return rest.select(group, F.coalesce("__dealt", F.floor(md5_bucket(
        F.coalesce(F.col(group).cast("string"), F.lit(""))) * k).cast("int")).alias(name))


def assign_folds(df: DataFrame, k: int, key: str, target: str | None = None,
                 group: str | None = None, name: str = "fold", method: str = "balanced",
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """Fold column.

    * ``group``: ``floor(md5_bucket(group) * k)`` — a group never spans folds; with
      ``method="largest_first"`` counted groups go to the lightest fold, so folds have equal rows
      as far as whole groups allow (see ``largest_first``);
    * ``target``: stratified, exactly balanced per class:
      ``(row_number over (partition by target order by md5(key), key) - 1) % k``,
      computed with distributed running counts (no class in one task);
    * neither (or ``method="hash"``): ``floor(md5_bucket(key || '|fold') * k)`` —
      no shuffle at all; each class is split evenly in expectation.

    ``balanced`` sorts every row (one range shuffle); ``hash`` is the
    choice for very large inputs.
    """
    if method == "hash" and group is None:
        return df.withColumn(name, F.floor(md5_bucket(F.concat(F.col(key).cast("string"), F.lit("|fold")))
                                           * k).cast("int"))
    if group is not None and method == "largest_first":
        folds = largest_first(df.groupBy(group).agg(F.count(F.lit(1)).alias("n")), k, group, name)
        return join_null_safe(df, small_side(folds), [group])
    if group is not None:
        return df.withColumn(name, F.floor(md5_bucket(group) * k).cast("int"))
    if target is None:
        return df.withColumn(name, F.floor(md5_bucket(key) * k).cast("int"))
    h = "_h_" + name
    # ties (duplicate keys) are broken by further columns so the order is total
    r = dist_row_number(df.withColumn(h, F.md5(F.col(key).cast("string"))), [target],
                        [h, key, *tiebreak], name="_rn_")
    return r.withColumn(name, ((F.col("_rn_") - 1) % k).cast("int")).drop("_rn_", h)


def exclude_fold(df: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    """Training rows for hold-out fold ``fold``."""
    return df.where(F.col(name) != fold)
