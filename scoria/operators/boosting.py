"""Second-order boosted trees with L2 and minimum gain, many models at once.

Rows become distinct cells of binned features with class counts.  A tree
is grown level by level: one job returns, for every model still growing,
the sums of gradients and Hessians by (node, feature, bin); the driver
picks the splits.  Models of different feature sets or settings share
their jobs, so a search over 25 points costs as many jobs as one model.
For a node of sums G, H a split into L and R gains
``G_L^2/(H_L+l2) + G_R^2/(H_R+l2) - G^2/(H+l2)``; splits without gain or
with too light a side (``min_child``, in Hessian) are not made, and when a
tree is full, splits that gain less than ``gamma`` and have two leaves
below are taken back.  A leaf adds ``-rate * G / (H + l2)``.  Held cells end
a model when their log loss has not improved for ``patience`` rounds; its
trees up to the best round are kept.

What reaches the driver is bounded by models x nodes x features x bins.
The cells stay in blocks of arrays with the margins of all models.  Each
round adds its new trees to them once and keeps the result; every ``KEEP``
rounds a reliable checkpoint cuts the lineage.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoria.session import checkpoint_dir

__all__ = ["Booster", "bin_edges", "bin_codes", "bin_cells", "boost", "probability", "KEEP"]

#: Rounds after which margins are stored.
KEEP = 25
#: Up to so many bytes the sums of all partitions are added up on the driver, beyond by a shuffle first.
PARTS_BYTES = 1 << 24


@dataclass
class Booster:
    """Settings of a model, and its trees: (feature, bin, leaf value) by heap position."""

    features: Sequence[int]
    depth: int = 4
    l2: float = 10.0
    gamma: float = 10.0
    min_child: float = 1.0
    rate: float = 0.1
    trees: list = field(default_factory=list)
    losses: list = field(default_factory=list)
    done: bool = False


def _complete(tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tree with every path as long as the deepest: a leaf above the last level sends its rows left, to its own value."""
    feature, at, value = (x.copy() for x in tree)
    for node in range(len(feature) // 2):
        if feature[node] < 0:
            feature[node], at[node] = 0, np.iinfo(np.int64).max
            value[2 * node + 1] = value[node]
    return feature, at, value


#: Rows that a tree walks at once (a few arrays of them stay in the processor's cache).
WALK = 1 << 14


def _margin(trees, codes: np.ndarray) -> np.ndarray:
    """Sum of the trees' values for each row of ``codes``."""
    out = np.zeros(len(codes))
    trees = [_complete(t) for t in trees]
    for lo in range(0, len(out) if trees else 0, WALK):
        part = np.ascontiguousarray(codes[lo:lo + WALK].T)
        rows, flat = np.arange(part.shape[1]), part.ravel()
        for feature, at, value in trees:
            start = feature * part.shape[1]
            node = np.zeros(len(rows), np.intp)
            for _ in range(len(feature).bit_length() - 1):
                node = 2 * node + 1 + (flat[start[node] + rows] > at[node])
            out[lo:lo + WALK] += value[node]
    return out


def _place(tree, level: int, codes: np.ndarray) -> np.ndarray:
    """The number of each row's node among those of a level, -1 or less where its path ends above; ``codes`` are features x rows."""
    feature, at, _ = tree
    rows, flat = np.arange(codes.shape[1]), codes.ravel()
    node = np.zeros(len(rows), np.intp)
    for _ in range(level):
        f = feature[node]
        node = np.where(f >= 0, 2 * node + 1 + (flat[f * len(rows) + rows] > at[node]), node)
    return node - (2 ** level - 1)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 64) -> dict[str, list[float]]:
    """Inner edges of at most ``bins`` quantile bins per feature (one sketch pass)."""
    num = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    got = num.approxQuantile(list(features), [i / bins for i in range(1, bins)], 0.25 / bins)
    return {f: sorted(set(q)) for f, q in zip(features, got)}


def bin_codes(edges: dict[str, Sequence[float]]) -> Column:
    """The bins of a row as an array; missing values are bin 0, below all others, NaN is in the last."""
    inner = [np.asarray(e, float) for e in edges.values()]

    def run(*columns: pa.Array) -> pa.Array:
        codes = np.empty((len(columns[0]), len(inner)), np.int32)
        for i, (c, e) in enumerate(zip(columns, inner)):
            x = c.to_numpy(zero_copy_only=False)  # null becomes NaN
            codes[:, i] = np.where(c.is_null().to_numpy(zero_copy_only=False), 0, np.searchsorted(e, x) + 1)
        return _lists(codes)

    return F.arrow_udf(run, "array<int>")(*[F.col(f).cast("double") for f in edges])


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), m.ravel())


def bin_cells(df: DataFrame, edges: dict[str, Sequence[float]], label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., codes, n, n1): rows and events per distinct row of bins, one aggregate with partial sums."""
    y = F.col(label).cast("int")
    return df.groupBy(*by, bin_codes(edges).alias("codes")).agg(F.count(F.lit(1)).alias("n"), F.sum(y).cast("bigint").alias("n1"))


def probability(codes: Column, model: Booster) -> Column:
    """The model's probability of rows given by their bins (an Arrow-batched column)."""
    trees = model.trees

    def run(codes: pa.Array) -> pa.Array:
        width = len(codes.flatten()) // max(1, len(codes))
        return pa.array(1 / (1 + np.exp(-_margin(trees, _matrix(codes, width)))))

    return F.arrow_udf(run, "double")(codes)


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if len(column) else np.zeros((0, width), np.int32)


def _blocks(cells: DataFrame, width: int, held: str) -> RDD:
    """Cells as arrays: (held, bins as features x cells, n, n1), learnt and held cells in blocks of their own."""
    spark = cells.sparkSession

    def run(batches):
        for b in batches:
            codes, aside = _matrix(b.column(0), width), b.column(3).to_numpy(zero_copy_only=False).astype(bool)
            for side in (False, True):
                if (aside == side).any():
                    own = np.ascontiguousarray(codes[aside == side].T)
                    own = own.astype(np.min_scalar_type(int(own.max())))
                    n, n1 = (b.column(c).to_numpy(zero_copy_only=False)[aside == side] for c in (1, 2))
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((side, own, n, n1))], pa.binary())], names=["block"])

    base = cells.select("codes", F.col("n").cast("double").alias("n"), F.col("n1").cast("double").alias("n1"), F.col(held).alias("held"))
    packed = base.repartition(spark.sparkContext.defaultParallelism).mapInArrow(run, "block binary")
    return packed.rdd.map(lambda r: pickle.loads(bytes(r.block)))


def boost(cells: DataFrame, models: Sequence[Booster], n_bins: int, rounds: int = 1000, patience: int = 20,
          tol: float = 0.0, held: str = "held") -> list[Booster]:
    """Grow every model that is not done by up to ``rounds`` more trees.  ``cells`` are (codes, n, n1, held).

    A round is better than the best before it if its held loss is smaller by more than the share ``tol``."""
    checkpoint_dir(cells.sparkSession)
    width = cells.select(F.size("codes")).first()[0]
    blocks = _blocks(cells, width, held)
    old = [list(m.trees) for m in models]
    state = blocks.map(lambda b: (*b, [_margin(t, b[1].T) for t in old])).persist(StorageLevel.MEMORY_AND_DISK)
    before = None

    for step in range(rounds):
        growing = [i for i, m in enumerate(models) if not m.done]
        if not growing:
            break
        if step:
            before, state = state, _advance(state, {i: models[i].trees[-1] for i in growing})
            if step % KEEP == 0:
                state.checkpoint()
        trees = {i: _empty(models[i].depth) for i in growing}
        gains = {i: np.zeros(len(trees[i][0])) for i in growing}
        for level in range(max(models[i].depth for i in growing)):
            open_models = [i for i in growing if level < models[i].depth and (level == 0 or (trees[i][0][2 ** (level - 1) - 1:2 ** level - 1] >= 0).any())]
            if not open_models:
                break
            sums, losses = _histograms(state, trees, open_models, level, width, n_bins)
            if level == 0 and before is not None:
                before.unpersist()
            for i in open_models:
                if level == 0:
                    models[i].losses.append(losses[i])
                _split(models[i], trees[i], gains[i], sums[i], level)
        for i in growing:
            m = models[i]
            best = 0  # losses[t] is the held loss of the first t trees
            for t, loss in enumerate(m.losses):
                best = t if loss < m.losses[best] * (1 - tol) else best
            if len(m.losses) - 1 - best >= patience and any(m.losses):
                del m.trees[best:]
                m.done = True
                continue
            _prune(m, trees[i], gains[i])
            m.trees.append(trees[i])
    state.unpersist()
    return list(models)


def _advance(state: RDD, newest: dict) -> RDD:
    """The blocks with the newest tree of each model that still grows added to its margins."""
    return state.map(lambda b: (*b[:4], [f + _margin([newest[i]], b[1].T) if i in newest else None for i, f in enumerate(b[4])])).persist(
        StorageLevel.MEMORY_AND_DISK)


def _empty(depth: int):
    size = 2 ** (depth + 1) - 1
    return np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)


def _histograms(state, trees, open_models, level, width, n_bins):
    """Per open model the sums (G, H) by (node of the level, feature, bin) over cells that are not held, and at the
    root the log loss of the held ones."""
    nodes = 2 ** level

    def run(blocks):
        sums = {i: np.zeros((2, nodes, width, n_bins)) for i in open_models}
        loss = dict.fromkeys(open_models, 0.0)
        for held, codes, n, n1, margins in blocks:
            if held and level:
                continue
            for i in open_models:
                margin = margins[i]
                if held:
                    loss[i] += float((n * np.logaddexp(0, margin) - n1 * margin).sum())
                    continue
                p = 1 / (1 + np.exp(-margin))
                g, h, own, start = n * p - n1, n * p * (1 - p), codes, 0
                if level:
                    node = _place(trees[i], level, codes)
                    use = node >= 0
                    if not use.all():
                        node, g, h, own = node[use], g[use], h[use], codes[:, use]
                    start = node * n_bins
                for f in range(width):
                    at = start + own[f].astype(np.intp)
                    for out, v in zip(sums[i], (g, h)):
                        out[:, f] += np.bincount(at, v, nodes * n_bins).reshape(nodes, n_bins)
        return [(i, (sums[i], loss[i])) for i in open_models]

    parts = state.mapPartitions(run)
    if 16 * len(open_models) * nodes * width * n_bins * state.getNumPartitions() > PARTS_BYTES:
        parts = parts.reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), min(len(open_models), state.getNumPartitions()))
    sums, losses = {}, dict.fromkeys(open_models, 0.0)
    for i, (s, loss) in parts.collect():
        sums[i] = sums[i] + s if i in sums else s
        losses[i] += loss
    return sums, losses


def _split(m: Booster, tree, gains, sums, level: int) -> None:
    """Leaf values and best splits of the nodes of a level."""
    feature, at, value = tree
    for k in range(2 ** level):
        node = 2 ** level - 1 + k
        if level and feature[(node - 1) // 2] < 0:
            continue
        g, h = (s[k][list(m.features)] for s in sums)
        total_g, total_h = g[0].sum(), h[0].sum()
        value[node] = -m.rate * total_g / (total_h + m.l2)
        left_g, left_h = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = left_g ** 2 / (left_h + m.l2) + right_g ** 2 / (right_h + m.l2) - total_g ** 2 / (total_h + m.l2)
        gain[(left_h < m.min_child) | (right_h < m.min_child)] = -np.inf
        best = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if gain[best] > 1e-9:
            feature[node], at[node], gains[node] = m.features[best[0]], best[1], gain[best]
            # the children's values, for the deepest level
            for child, (cg, ch) in ((2 * node + 1, (left_g[best], left_h[best])), (2 * node + 2, (right_g[best], right_h[best]))):
                value[child] = -m.rate * cg / (ch + m.l2)


def _prune(m: Booster, tree, gains) -> None:
    """Take back weak splits from below."""
    feature = tree[0]
    for node in range(len(feature) // 2 - 1, -1, -1):
        if feature[node] >= 0 and gains[node] < m.gamma and feature[2 * node + 1] < 0 and feature[2 * node + 2] < 0:
            feature[node] = -1
