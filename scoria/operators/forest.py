"""Random forests on cells, many at once.

Rows become distinct cells of binned features with class counts, as in ``boosting``.  A tree's bootstrap gives
every row Poisson(1) copies; a cell's copies of a class are one Poisson draw of its count, made from a hash of
the bins, the class and the tree's number, so any partitioning or retry draws the same and a forest can be given
more trees later.  All trees of all forests grow together, level by level: one job adds up the class counts by
(node, feature, bin) and picks the splits where they are added up, the driver gets the splits only.

The rules are those of MLlib's classifier: Gini impurity, at each node a random subset of the features, no split
without gain or with too light a side (``min_share`` of all rows), and two leaves below a node that predict the
same class are one.  A forest's probability is the mean of its leaves' shares of events.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoria.operators.boosting import _margin, _matrix, _place, bin_edges
from scoria.operators.report import LADDERS

__all__ = ["Forest", "split_edges", "grow", "probability"]

#: Bytes of class counts that a task holds at once; more trees or nodes take further jobs.
TASK_BYTES = 1 << 26


@dataclass
class Forest:
    """Settings of a forest, and its trees: (feature, bin, share of events) by heap position."""

    features: Sequence[int]
    size: int = 200
    depth: int = 5
    share: float | None = None  # of the features, to choose from at a node; None: as many as their number's square root
    min_share: float = 0.0
    seed: int = 27
    trees: list = field(default_factory=list)

    def chosen(self, number: int, node: int) -> np.ndarray:
        """The features that a node may split by."""
        k = len(self.features)
        m = math.ceil(math.sqrt(k)) if self.share is None else max(1, math.ceil(self.share * k))
        return np.sort(np.random.default_rng([self.seed, number, node]).choice(np.asarray(self.features), m, replace=False))


def split_edges(df: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Inner edges of at most ``bins`` bins per feature: every value of a feature that has no more, quantiles of the others."""
    num = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    about = num.agg(*[F.approx_count_distinct(f).alias(f) for f in features]).first()
    few = [f for f in features if about[f] <= 1.2 * bins]
    values = num.agg(*[F.collect_set(f).alias(f) for f in few]).first() if few else {}
    own = {f: sorted(v for v in values[f] if v == v)[:-1] for f in few if len(values[f]) <= bins}
    many = [f for f in features if f not in own]
    own |= bin_edges(df, many, bins) if many else {}
    return {f: own[f] for f in features}


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash(codes: np.ndarray, y: np.ndarray) -> np.ndarray:
    h = y.astype(np.uint64)
    for c in codes:
        h = _mix(h + np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64))
    return h


@cache
def _steps() -> tuple[np.ndarray, np.ndarray]:
    """By mean, the steps of its distribution function in units of 2 ** -32, and how many are at or below each multiple of 2 ** 20."""
    own = [[at for at in (math.ceil(step * 2 ** 32) for step in ladder) if at < 2 ** 32] for ladder in LADDERS]
    steps = np.full((len(own), max(map(len, own)) + 1), 2 ** 32 - 1, np.uint32)
    for row, s in zip(steps, own):
        row[:len(s)] = s
    return steps, np.stack([np.searchsorted(np.array(s, float), np.arange(4097) * 2.0 ** 20, side="right") for s in own]).astype(np.uint8)


def _copies(key: np.ndarray, count: np.ndarray, seed: int, number: int) -> np.ndarray:
    """Poisson(``count``) copies in a tree's bootstrap; ``count`` is sorted."""
    x = _mix(key ^ _mix(np.array([(seed << 32) + number + 1], np.uint64)))
    out = np.empty(len(x))
    few = int(np.searchsorted(count, len(LADDERS)))
    u, mean = (x[:few] >> np.uint64(32)).astype(np.uint32), count[:few]
    steps, below = _steps()
    at = mean * below.shape[1] + (u >> np.uint32(20))
    w, most = below.ravel()[at], below.ravel()[at + 1]
    start = mean * steps.shape[1]
    w = w + ((w < most) & (u >= steps.ravel()[start + w]))
    left = np.nonzero(w < most)[0]
    while len(left):  # steps that share a multiple
        left = left[u[left] >= steps.ravel()[start[left] + w[left]]]
        w[left] += 1
        left = left[w[left] < most[left]]
    out[:few] = w
    mean, x = count[few:].astype(float), x[few:]
    u, v = (x >> np.uint64(32)).astype(float) / 2.0 ** 32, (x & np.uint64(0xFFFFFFFF)).astype(float) / 2.0 ** 32
    z = np.sqrt(-2 * np.log(1 - u)) * np.cos(2 * math.pi * v)
    out[few:] = np.maximum(0.0, np.floor(mean + np.sqrt(mean) * z + (z * z - 1) / 6 + 0.5))
    return out


def _rows(cells: DataFrame, width: int) -> RDD:
    """Cells as arrays: (bins as features x rows, class, count, hash), a row for each class that a cell has."""
    spark = cells.sparkSession

    def run(batches):
        for b in filter(len, batches):
            codes = _matrix(b.column(0), width).T
            n, n1 = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (1, 2))
            count, y = np.concatenate([n - n1, n1]), np.repeat(np.arange(2), len(n))
            order = np.argsort(count, kind="stable")
            order = order[np.searchsorted(count[order], 1):]
            own = np.ascontiguousarray(codes[:, order % len(n)]).astype(np.min_scalar_type(int(codes.max())))
            block = own, y[order], count[order], _hash(own, y[order])
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], names=["block"])

    packed = cells.select("codes", "n", "n1").repartition(spark.sparkContext.defaultParallelism).mapInArrow(run, "block binary")
    return packed.rdd.map(lambda r: pickle.loads(bytes(r.block)))


def grow(cells: DataFrame, models: Sequence[Forest], n_bins: int) -> list[Forest]:
    """Give every forest its ``size`` trees.  ``cells`` are (codes, n, n1), with a class for every row."""
    width = cells.select(F.size("codes")).first()[0]
    state = _rows(cells, width).persist(StorageLevel.MEMORY_AND_DISK)
    total = state.map(lambda b: int(b[2].sum())).sum()
    trees = {(i, t): _empty(m.depth) for i, m in enumerate(models) for t in range(len(m.trees), m.size)}
    todo = {key: [0] for key in trees}
    level = 0
    while todo:
        nxt = {}
        for part in _portions(todo, models, n_bins):
            for key, found in _splits(state, part, trees, models, level, n_bins, total):
                feature, at, counts = trees[key]
                m = models[key[0]]
                least = max(2.0, 2 * m.min_share * total)
                for node, (f, b, here, left) in zip(part[key], found):
                    counts[node] = here
                    if f >= 0:
                        feature[node], at[node] = f, b
                        counts[2 * node + 1], counts[2 * node + 2] = left, here - left
                        if level + 1 < m.depth:
                            nxt.setdefault(key, []).extend(c for c in (2 * node + 1, 2 * node + 2) if counts[c].min() > 0 and counts[c].sum() >= least)
        todo, level = {k: v for k, v in nxt.items() if v}, level + 1
    state.unpersist()
    for (i, _), tree in sorted(trees.items()):
        models[i].trees.append(_leaves(*tree))
    return list(models)


def _empty(depth: int):
    size = 2 ** (depth + 1) - 1
    return np.full(size, -1), np.zeros(size, np.int64), np.zeros((size, 2))


def _portions(todo, models, n_bins):
    """The open trees by portions whose class counts a task can hold."""
    part, used = {}, 0
    for key, nodes in todo.items():
        own = 16 * len(nodes) * len(models[key[0]].features) * n_bins
        if part and used + own > TASK_BYTES:
            yield part
            part, used = {}, 0
        part[key], used = nodes, used + own
    if part:
        yield part


def _splits(state: RDD, part, trees, models, level: int, n_bins: int, total: int):
    """(tree, per open node its feature or -1, bin, class counts, and those of the left side)."""
    chosen = {(i, t): np.array([models[i].chosen(t, node) for node in nodes]) for (i, t), nodes in part.items()}
    shape = {key: (trees[key], np.array(nodes) - (2 ** level - 1)) for key, nodes in part.items()}
    least = {i: models[i].min_share * total for i, _ in part}
    by_draw: dict = {}  # trees that share their bootstrap
    for i, t in part:
        by_draw.setdefault((models[i].seed, t), []).append((i, t))

    def run(blocks):
        sums = {key: np.zeros((*c.shape, 2, n_bins), np.int64) for key, c in chosen.items()}
        for codes, y, count, key in blocks:
            side = y * n_bins
            for draw, keys in by_draw.items():
                w = _copies(key, count, *draw)
                use = np.nonzero(w)[0]
                drawn, w, own = side[use], w[use], codes[:, use]
                for k in keys:
                    tree, nodes = shape[k]
                    at, weight, mine = drawn, w, own
                    if level:
                        table = np.full(2 ** level + 1, -1)
                        table[nodes] = np.arange(len(nodes))
                        slot = table[np.maximum(_place(tree, level, own), -1)]
                        if (slot < 0).any():
                            here = np.nonzero(slot >= 0)[0]
                            slot, at, weight, mine = slot[here], at[here], weight[here], own[:, here]
                        at = at + slot * (2 * n_bins)
                    for f in np.unique(chosen[k]):
                        h = np.bincount(at + mine[f], weight, len(nodes) * 2 * n_bins).reshape(len(nodes), 2, n_bins)
                        node, place = np.nonzero(chosen[k] == f)
                        sums[k][node, place] += h[node].astype(np.int64)
        return [(k, s.astype(np.int32) if s.size and s.max() < 2 ** 31 else s) for k, s in sums.items()]

    def best(pair):
        key, sums = pair
        return key, [_best(s, c, least[key[0]]) for s, c in zip(sums, chosen[key])]

    parts = min(len(part), state.getNumPartitions())
    return state.mapPartitions(run).reduceByKey(lambda a, b: a.astype(np.int64) + b, parts).map(best).collect()


def _best(sums: np.ndarray, chosen: np.ndarray, least: float):
    """The split of a node by Gini impurity; ``sums`` are features x classes x bins."""
    here = sums[0].sum(1).astype(float)
    left = np.cumsum(sums, 2)[:, :, :-1].astype(float)
    right = here[:, None] - left
    n_left, n_right = left.sum(1), right.sum(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        purity = (left ** 2).sum(1) / n_left + (right ** 2).sum(1) / n_right - (here ** 2).sum() / here.sum()
    purity[(n_left <= 0) | (n_right <= 0) | (n_left < least) | (n_right < least)] = -np.inf
    f, b = np.unravel_index(int(np.argmax(purity)), purity.shape)
    return (int(chosen[f]), int(b), here, left[f, :, b]) if purity[f, b] > 1e-12 * here.sum() else (-1, 0, here, here)


def _leaves(feature, at, counts):
    """The tree with shares of events; leaves of one parent that predict the same class are taken back."""
    says = counts[:, 1] > counts[:, 0]
    for node in range(len(feature) // 2 - 1, -1, -1):
        a, b = 2 * node + 1, 2 * node + 2
        if feature[node] >= 0 and feature[a] < 0 and feature[b] < 0 and says[a] == says[b]:
            feature[node] = -1
    return feature, at, counts[:, 1] / np.maximum(counts.sum(1), 1)


def probability(codes: Column, model: Forest) -> Column:
    """The forest's probability of rows given by their bins (an Arrow-batched column)."""
    trees = model.trees

    def run(codes: pa.Array) -> pa.Array:
        return pa.array(_margin(trees, _matrix(codes, len(codes.flatten()) // max(1, len(codes)))) / max(1, len(trees)))

    return F.arrow_udf(run, "double")(codes)
