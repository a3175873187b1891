"""SimHash near-duplicates through vantage-point trees, exact within a Hamming radius.

Fingerprints: words are runs of non-space characters after lower-casing
A-Z; every run of ``k`` words (repeats included) is hashed with XXH64,
seed 42; a bit is set where it is set in over half the hashes.

Distinct fingerprints are dealt to shards by a vantage-point tree that is
fitted on a bounded sample.  At a node with vantage point v and radius r a
fingerprint belongs to the near side if its distance d to v is at most r,
else to the far side.  By the triangle inequality two fingerprints within
``radius`` on different sides need the far one at d <= r + radius, so only
those far ones also visit the near side, as guests; a guest enters each
side that its distance does not rule out.  Every linked pair so meets in
the shard of one of the two.  A shard goes on splitting by the same rule
in memory, compares leaves in blocks, and returns one link per fingerprint
to its local group, not the pairs.  Links of all shards are joined to
components by alternating star steps on DataFrames.

Defined cases: a text without words (null, empty, only spaces) has the
fingerprint zero and links like any other; a text of fewer than ``k``
words is one shingle; repeated rows share a fingerprint and group; a null
id takes part in linking, and a component without any id has a null
component_id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoria.llm.common import col, partitions
from scoria.session import cut_lineage

__all__ = ["fingerprint", "hex_fingerprint", "fit_tree", "links", "components", "groups", "SAMPLE", "SHARD_ROWS"]

#: The tree is fitted on at most so many fingerprints (the smallest by hash).
SAMPLE = 16_384
#: Shards hold about so many distinct fingerprints, until the sample is used up.
SHARD_ROWS = 1024
#: In a shard, groups up to this size are compared without further splits.
LEAF_ROWS = 1024
PIECE = 1 << 17


def fingerprint(text: Column, k: int = 3) -> Column:
    """The 64-bit SimHash of a text as a (signed) long."""
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(_prints(["" if t is None else t for t in texts], k).view(np.int64))
    return F.pandas_udf(run, "long")(text)


def hex_fingerprint(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _shingle_hashes(text: str, k: int) -> np.ndarray:
    ws = text.encode().lower().split()
    if not ws:
        return np.empty(0, np.uint64)
    data = b" ".join(ws)
    if len(ws) <= k:
        return np.array([xxhash.xxh64_intdigest(data, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:len(ws) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(data[a:b], 42) for a, b in zip(starts, (ends[k - 1:] - 1).tolist())), np.uint64, len(starts))


def _prints(texts: list[str], k: int) -> np.ndarray:
    ones = np.zeros((len(texts), 64), np.int64)
    total = np.zeros(len(texts), np.int64)
    held: list[np.ndarray] = []
    owner: list[int] = []
    size = 0

    def flush():
        nonlocal held, owner, size
        if held:
            bits = np.unpackbits(np.concatenate(held).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at = np.cumsum([0] + [len(h) for h in held[:-1]])
            np.add.at(ones, owner, np.add.reduceat(bits, at, axis=0, dtype=np.int32))
        held, owner, size = [], [], 0

    for i, t in enumerate(texts):
        h = _shingle_hashes(t, k)
        total[i] = len(h)
        for a in range(0, len(h), PIECE):  # a very long text comes in pieces
            held.append(h[a:a + PIECE])
            owner.append(i)
            size += len(held[-1])
            if size >= PIECE:
                flush()
    flush()
    return np.packbits(ones * 2 > total[:, None], axis=1, bitorder="little").reshape(-1).view(np.uint64)


def _split(fps: np.ndarray, tries: int = 8):
    """(vantage point, radius) that halves ``fps`` with a thin boundary, or None if no point separates them."""
    best = None
    for i in np.linspace(0, len(fps) - 1, min(tries, len(fps))).astype(int):
        d = np.bitwise_count(fps ^ fps[i])
        r = int(np.median(d))
        near = int((d <= r).sum())
        if near == len(fps):
            r -= 1
            near = int((d <= r).sum())
        if r < 0 or near == 0:
            continue
        # rows that both sides see, and how far from halves the split is
        cost = int(((d >= r - 1) & (d <= r + 2)).sum()) + 2 * abs(near - len(fps) // 2)
        if best is None or cost < best[0]:
            best = cost, fps[i], r
    return best and best[1:]


def fit_tree(prints: DataFrame, *, sample: int = SAMPLE, shard_rows: int = SHARD_ROWS):
    """Tree over distinct fingerprints (column ``fp``); the driver receives ``sample`` of them at most.

    A node is (vantage point, radius, near node, far node); a leaf is its shard number.
    """
    n = prints.count()
    got = prints.orderBy(F.xxhash64("fp"), "fp").limit(sample).select("fp").collect()
    fps = np.array([r.fp for r in got], np.int64).view(np.uint64)
    leaf = max(8, -(-len(fps) * shard_rows // max(n, 1)))
    shards = 0

    def grow(part):
        nonlocal shards
        cut = _split(part) if len(part) > leaf else None
        if cut is None:
            shards += 1
            return shards - 1
        near = np.bitwise_count(part ^ cut[0]) <= cut[1]
        return int(cut[0]), cut[1], grow(part[near]), grow(part[~near])

    return grow(fps)


def _route(node, fps, rows, guests, radius, out):
    """Deal members ``rows`` and ``guests`` (indices into fps) to the shards below ``node``."""
    if not len(rows) and not len(guests):
        return
    if not isinstance(node, tuple):
        out.append((node, rows, guests))
        return
    v, r, near, far = node
    d, g = np.bitwise_count(fps[rows] ^ np.uint64(v)), np.bitwise_count(fps[guests] ^ np.uint64(v))
    _route(near, fps, rows[d <= r], np.concatenate((guests[g <= r + radius], rows[(d > r) & (d <= r + radius)])), radius, out)
    _route(far, fps, rows[d > r], guests[g + radius > r], radius, out)


def _meet(fps, rows, guests, radius):
    """Index pairs within ``radius``: members with members, and guests with members."""
    cut = _split(fps[rows]) if len(rows) > LEAF_ROWS else None
    if cut is not None:
        v, r = cut
        d, g = np.bitwise_count(fps[rows] ^ v), np.bitwise_count(fps[guests] ^ v)
        yield from _meet(fps, rows[d <= r], np.concatenate((guests[g <= r + radius], rows[(d > r) & (d <= r + radius)])), radius)
        yield from _meet(fps, rows[d > r], guests[g + radius > r], radius)
        return
    step = max(1, (1 << 20) // max(1, len(rows)))
    for left, own in ((rows, True), (guests, False)):
        for a in range(0, len(left), step):
            i, j = np.nonzero(np.bitwise_count(fps[left[a:a + step], None] ^ fps[None, rows]) <= radius)
            x, y = left[a + i], rows[j]
            keep = x < y if own else slice(None)
            yield x[keep], y[keep]


def _forest(n, pairs):
    """Smallest index of each index's group; ``pairs`` may name a link many times."""
    lab = np.arange(n)
    for x, y in pairs:
        a, b = lab[x], lab[y]
        new = a != b
        if not new.any():
            continue
        ab = np.unique(np.stack((np.minimum(a[new], b[new]), np.maximum(a[new], b[new])), 1), axis=0)
        parent = {}

        def root(u):
            while parent.get(u, u) != u:
                parent[u] = parent.get(parent[u], parent[u])
                u = parent[u]
            return u

        for p, q in ab.tolist():
            p, q = root(p), root(q)
            if p != q:
                parent[max(p, q)] = min(p, q)
        move = np.arange(n)
        for u in parent:
            move[u] = root(u)
        lab = move[lab]
    return lab


def links(prints: DataFrame, tree, *, radius: int = 2) -> DataFrame:
    """(u, v), u > v: links whose components are those of all pairs within ``radius`` bits."""
    def deal(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            out: list = []
            _route(tree, fps, np.arange(len(fps)), np.empty(0, np.int64), radius, out)
            shard = np.concatenate([np.full(len(m) + len(g), s, np.int64) for s, m, g in out] or [np.empty(0, np.int64)])
            which = np.concatenate([np.concatenate((m, g)) for _, m, g in out] or [np.empty(0, np.int64)])
            member = np.concatenate([np.arange(len(m) + len(g)) < len(m) for _, m, g in out] or [np.empty(0, bool)])
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(fps[which].view(np.int64)), pa.array(member)],
                                             names=["shard", "fp", "member"])

    def link(shard: pa.Table) -> pa.Table:
        fps = shard.column("fp").to_numpy().view(np.uint64)
        member = shard.column("member").to_numpy()
        order = np.argsort(fps, kind="stable")  # the smallest index is the smallest fingerprint
        fps, member = fps[order], member[order]
        at = np.arange(len(fps))
        root = _forest(len(fps), _meet(fps, at[member], at[~member], radius))
        far = root != at
        return pa.table({"u": fps[far].view(np.int64), "v": fps[root[far]].view(np.int64)})

    dealt = prints.select("fp").mapInArrow(deal, "shard long, fp long, member boolean")
    found = dealt.groupBy("shard").applyInArrow(link, "u long, v long")
    return found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def components(edges: DataFrame, *, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the smallest node of its component.

    Alternating star steps: each node's larger neighbours, then its smaller
    ones, are hung on its smallest neighbour, until nothing changes.
    """
    def total(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    def star(e, both):
        n = e.union(e.select("v", "u")) if both else e
        n = n.toDF("a", "b")
        low = n.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        hung = n.join(low, "a")
        if both:
            hung = hung.where("b > a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        else:
            hung = hung.select(F.col("b").alias("u"), F.col("m").alias("v")).union(low.select("a", "m"))
        return hung.where("u <> v").distinct()

    e = cut_lineage(edges.where("u <> v").select("u", "v").distinct())
    before = total(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        e = cut_lineage(star(star(e, True), False))
        now = total(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select("v", "v").distinct())


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 3, radius: int = 2,
           sample: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: doc_id, h (xxhash64 of the text), fp, root (its class's fingerprint), component_id."""
    rows = cut_lineage(docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text_col)).alias("h"),
                                   fingerprint(col(text_col), k).alias("fp")))
    prints = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    tree = fit_tree(prints, sample=sample, shard_rows=shard_rows)
    comp = components(links(prints, tree, radius=radius)).withColumnRenamed("node", "fp")
    classes = prints.join(comp, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    classes = cut_lineage(classes)
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(classes.drop("least").join(names, "root"), "fp").select("doc_id", "h", "fp", "root", "component_id")
