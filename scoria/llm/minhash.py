"""MinHash near-duplicates: one-permutation hashing, optimal densification, stars in banded buckets.

A document's set holds the 64-bit hashes of its distinct ``k``-word
shingles (fewer words: the whole sequence).  One hash serves as the one
permutation: its range is cut into ``BANDS * ROWS`` bins and a bin's value
is the smallest hash in it; an empty bin takes the value of the first
non-empty bin in a random order of its own (optimal densification).
``ROWS`` neighbouring values are a band, the key of a bucket.  Two sets of
similarity 0.85 miss each other in all bands with a chance of
(1 - 0.85**4)**28, 1e-9.

Documents with equal sets are one node.  In a bucket, candidate edges are
stars: the smallest node is compared with all others.  What is confirmed
on the full sets joins components; a bucket whose members are in one
component is done.  The nodes of the other buckets are dealt again, now by
the rarest shingles of their sets: similar sets share one of their
n - ceil(0.85 n) + 1 rarest, so these buckets lose no pair.  Two sets that
meet by shingles at places i and j of that order can share n - i and m - j
at most, if it is the first they share; so copies that were edited in
different places are seldom compared.  In these buckets, 8, 64, ... members
of the largest component, and as many others, become the next centres and
are compared with the members of other components only; a centre that was
compared leaves the bucket.  So every pair of a bucket is compared, or
already connected, or cannot be similar, while a bucket of near copies
costs some stars.

Full sets are computed again for the nodes that share a bucket, one
document for each; nothing is sent to the driver but counts.

Defined cases: a text without words has no set, and its document is linked
with nothing (its component is itself); a null id takes part in linking, a
component without any id has a null component_id; repeated rows are kept
as rows; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoria.llm.common import col, utf8
from scoria.llm.simhash import components
from scoria.session import cut_lineage, small_side

__all__ = ["shingle_set", "signature", "bands", "nodes", "links", "groups", "BANDS", "ROWS", "GROWTH"]

BANDS, ROWS = 28, 4
#: Centres of each side of a bucket in a round, relative to the round before.
GROWTH = 8
#: Links that one task joins to a forest.
FOREST_LINKS = 100_000
#: Distinct words a task remembers the hashes of.
HELD_WORDS = 200_000
BINS = BANDS * ROWS
#: For each bin the order in which it looks for a non-empty one: a random permutation, the same in every task.
PROBES = np.argsort(np.random.Generator(np.random.PCG64(12)).random((BINS, BINS)), axis=1)


class _Hashes(dict):
    def __missing__(self, word):
        if len(self) >= HELD_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_set(text: bytes, known: _Hashes, k: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    ws = text.lower().split()
    w = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
    n = min(k, len(w))
    h = np.full(max(0, len(w) - k + 1) or min(1, len(w)), n, np.uint64)
    for i in range(n):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w[i:i + len(h)])
    return np.unique(h)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The ``BINS`` densified minima of a non-empty sorted set."""
    edges = (np.arange(BINS, dtype=np.uint64) << np.uint64(32)) // np.uint64(BINS)
    high = hashes >> np.uint64(32)
    at = np.searchsorted(high, edges)
    full = at < np.append(at[1:], len(hashes))
    out = hashes[np.minimum(at, len(hashes) - 1)]
    empty = np.nonzero(~full)[0]
    if len(empty):
        order = PROBES[empty]
        out[empty] = out[order[np.arange(len(empty)), full[order].argmax(1)]]
    return out


def bands(sign: np.ndarray) -> np.ndarray:
    """One bucket key per band."""
    rows = sign.reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, r])
    return h


def nodes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 3) -> DataFrame:
    """(doc_id, h, n, node, keys) per document: h is xxhash64 of the text, n the size of its set, node the
    set's 128-bit digest and keys its buckets (both null without words)."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("node", pa.binary()),
                        ("keys", pa.list_(pa.int64()))])

    def run(batches):
        known = _Hashes()
        for batch in batches:
            n, node, keys = [], [], []
            for text in utf8(batch.column(2)):
                s = shingle_set(text, known, k)
                n.append(len(s))
                node.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                keys.append(bands(signature(s)).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(node, pa.binary()),
                                              pa.array(keys, pa.list_(pa.int64()))], schema=schema)

    d = docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text_col)).alias("h"),
                    col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, h long, n long, node binary, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(node, s): the full sets of ``wanted`` (node, doc_id, h)."""
    schema = pa.schema([("node", pa.binary()), ("s", pa.list_(pa.int64()))])

    def run(batches):
        known = _Hashes()
        for batch in batches:
            s = [shingle_set(t, known, k).view(np.int64) for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, schema.field("s").type)], schema=schema)

    w = small_side(wanted.select("node", F.col("doc_id").alias("rep_id"), F.col("h").alias("rep_h")))
    d = docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text_col)).alias("h"),
                    col(text_col).cast("string").alias("text"))
    met = d.join(w, F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("h") == F.col("rep_h")))
    return met.select("node", "text").mapInArrow(run, "node binary, s array<long>").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough.  A centre of many pairs is a skewed key with one set
    on the other side, which Spark splits."""
    a = sets.select(F.col("node").alias("u"), F.col("s").alias("su"))
    b = sets.select(F.col("node").alias("v"), F.col("s").alias("sv"))
    both = pairs.join(b, "v").join(a, "u")
    shared = F.size(F.array_intersect("su", "sv"))
    return both.where(100 * shared >= percent * (F.size("su") + F.size("sv") - shared)).select("u", "v")


def links(distinct: DataFrame, sets_of, *, percent: int = 85, growth: int = GROWTH) -> DataFrame:
    """(node, root) of all nodes with a link; ``distinct`` is (node, n, keys), ``sets_of`` gives (node, s) of given nodes."""
    def may_share(x, y) -> Column:
        """Whether sets that share ``x`` and ``y`` elements of their own at most can be similar enough."""
        return (100 + percent) * F.least(x, y) >= percent * (F.col("x.n") + F.col("y.n"))

    places = distinct.select(F.explode("keys").alias("bucket"), "node", "n")
    # a node can meet a bucket twice only by a hash collision; min <> max tells buckets of several nodes
    many = places.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last")).where("centre <> last")
    members = cut_lineage(places.join(many.drop("last"), "bucket"))
    sets = cut_lineage(sets_of(members.select("node").distinct()))

    x, y = members.where("node <> centre").alias("x"), members.where("node = centre").select("bucket", "n").alias("y")
    pairs = x.join(y, "bucket").where(may_share(F.col("x.n"), F.col("y.n"))).select(F.col("centre").alias("u"), F.col("x.node").alias("v")).distinct()
    tested = cut_lineage(pairs)
    found = cut_lineage(_confirmed(tested, sets, percent))
    roots = _roots(found)
    members = _unresolved(members.where("node <> centre").drop("centre"), roots)
    if members.isEmpty():
        return roots
    members = _rarest(members.select("node", "n").distinct(), sets, percent)
    quota = 1
    while True:
        members = cut_lineage(_unresolved(members, roots))
        if members.isEmpty():
            return roots
        quota *= growth
        # a hash in [0, 1) of the node chooses ``quota`` of either side, or all
        chance = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / float(1 << 30)
        side = F.when(F.col("root") == F.col("main.root"), F.col("main.c")).otherwise(F.col("others"))
        members = members.withColumn("is_centre", chance * side < quota)
        x, y = members.alias("x"), members.where("is_centre").alias("y")
        fit = may_share(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
        pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.root") != F.col("y.root")) & fit).select(
            F.least("x.node", "y.node").alias("u"), F.greatest("x.node", "y.node").alias("v")).distinct()
        pairs = cut_lineage(pairs.join(tested, ["u", "v"], "left_anti"))
        found = cut_lineage(found.unionByName(_confirmed(pairs, sets, percent)))
        tested = tested.unionByName(pairs)
        members = members.where(~F.col("is_centre")).select("bucket", "node", "n", "place")
        roots = _roots(found)


def _roots(edges: DataFrame) -> DataFrame:
    """(node, root) of the links (u, v), kept: every ``FOREST_LINKS`` of them become a forest in a task, and
    the forests are joined by star steps where there are several."""
    def forest(batches):
        up: dict[bytes, bytes] = {}

        def root(x):
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                u, v = root(u), root(v)
                up[max(u, v)] = min(u, v)
        for rows in (list(up)[a:a + 10_000] for a in range(0, len(up), 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(map(root, rows), pa.binary())], names=["node", "root"])

    parts = max(1, -(-edges.count() // FOREST_LINKS))
    trees = edges.select("u", "v").repartition(parts).mapInArrow(forest, "node binary, root binary")
    return cut_lineage(trees if parts == 1 else components(trees.toDF("u", "v")))


def _unresolved(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with (root, main, others) of the buckets with several components: ``main`` is the largest
    component (c members, root) and ``others`` the number of members outside it."""
    named = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = named.groupBy("bucket", "root").agg(F.count("*").alias("c"))
    todo = sizes.groupBy("bucket").agg(F.max(F.struct("c", "root")).alias("main"), F.sum("c").alias("c"), F.count("*").alias("roots"))
    todo = todo.where("roots > 1").select("bucket", "main", (F.col("c") - F.col("main.c")).alias("others"))
    return named.join(todo, "bucket")


def _rarest(wanted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, n, place): the rarest shingles of the wanted sets, by their number of these sets, as buckets.

    Shingles of one set alone take the first places and pair with nothing, so only their number is used.
    """
    every = cut_lineage(wanted.join(sets, "node").select("node", "n", F.explode("s").alias("bucket")))
    shared = every.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    own = every.join(shared, "bucket").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("c", "bucket"))).alias("t"))
    alone = F.col("n") - F.size("t")
    most = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1 - alone
    placed = own.where(most > 0).select("node", "n", alone.alias("alone"), F.posexplode(F.slice("t", F.lit(1), most.cast("int"))))
    return cut_lineage(placed.select("col.bucket", "node", "n", (F.col("alone") + F.col("pos")).alias("place")))


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, h, n_shingles, component_id."""
    rows = cut_lineage(nodes(docs, id_col=id_col, text_col=text_col, k=k))
    distinct = cut_lineage(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.first("n").alias("n"), F.first("keys").alias("keys"), F.min("doc_id").alias("least"),
        F.min(F.struct("h", "doc_id")).alias("rep")))

    def sets_of(wanted: DataFrame) -> DataFrame:
        reps = distinct.join(wanted, "node", "left_semi").select("node", "rep.doc_id", "rep.h")
        return _sets(docs, cut_lineage(reps), id_col, text_col, k)

    roots = links(distinct, sets_of, percent=percent)
    classes = cut_lineage(distinct.select("node", "least").join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), "least"))
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.select("node", "root").join(names, "root").select("node", "component_id")
    none = F.col("node").isNull()
    out = rows.where(~none).join(named, "node").select("doc_id", "h", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(rows.where(none).select("doc_id", "h", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))
