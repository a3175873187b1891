"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path of turn digests (16 bytes of SHA-256 over role
and text).  Equal paths are one row first: a path keeps its number of
conversations, their smallest id and the digest of their sorted ids, so a
conversation that a third of the table repeats is one path.  Paths are
range-partitioned by splitters, the shortest separators between
neighbours of a bounded sample.  In sorted order the paths under a node
are neighbours, so a node can lie in two shards only if it is a proper
prefix of a splitter; the root counts as one, too.  Those prefixes are the
skeleton, the trie of the splitter paths, which every task is given (in
sorted order, at most ``SPLIT_TURNS`` turns for each shard).  A task reads
its sorted shard once with a stack of open nodes and finishes every node
outside the skeleton; of skeleton nodes it returns partial aggregates,
which are summed over the shards, and own contributions are added along
the skeleton's edges.

Defined cases: rows without a conversation id take no part; a null role or
text counts as empty; a null turn number comes first; turns of one number
are ordered by their digest, and repeated rows are repeated turns; a
conversation without turns ends at the root; ids from which no base
exists take no shared turns; an empty table has no node, not even a root.
Digests of one conversation, some 24 bytes a turn, are held by one task.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoria.llm.common import col, partitions
from scoria.session import cut_lineage, small_side

__all__ = ["sequences", "rebuilt", "distinct_paths", "splitters", "trie", "SAMPLE", "SPLIT_TURNS"]

#: Splitters are chosen from at most so many distinct paths (the smallest by hash).
SAMPLE = 16_384
#: Splitters are cut after so many turns; paths that agree on all of them share a shard.
SPLIT_TURNS = 64
#: Conversation ids in one piece of a path's id list.
IDS = 2048
WIDTH = 16
OUT_ROWS = 8192
_NODE = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("words", pa.int64()), ("conv_id", pa.int64()),
                   ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                   ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                   ("ends_sha256", pa.string())])
_NODE_SQL = ("key binary, parent binary, words long, conv_id long, depth long, parent_conv_id long, n_convs long, "
             "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
NOBODY = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, keys, words): the turns of each conversation in order, as digests (hex) and word counts."""
    role, text = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    key = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * WIDTH)
    n = F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")).cast("long")
    t = turns.where(col(conv_col).isNotNull()).select(
        col(conv_col).cast("long").alias("conv_id"), F.struct(
            col(turn_col).isNotNull().alias("known"), col(turn_col).alias("turn"), key.alias("key"), n.alias("n")).alias("t"))
    ts = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ts.select("conv_id", F.transform("t", lambda x: x["key"]).alias("keys"), F.transform("t", lambda x: x["n"]).alias("words"))


def rebuilt(seqs: DataFrame, *, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with its first crc32(id) % ``most`` turns taken from the one at the multiple of ``every`` below."""
    seqs = cut_lineage(seqs)
    base = seqs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base_id"), *[F.slice(c, 1, most - 1).alias(f"base_{c}") for c in ("keys", "words")])
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    both = seqs.join(base, F.col("conv_id") - F.col("conv_id") % every == F.col("base_id"), "left").withColumn("h", h)

    def spliced(name: str) -> Column:
        own = F.slice(name, F.col("h") + 1, F.greatest(F.size(name), F.lit(1)))
        return F.when(F.col("base_id").isNull(), own).otherwise(F.concat(F.slice(f"base_{name}", F.lit(1), F.col("h")), own)).alias(name)

    return both.select("conv_id", spliced("keys"), spliced("words"))


def distinct_paths(seqs: DataFrame) -> DataFrame:
    """(path, words, n, least, sha): one row per distinct sequence, with the digest of its sorted ids.

    The ids of one path are cut into sorted pieces by a range partition on
    (path, id); a digest reads the pieces of its path as a stream.
    """
    p = cut_lineage(seqs.select("conv_id", F.unhex(F.array_join("keys", "")).alias("path"), "words").withColumn(
        "id", F.unhex(F.md5("path"))))
    width = partitions(seqs.sparkSession)
    piece = pa.schema([("id", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])

    def cut(batches):
        now, ids, out = None, [], []
        for batch in batches:
            for key, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != now or len(ids) >= IDS:
                    if ids:
                        out.append((now, ids[0], len(ids), ",".join(map(str, ids))))
                    now, ids = key, []
                    if len(out) >= OUT_ROWS:
                        yield _batch(out, piece)
                        out = []
                ids.append(c)
        if ids:
            out.append((now, ids[0], len(ids), ",".join(map(str, ids))))
        yield _batch(out, piece)

    whole = pa.schema([("id", pa.binary()), ("least", pa.int64()), ("n", pa.int64()), ("sha", pa.string())])

    def digest(batches):
        now, sha, least, n, out = None, None, 0, 0, []
        for batch in batches:
            for key, first, count, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    if now is not None:
                        out.append((now, least, n, sha.hexdigest()))
                        if len(out) >= OUT_ROWS:
                            yield _batch(out, whole)
                            out = []
                    now, least, n, sha = key, first, 0, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
                n += count
        if now is not None:
            out.append((now, least, n, sha.hexdigest()))
        yield _batch(out, whole)

    pieces = p.select("id", "conv_id").repartitionByRange(width, "id", "conv_id").sortWithinPartitions("id", "conv_id").mapInArrow(
        cut, "id binary, first long, n long, ids string")
    ends = pieces.repartition(width, "id").sortWithinPartitions("id", "first").mapInArrow(
        digest, "id binary, least long, n long, sha string")
    one = p.groupBy("id").agg(F.first("path").alias("path"), F.first("words").alias("words"))
    return one.join(ends, "id").drop("id")


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths share at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    return next(i for i in range(0, n, WIDTH) if a[i:i + WIDTH] != b[i:i + WIDTH]) // WIDTH


def splitters(paths: DataFrame, shards: int, *, sample: int = SAMPLE) -> list[bytes]:
    """At most ``shards`` - 1 sorted separators; the driver receives ``sample`` paths of ``SPLIT_TURNS`` turns at most."""
    top = paths.select("path").orderBy(F.xxhash64("path"), "path").limit(min(sample, 32 * shards))
    got = sorted({bytes(r[0]) for r in top.select(F.substring("path", 1, WIDTH * SPLIT_TURNS)).collect()})
    at = sorted({len(got) * i // shards for i in range(1, shards)} - {0})
    return sorted({got[i][:WIDTH * (_shared(got[i - 1], got[i]) + 1)] for i in at})


class _Node:
    __slots__ = ("depth", "words", "skeleton", "n", "least", "children", "leaves", "saved", "sha", "kids")

    def __init__(self, depth: int, words: int, skeleton: bool):
        self.depth, self.words, self.skeleton = depth, words, skeleton
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.sha, self.kids = None, None, []


def _shard_nodes(batches, splits: list[bytes]):
    """Sorted paths to node rows: finished nodes, and partial rows (``key`` set) of skeleton nodes."""
    open_nodes: list[_Node] = []
    path, shard, out = b"", None, []

    def close(depth: int):
        """Close the open nodes deeper than ``depth``."""
        while open_nodes and open_nodes[-1].depth > depth:
            v = open_nodes.pop()
            up = open_nodes[-1] if open_nodes else None
            if v.skeleton:
                out.append((path[:WIDTH * v.depth], None, v.words, v.least, v.depth, None, v.n, v.children, v.leaves, v.saved, v.sha))
            else:
                v.saved += (v.n - 1) * v.words
                v.leaves = v.leaves or 1
                out.extend(k[:5] + (v.least,) + k[6:] for k in v.kids)
                up.children += 1
                row = (None, None, None, v.least, v.depth, None, v.n, v.children, v.leaves, v.saved, v.sha or NOBODY)
                if up.skeleton:
                    out.append((None, path[:WIDTH * up.depth], *row[2:]))
                else:
                    up.kids.append(row)
            if up is not None:
                up.n += v.n
                up.least = v.least if up.least is None else min(up.least, v.least)
                up.leaves += v.leaves
                up.saved += v.saved

    for batch in batches:
        for s, p, words, n, least, sha in zip(*(c.to_pylist() for c in batch.columns)):
            if s != shard:
                close(-1)
                shard, keep = s, -1
            else:
                keep = _shared(path, p)
                close(keep)
            path = p
            # proper prefixes of the splitters on both sides of the path
            known = max([0, *(min(_shared(p, x), len(x) // WIDTH - 1) for x in splits[max(0, s - 1):s + 1])])
            for d in range(keep + 1, len(p) // WIDTH + 1):
                open_nodes.append(_Node(d, words[d - 1] if d else 0, d <= known))
            end = open_nodes[-1]
            end.sha, end.n, end.least = sha, end.n + n, least if end.least is None else min(end.least, least)
            while len(out) >= OUT_ROWS:
                yield _batch(out[:OUT_ROWS], _NODE)
                del out[:OUT_ROWS]
    close(-1)
    for a in range(0, len(out), OUT_ROWS):
        yield _batch(out[a:a + OUT_ROWS], _NODE)


def trie(seqs: DataFrame, *, shards: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """One row per node of the sequences (conv_id, keys, words): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    shards = shards or partitions(seqs.sparkSession)
    paths = cut_lineage(distinct_paths(seqs))
    splits = splitters(paths, shards, sample=sample)

    def deal(batches):
        for batch in batches:
            at = pa.array([bisect_right(splits, p) for p in batch.column(0).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([at, *batch.columns], names=["shard", *batch.schema.names])

    dealt = paths.select("path", "words", "n", "least", "sha").mapInArrow(
        deal, "shard int, path binary, words array<long>, n long, least long, sha string")
    rows = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path").mapInArrow(
        lambda batches: _shard_nodes(batches, splits), _NODE_SQL)
    rows = cut_lineage(rows)

    # the skeleton: sums over the shards, then own contributions along its edges
    part = rows.where(F.col("key").isNotNull()).groupBy("key", "depth").agg(
        F.max("words").alias("words"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("ends_sha256").alias("sha"))
    part = cut_lineage(part)
    prefix = F.substring(F.col("key"), F.lit(1), (WIDTH * F.col("up")).cast("int"))
    above = part.select("key", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("own"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col("depth"))).alias("up"))
    above = above.select(prefix.alias("key"), "own", (F.col("up") == F.col("depth") - 1).cast("long").alias("child"))
    above = above.groupBy("key").agg(F.sum("own").alias("own"), F.sum("child").alias("more"))
    names = small_side(part.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_least")))
    n_children = F.col("n_children") + F.col("more")
    skeleton = part.join(above, "key").select(
        F.when(F.col("depth") > 0, F.substring(F.col("key"), F.lit(1), (WIDTH * (F.col("depth") - 1)).cast("int"))).alias("parent"),
        "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", n_children.alias("n_children"),
        F.when(n_children == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("own")).alias("saved_tokens"), F.coalesce("sha", F.lit(NOBODY)).alias("ends_sha256"))
    nodes = rows.where(F.col("key").isNull()).drop("key", "words").unionByName(skeleton)
    return nodes.join(names, F.col("parent") == F.col("parent_key"), "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "parent_least").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", "ends_sha256")
