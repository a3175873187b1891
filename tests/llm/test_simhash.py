"""SimHash groups against all pairs; shards, dense groups and the defined cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoria.llm import simhash
from scoria.llm.catalog import QUERIES
from tests.llm import brute


def test_query_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fps = [(r.doc_id, brute.fingerprint(r.text)) for r in docs]
    want = {(d, f"{f:016x}", c) for (d, f), c in zip(fps, brute.component_ids(fps))}
    assert {tuple(r) for r in QUERIES["op6_simhash_dedup"](spark, sf).collect()} == want


@pytest.mark.parametrize("shard_rows", [4, 64, 10_000])
def test_links_of_dense_and_sparse_prints(spark, shard_rows):
    rnd = random.Random(5)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    for c in [rnd.getrandbits(64) for _ in range(4)]:  # groups that are close to each other and far from others
        fps |= {c ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(80)}
        x = c
        for _ in range(30):  # a chain of single steps
            x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps |= {0, 1, (1 << 64) - 1, (1 << 63)}
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(f,) for f in signed], "fp long")
    tree = simhash.fit_tree(prints, sample=256, shard_rows=shard_rows)
    got = {r.node: r.root for r in simhash.components(simhash.links(prints, tree)).collect()}
    ids = brute.component_ids([(f, f % (1 << 64)) for f in signed])
    label = lambda xs: {frozenset(i for i, x in enumerate(xs) if x == y) for y in xs}
    assert label([got.get(f, f) for f in signed]) == label(ids)


def test_leaf_splits_in_memory():
    rnd = np.random.default_rng(1)
    fps = np.unique(np.concatenate((rnd.integers(0, 1 << 63, 3000).astype(np.uint64), np.uint64(77) ^ (np.uint64(1) << rnd.integers(0, 12, 3000).astype(np.uint64)))))
    at = np.arange(len(fps))
    pairs = {(int(min(x, y)), int(max(x, y))) for a, b in simhash._meet(fps, at, at[:0], 2) for x, y in zip(a, b)}
    d = np.bitwise_count(fps[:, None] ^ fps[None, :])
    want = {(int(i), int(j)) for i, j in zip(*np.nonzero(d <= 2)) if i < j}
    assert pairs == want


def test_defined_cases(spark):
    rows = [(5, None, "a"), (3, "", "b"), (9, " \t", "c"), (2, "one two", "d"), (None, "one two", "e"), (2, "one two", "d"),
            (None, "alone here now then", "f"), (7, "w " * 300_000, "g"), (6, "W " * 200_000, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.groups(docs).collect()
    fps = [(d, brute.fingerprint(t)) for d, t, _ in rows[:7]]
    by = {(r.doc_id, f"{r.fp % (1 << 64):016x}", r.component_id) for r in got}
    for (d, f), c in zip(fps, brute.component_ids(fps)):
        assert (d, f"{f:016x}", c) in by
    assert len(got) == len(rows) and {r.component_id for r in got if r.doc_id in (6, 7)} == {6}
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.groups(none).count() == 0


def test_fingerprint_of_whole_long_text(spark):
    text = " ".join(f"w{i % 977}" for i in range(200_000))
    one = spark.createDataFrame([(text,)], "text string").select(simhash.fingerprint(F.col("text")).alias("f")).first().f
    assert one % (1 << 64) == brute.fingerprint(text)
