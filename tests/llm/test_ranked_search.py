"""Ranked search against a plain scorer; limits on accumulators, blocks, ties and the defined cases."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from scoria.llm import ranked_search
from scoria.llm.catalog import QUERIES
from tests.llm.brute import words


def plain(docs, items, k=10):
    """docs (id, text), items (id, text) -> sorted (item, rank, id, score)."""
    held = [(d, Counter(words(t)), len(words(t))) for d, t in docs]
    held = [x for x in held if x[2]]
    n_docs, n_terms = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in {(i, t or "") for i, t in items}:
        scores = []
        for d, c, n in held:
            s = 0
            for t in set(words(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def run(docs, items, **kw):
    return sorted((tuple(r) for r in ranked_search.search(docs, items, **kw).collect()), key=repr)


def test_query_against_plain_scores(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op13_ranked_search"](spark, sf).collect()), key=repr)
    assert got == plain(docs, items)


@pytest.mark.parametrize("block_docs,max_terms", [(3, 1000), (50, 4), (1000, 1000)])
def test_blocks_ties_and_repeats(spark, block_docs, max_terms):
    rnd = random.Random(block_docs)
    some = [f"t{i}" for i in range(30)]
    docs = [(rnd.randrange(40) if i % 11 else None, " ".join(rnd.choices(some, range(1, 31), k=rnd.randrange(0, 9)))) for i in range(150)]
    docs += [(7, "t1 t2 t2"), (7, "t1 t2 t2"), (5, "t1 t2 t2"), (3, None), (4, "--"), (900, "t3 " * 5000)]
    items = [(i, " ".join(rnd.choices(some, k=5))) for i in range(12)] + [(3, "t1 t29"), (50, "T1, t1 T2!"), (51, None), (52, "absent")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS item", "1 AS score", "2 AS `key`").repartition(3)
    q = spark.createDataFrame(items + items[:2], "item_id long, text string").selectExpr("*", "0 AS terms")
    assert run(d, q, k=4, block_docs=block_docs, max_terms=max_terms) == plain(docs, items, k=4)


def test_accumulators_are_limited_and_exact():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        n, k = int(rnd.integers(1, 60)), int(rnd.integers(1, 6))
        parts, full = [], np.zeros(n, np.int64)
        for size in rnd.integers(1, n + 1, int(rnd.integers(1, 8))):
            at = np.sort(rnd.choice(n, size, replace=False))
            got = rnd.integers(0, int(rnd.choice([3, 50, 2000])), size).astype(np.int64)
            parts.append((at, got))
            full[at] += got
        floor = int(rnd.integers(1, 100))
        docs, scores = ranked_search.term_at_a_time(parts, n, k, floor)
        assert (full[docs] == scores).all() and (scores >= floor).all()
        best = sorted(((-s, i) for i, s in enumerate(full) if s >= floor))[:k]
        assert {i for _, i in best} <= set(docs.tolist())
    # a rare term that decides: the documents of the frequent one get no accumulator
    rare, common = (np.arange(3), np.full(3, 900, np.int64)), (np.arange(1000), np.full(1000, 5, np.int64))
    assert ranked_search.term_at_a_time([rare, common], 1000, 3)[0].tolist() == [0, 1, 2]


def test_scores_beyond_64_bits_are_whole():
    tf, n = np.array([3, 1]), np.array([5_000_000, 7])
    got = ranked_search.part_scores(tf, n, 20_000, 10**13, 10**16)
    assert got.tolist() == [20_000 * (10**9 * t // (1000 * t + 8 * (10 + 90 * m * 10**13 // 10**16))) for t, m in zip(tf.tolist(), n.tolist())]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert run(none, items) == [] and run(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)) == []
    assert run(none.unionByName(spark.createDataFrame([(1, None)], "doc_id long, text string")), items) == []
