"""Language model: counts and scores against a plain dictionary model; probabilities sum to one."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoria.llm import lm
from scoria.llm.common import crc_mod5, pack, unpack


def brute(rows, mu, order):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    toks = [(d, t, re.findall("[^\x20\x09-\x0d]+", (x or "").translate(lower)) + [""]) for d, x, t in rows]
    uni, gram, ctx = Counter(), Counter(), Counter()
    for _, t, ws in toks:
        if t:
            uni.update(ws)
            padded = [None] + ws
            for n in range(2, order + 1):
                for i in range(n, len(padded) + 1):
                    gram[tuple(padded[i - n:i])] += 1
                    ctx[tuple(padded[i - n:i - 1])] += 1
    n, v = sum(uni.values()), len(uni)

    def p(h, w):
        if not h:
            return (uni[w] + 0.5) / (n + 0.5 * (v + 1))
        return (gram[(*h, w)] + mu * p(h[1:], w)) / (ctx[h] + mu)

    for d, t, ws in toks:
        base = sum(math.log10(p((), w)) for w in ws)
        padded = [None] + ws
        s = sum(math.log10(p(tuple(padded[max(0, i - order + 1):i]), padded[i])) for i in range(1, len(padded)))
        yield d, t, len(ws), sum(uni[w] > 0 for w in ws), n, base, s


def check(spark, rows, mu=50.0, order=lm.ORDER, **kw):
    docs = spark.createDataFrame([(d, x, t, "c") for d, x, t in rows], "doc_id long, text string, t boolean, train string")
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
    got = sorted((tuple(r[c] for c in ("doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"))
                  for r in lm.score(docs, F.col("t"), mu=mu, order=order, **kw).collect()), key=key)
    want = sorted(brute(rows, mu, order), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        np.testing.assert_allclose(g[5:], w[5:], rtol=1e-9)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert crc_mod5 is not None
    check(spark, [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 5 != 1) for r in docs], block_tokens=3000)


@pytest.mark.parametrize("order", [1, 2, 4])
def test_orders_and_many_buckets(spark, order):
    texts = ["a b a b a c", "b a b", "a", "", "a b a b a c", None, "c a b a b a", "new words a b a"]
    rows = [(i, x, i % 3 != 2) for i, x in enumerate(texts * 3)]
    check(spark, rows, mu=2.0, order=order, block_tokens=9, bucket_bytes=20)


def test_a_block_cut_otherwise_is_an_error(spark):
    docs = spark.createDataFrame([(i, f"a b {i}") for i in range(8)], "doc_id long, text string").coalesce(1)
    noise = F.udf(lambda: os.urandom(4).hex()).asNondeterministic()
    with pytest.raises(Exception, match="cut differently"):
        lm.score(docs.withColumn("text", F.concat_ws(" ", "text", noise())), F.lit(True), order=2).collect()


def test_defined_cases(spark):
    rows = [(1, "A bÉ a\tb", True), (2, None, True), (3, "", False), (None, "a b", True), (1, "A bÉ a\tb", True),
            (4, "zz \x1f a", False), (5, "the " * 50000, True), (6, "  ", True)]
    check(spark, rows)
    check(spark, rows, block_tokens=1)
    check(spark, [(d, x, False) for d, x, _ in rows])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(empty, F.lit(True)).count() == 0


def test_arcs_sum_to_one():
    """After any state, the words' probabilities and the unseen class's sum to one."""
    texts = [[1, 2, 1, 3, 0], [2, 1, 2, 0], [1, 2, 1, 0]]
    h = np.array([11, 22, 33, 44], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    tokens, ends, begin = np.concatenate(texts), np.cumsum([len(t) for t in texts]), np.uint64(7)
    hashes, counts = zip(*(np.unique(g, return_counts=True) for g in lm._grams(h, tokens, ends, begin, 3)))
    n, v = len(tokens), 4
    for before in ([1, 2], [2], [1, 2, 1], []):
        steps = [[*before, w] for w in range(4)]
        grams = lm._grams(h, np.concatenate(steps), np.cumsum([len(s) for s in steps]), begin, 3)
        # n-grams that no text holds have count 0
        known, arcs = zip(*(np.unique(g, return_inverse=True) for g in grams))
        full = [np.array([dict(zip(a, c)).get(x, 0) for x in k], float) for k, a, c in zip(known, hashes, counts)]
        out = lm.Automaton(full, n, v, 3.0, 10.0).traverse(arcs, np.cumsum([len(s) for s in steps]))[2]
        total = sum(10 ** out[np.cumsum([len(s) for s in steps]) - 1])
        # the unseen class: the failure arcs alone, down to the root
        held = [sum(1 for t in texts for i in range(len(t)) if ([None] + t)[max(0, i + 1 - k):i + 1] == ([None] + before)[-k:])
                for k in (1, 2) if k <= len(before) + 1]
        unseen = 0.5 / (n + 0.5 * (v + 1))
        for c in held:
            unseen *= 10.0 / (c + 10.0)
        assert abs(total + unseen - 1) < 1e-12


def test_pack_round_trip():
    for a in (np.arange(1000, dtype=np.uint64) ** 5, np.empty(0, np.uint32), np.array([7], np.int64)):
        assert (unpack(pack(a), a.dtype) == a).all()
