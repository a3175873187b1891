"""Exact top-k: against SQL on the table, and against all pairs on ties, odd shapes and large values."""

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from scoria.llm import topk
from scoria.llm.catalog import ORACLES, QUERIES
from scoria.plans.check import compare, duck


def test_query_against_sql(spark, sf):
    got = compare(spark, duck(sf), "op2", QUERIES["op2_exact_top_k"], ORACLES["op2_exact_top_k"], sf)
    assert got["ok"], got


def brute(rows, k, scale=64):
    whole = lambda x: math.floor(scale * Fraction(x))
    ok = [(i, [whole(x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, (q, a) in enumerate(ok):
        if q % 5 == 0:
            score = lambda b: max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b))))
            best = sorted((-score(b), c) for j, (c, b) in enumerate(ok) if i != j and len(a) == len(b))[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return sorted(out)


def run(spark, rows, k, **kw):
    v = spark.createDataFrame([(i, v, "r") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    return sorted(tuple(r) for r in topk.top_k(v, F.col("vec_id") % 5 == 0, k=k, **kw).collect())


def test_ties_repeats_and_odd_rows(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-1.0, 0.0, 0.5]) for _ in range(6)]) for i in range(300)]
    rows += [(i, [1.0] * 6) for i in range(300, 500)] + rows[:40]
    rows += [(5, [0.25] * 6), (600, None), (601, []), (602, [None] * 6), (603, [math.nan] * 6), (604, [math.inf] * 6),
             (None, [1.0] * 6), (605, [1.0, 2.0]), (606, [3.0, -4.0]), (610, [1.0])]
    for block in (16, 4096):
        assert run(spark, rows, 7, block=block) == brute(rows, 7)


def test_wide_vectors_and_large_values(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 1) * (1 + i % 3) for _ in range(37)]) for i in range(400)]
    assert run(spark, rows, 20, block=100) == brute(rows, 20)
    large = [(i, [rnd.gauss(0, 1) * 1e6 for _ in range(5)]) for i in range(60)]
    assert run(spark, large, 5) == brute(large, 5)


def test_huge_components_and_repeated_rows(spark):
    rows = [(0, [1e301, 1.0]), (5, [1e18, -2.5]), (10, [-1e18, 0.1]), (10, [-1e18, 0.1]), (1, [1.7e308, 0.0]), (2, [0.3, 0.2]), (3, [3e15, 1.0])]
    assert run(spark, rows, 3) == brute(rows, 3)
    same = [(5, [1.0, 2.0])] * 3 + [(4, [1.0, 2.0])] * 2
    got = run(spark, same, 9)
    assert got == brute(same, 9) and len(got) == 12


def test_empty(spark):
    assert run(spark, [], 3) == [] and run(spark, [(1, [1.0]), (2, [2.0])], 3) == []
