"""MinHash groups against all pairs; stars in hard buckets, small sets and the defined cases."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoria.llm import minhash
from scoria.llm.catalog import QUERIES
from tests.llm.brute import LOWER, TOKEN


def shingles(text, k=3):
    ws = TOKEN.findall((text or "").translate(LOWER))
    return frozenset(" ".join(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))) if ws else frozenset()


def plain(rows, percent=85):
    """rows (id, text) -> sorted (id, size of the set, component)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def run(spark, rows, **kw):
    got = minhash.groups(spark.createDataFrame(rows, "doc_id long, text string"), **kw)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr)


def test_query_against_all_pairs(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_minhash_dedup"](spark, sf).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_group_of_uneven_copies(spark):
    """Copies edited in different places: many share buckets, some with no link but through others."""
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for d in range(120):
        ws = list(base)
        for i in rnd.sample(range(90), rnd.randrange(0, 8)):
            ws[i] = f"x{rnd.randrange(9)}"
        rows.append((d, " ".join(ws)))
    chain = [f"c{i}" for i in range(60)]
    for d in range(200, 225):  # each step is a link, the ends are far apart
        chain = chain[1:] + [f"n{d}"]
        rows.append((d, " ".join(chain)))
    rnd.shuffle(rows)
    assert run(spark, rows) == plain(rows)


def test_small_sets(spark):
    """Sets of a few shingles, on both sides of the threshold (6 of 7 is a link, 5 of 6 is none)."""
    rnd = random.Random(1)
    rows = []
    for d in range(0, 240, 2):
        n = rnd.randrange(1, 12)
        ws = [f"a{rnd.randrange(6)}" for _ in range(n)]
        rows += [(d, " ".join(ws)), (d + 1, " ".join(ws + ["end"] if d % 4 else ws[:-1]))]
    assert run(spark, rows) == plain(rows)


def test_signature_estimates_similarity():
    rnd = np.random.default_rng(4)
    for n in (8, 60, 3000):
        got = []
        for _ in range(60):
            every = rnd.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2)
            a, b = np.unique(every[:n + n // 2]), np.unique(every[n // 2:])
            got.append((minhash.signature(a) == minhash.signature(b)).mean())
        assert abs(np.mean(got) - 0.5) < 0.05
    one = minhash.signature(np.array([77], np.uint64))
    assert (one == 77).all() and len(one) == minhash.BINS


@pytest.mark.parametrize("growth,forest", [(2, 100_000), (1000, 3)])
def test_rounds_of_centres(spark, growth, forest, monkeypatch):
    """All nodes in one bucket: every pair across components must be compared, whatever the centres."""
    monkeypatch.setattr(minhash, "FOREST_LINKS", forest)
    rnd = random.Random(growth)
    sets = [sorted(rnd.sample(range(30), rnd.choice([12, 13, 14]))) for _ in range(60)]
    sets = [list(s) for s in {tuple(s) for s in sets}]
    sets += [sorted({*s[:-1], 99}) for s in sets[:20]]
    rows = [(bytes([i]), s) for i, s in enumerate(sets)]
    every = spark.createDataFrame(rows, "node binary, s array<long>")
    distinct = every.select("node", F.size("s").cast("long").alias("n"), F.array(F.lit(1).cast("long"), F.lit(2).cast("long")).alias("keys"))
    got = {bytes(r.node): bytes(r.root) for r in minhash.links(distinct, lambda w: every.join(w, "node"), growth=growth).collect()}
    comp = list(range(len(sets)))
    for i, j in combinations(range(len(sets)), 2):
        both = len({*sets[i]} & {*sets[j]})
        if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
            a, b = comp[i], comp[j]
            comp = [min(a, b) if c in (a, b) else c for c in comp]
    assert [got.get(bytes([i]), bytes([i])) for i in range(len(sets))] == [bytes([c]) for c in comp]


def test_defined_cases(spark):
    long = " ".join(f"v{i % 5003}" for i in range(120_000))
    rows = [(5, None), (3, ""), (9, " \t"), (2, "one two"), (None, "one two"), (2, "One two"), (None, "alone here now then"),
            (7, long), (6, long.upper()), (8, "x y z"), (1, "x y Z"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "'k' AS keys", "2 AS root")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in minhash.groups(df).collect()), key=repr)
    assert got == plain(rows)
    assert minhash.groups(df.limit(0)).count() == 0
