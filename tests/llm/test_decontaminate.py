"""Decontamination: exact windows against SQL and a plain search, proximity, and the defined cases."""

import itertools
import math

from scoria.llm import decontaminate as dc
from scoria.llm.catalog import ORACLES, QUERIES
from scoria.plans.check import compare, duck
from tests.llm import brute


def test_query_against_sql(spark, sf):
    got = compare(spark, duck(sf), "op8", QUERIES["op8_decontamination"], ORACLES["op8_decontamination"], sf)
    assert got["ok"], got


ITEMS = {1: "alpha beta Gamma delta epsilon zeta eta theta iota kappa lambda mu", 2: "the the the the the the the the the the the",
         3: "short ITEM here", 4: None, 5: "", 6: "Élan vital élan vital", 7: "alpha beta gamma delta epsilon zeta eta theta iota kappa"}
DOCS = [(1, "x alpha-beta gamma DELTA epsilon, zeta eta theta iota kappa lambda y"), (2, "the " * 25), (3, None), (4, ""),
        (5, "a Short item\nhere short item here"), (6, "élan vital élan vital"), (7, "ÉLAN VITAL élan vital Élan vital élan vital"), (None, "short item here"),
        (5, "a Short item\nhere short item here"), (8, "alpha beta gamma delta epsilon zeta eta theta iota"), (9, "word " * 60_000 + ITEMS[1]),
        (10, "alpha beta gamma delta NEW epsilon zeta eta theta iota kappa lambda mu")]


def frames(spark):
    return (spark.createDataFrame([(d, t, "z") for d, t in DOCS], "doc_id long, text string, term string"),
            spark.createDataFrame([(i, t, "z") for i, t in ITEMS.items()], "item_id long, text string, pos string"))


def test_report_against_plain_search(spark):
    docs, items = frames(spark)
    got = {(r.doc_id, r.h): (r.n_hit, list(r.item_ids)) for r in dc.report(docs, items).collect()}
    from pyspark.sql import functions as F
    keys = docs.select("doc_id", F.xxhash64("text").alias("h"), "text", F.size(dc.words(F.col("text"))).alias("n")).collect()
    for r in keys:
        want = brute.window_hits(r.text, {i: t for i, t in ITEMS.items() if t})
        assert got.get((r.doc_id, r.h), (0, [])) == want, r.doc_id
        assert r.n == len(brute.words(r.text))


def test_proximity(spark):
    docs, items = frames(spark)
    wins = dc.windows(items).where("item_id = '1'")
    rare = dc.rare_terms(wins, dc.term_counts(docs, wins))
    near = dc.proximity_matches(docs, rare, slack=3).collect()
    assert {r.doc_id for r in near} >= {10} and 6 not in {r.doc_id for r in near}
    assert all(r.near >= 1 for r in near)
    exact = {(r.doc_id, r.phrase, r.start) for r in dc.exact_matches(docs, rare).collect()}
    assert (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", 1) in exact and 10 not in {d for d, _, _ in exact}


def test_empty_and_native(spark):
    docs, items = frames(spark)
    assert dc.report(docs, items.limit(0)).count() == 0 and dc.report(docs.limit(0), items).count() == 0
    plan = dc.report(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_broadcast_is_checked(spark, monkeypatch):
    docs, items = frames(spark)
    want = sorted(tuple(r) for r in dc.report(docs, items).select("doc_id", "n_hit").fillna(-1).collect())
    monkeypatch.setattr(dc, "MAX_BROADCAST_ROWS", 0)
    assert sorted(tuple(r) for r in dc.report(docs, items).select("doc_id", "n_hit").fillna(-1).collect()) == want


def test_registered_proximity(spark, tmp_path):
    docs, items = frames(spark)
    alpha = ITEMS[1].split()
    # a word of every window of ten is changed: no exact match, but a near one
    changed = spark.createDataFrame([(20, " ".join(alpha[:5] + ["NEW"] + alpha[6:]), "z"), (21, "the cat", "z")], docs.schema)
    docs.unionByName(changed).write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in QUERIES["op8_decontamination"](spark, str(tmp_path)).collect()}
    assert not got[20].contaminated and got[20].n_near > 0 and "1" in got[20].near_items.split(",")
    assert got[10].n_near > 0 and (got[21].n_near, got[21].n_near_items, got[21].near_items) == (0, 0, "")
    again = QUERIES["op8_near_decontamination"](spark, str(tmp_path)).collect()
    assert sorted(again, key=repr) == sorted(QUERIES["op8_decontamination"](spark, str(tmp_path)).collect(), key=repr)


def test_planted_edits(spark, sf):
    """Benchmark passages with every eighth word changed, dropped or doubled are found; other documents are left alone."""
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    long = [(r.item_id, r.text.split()) for r in items.collect() if len(brute.words(r.text)) >= 20]
    edits = [lambda ws, i: ["changed"], lambda ws, i: [], lambda ws, i: [ws[i], ws[i]]]
    planted = []
    for k, (item, ws) in enumerate(long):
        new = [x for i, w in enumerate(ws) for x in (edits[k % 3](ws, i) if i % 8 == 5 else [w])]
        planted.append((10**6 + k, str(item), "before it " * 30 + " ".join(new) + " after it" * 30))
    every = spark.createDataFrame(docs + [(d, t) for d, _, t in planted], "doc_id long, text string")
    exact, near = dc.near_report(every, items)
    exact, near = {r.doc_id for r in exact.collect()}, {r.doc_id: set(r.near_ids) for r in near.collect()}
    caught = sum(item in near.get(d, ()) for d, item, _ in planted)
    assert len(planted) >= 10 and caught >= 0.9 * len(planted), (caught, len(planted))
    own = {d for d, _ in docs}
    false = [d for d in near if d in own and d not in exact]
    assert len(false) <= 0.02 * len(own), len(false)


def test_proximity_against_plain_search(spark, monkeypatch):
    docs, items = frames(spark)
    wins = dc.windows(items)
    rare = dc.rare_terms(wins, dc.term_counts(docs, wins), 3).cache()
    want = {}
    for r in rare.collect():
        for d, text in set(DOCS):
            ws, near = [w.lower() for w in brute.words(text)], set()
            for (_, o0, t0), (_, o1, t1) in itertools.combinations(r.rare, 2):
                near |= {p - o0 for p, w in enumerate(ws) if w == t0 and any(
                    q != p and 0 <= q < len(ws) and ws[q] == t1 for q in range(p - o0 + o1 - 3, p - o0 + o1 + 4))}
            own = lambda r, s: set(r.phrase.lower().split()) & set(ws[max(s - 3, 0):max(s + r.n + 3, 0)])
            near = [s for s in near if len(own(r, s)) >= math.ceil(dc.MIN_SHARE * len(set(r.phrase.lower().split())))]
            near = [s for s in near if s < 0 or " ".join(brute.words(text)[s:s + r.n]) != r.phrase]
            if near:
                want[d, r.phrase] = len(near)
    assert any(d == 10 for d, _ in want)
    for limit in (dc.MAX_BROADCAST_ROWS, 0):
        monkeypatch.setattr(dc, "MAX_BROADCAST_ROWS", limit)
        got = {(r.doc_id, r.phrase): r.near for r in dc.proximity_matches(docs, rare, slack=3).collect()}
        assert got == want
