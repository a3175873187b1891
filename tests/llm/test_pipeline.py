"""The pipeline's stages on sf0.001: schema, decisions against plain re-statements, odd rows."""

import corpus_pipeline as cp
from pyspark.sql import functions as F
from tests.llm import brute


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = cp.language_id(spark, docs, sf).cache()
    assert one.columns == docs.columns and docs.count() * 0.97 <= one.count() <= docs.count()
    two = cp.simhash_dedup(spark, one, sf).cache()
    have = list(rows(one).values())
    comp = brute.component_ids([(r.doc_id, brute.fingerprint(r.text)) for r in have])
    assert rows(two) == {r.doc_id: r for r, c in zip(have, comp) if r.doc_id == c}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    three = cp.decontamination(spark, two, sf).cache()
    assert rows(three) == {d: r for d, r in rows(two).items() if not brute.window_hits(r.text, items)[0]}
    four = cp.secrets(spark, three, sf).cache()
    secret = {d: [v for *_, v in brute.secret_spans(r.text)] for d, r in rows(three).items()}
    owners = {}
    for d, vs in secret.items():
        for v in vs:
            owners.setdefault(v, set()).add(rows(three)[d].source)
    assert set(rows(four)) == {d for d, vs in secret.items() if all(len(owners[v]) > 2 for v in vs)}
    five = cp.mix(spark, four, sf)
    hashes = four.select("doc_id", F.xxhash64("text").alias("h")).collect()
    assert {(r.doc_id, r.text_hash) for r in five.collect()} == {(r.doc_id, r.h) for r in hashes}
    assert [n for n, _ in cp.STAGES] == ["language_id", "simhash_dedup", "decontamination", "secret_scan", "mixing"]


def test_run_equals_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, f in cp.STAGES:
        docs = f(spark, docs, sf)
    assert sorted(map(tuple, docs.collect()), key=str) == sorted(map(tuple, cp.run(spark, sf).collect()), key=str)


def test_odd_rows(spark, sf):
    base = spark.read.parquet(f"{sf}/documents.parquet").limit(60).select("doc_id", "text", "lang", "source")
    long = base.first().text
    odd = spark.createDataFrame([(None, long + " token=abcdefgh1", "en", None), (None, None, None, None), (10**6, "", "en", "s"), (10**6 + 1, long * 50, "en", "s"),
                                 (10**6 + 2, long + " unlike words", None, "s"), (10**6 + 2, long + " unlike words", None, "s")], base.schema)
    docs = base.unionByName(odd).withColumns({"h": F.lit("x"), "fp": F.array(F.lit(1)), "__llm_lang": F.lit(1), "text_hash": F.lit("t"), "root.n": F.map_from_arrays(F.array(F.lit("a")), F.array(F.lit(1)))})
    for name, f in cp.STAGES[:-1]:
        out = f(spark, docs, sf).cache()
        assert out.columns == docs.columns and out.count() <= docs.count(), name
        docs = out
    assert docs.where("__llm_lang = 1").count() == docs.count()
    assert docs.where("doc_id = 1000002").count() <= 1
    for name, f in cp.STAGES:
        assert f(spark, docs.limit(0), sf).count() == 0, name
