"""Language identification: held-out accuracy and the defined cases."""

from pyspark.sql import functions as F

from scoria.llm import langid
from scoria.llm.catalog import QUERIES
from scoria.llm.common import crc_mod5


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = QUERIES["op9_language_id"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert got.count() == docs.count()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 and (r.rejected == (r.margin <= 0)) for r in rows)


def test_defined_cases(spark):
    words = {"en": "the cat and the dog went over there ", "de": "der hund und die katze gehen nicht "}
    rows = [(i, words[k] * 5, k, "x") for i, k in enumerate(["en", "de"] * 20)]
    rows += [(100, None, "en", "x"), (101, "", None, "x"), (102, "12 34 !!", None, "x"), (None, words["de"], None, "x"),
             (103, words["en"] * 20000, None, "x"), (103, words["en"] * 20000, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, margin string")
    model = langid.fit(docs, crc_mod5() != 0)
    assert sorted(model) == ["de", "en"]
    got = docs.select("doc_id", "lang", "margin", langid.identify(F.col("text"), model).alias("p")).collect()
    by = {r.doc_id: r.p for r in got}
    assert all(by[i].lang == "und" and by[i].rejected and by[i].score == 0 for i in (100, 101, 102))
    assert by[None].lang == "de" and by[103].lang == "en"
    assert all(r.p.lang == r.lang for r in got if r.doc_id is not None and r.doc_id < 100)


def test_narrow_margin_and_empty(spark):
    model = {"a": b"same words here", "b": b"same words here"}
    one = spark.createDataFrame([(1, "same words here")], "doc_id long, text string")
    p = one.select(langid.identify(F.col("text"), model).alias("p")).first().p
    assert p.lang == "a" and p.rejected and p.margin == 0
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.fit(none, crc_mod5() != 0) == {}
    assert one.select(langid.identify(F.col("text"), {}).alias("p")).first().p.lang == "und"


def test_rejects_unlearnt_and_mixed_keeps_clean(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, crc_mod5() != 0)
    held = docs.where((crc_mod5() == 0) & (F.length("text") > 1000)).select("text", "lang")
    by = {}
    for r in held.orderBy("doc_id").collect():
        if len(set(r.text.split())) > 50:  # not one line over and over
            by.setdefault(r.lang, []).append(r.text)
    half = [(by[a][i][:500] + " " + by[b][i][:500], a) for a in by for b in by if a < b for i in range(5)]
    long = [(" ".join(by[k][:8]), k) for k in by]

    def share(rows, model):
        one = spark.createDataFrame(rows, "text string, lang string").select("lang", langid.identify(F.col("text"), model).alias("p"))
        return sum(r.p.rejected for r in one.collect()) / len(rows)

    assert share(half, model) >= 0.75
    clean = [(t, k) for k in by for t in by[k]]
    assert share(clean, model) <= 0.01 and share(long, model) == 0
    for k in by:
        assert share([(t, k) for t in by[k]], {x: d for x, d in model.items() if x != k}) >= 0.9
