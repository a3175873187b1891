"""Personal data: base spans by the plain patterns, and discovery by contexts."""

from hypothesis import given, settings
from hypothesis import strategies as st

from scoria.llm import pii
from scoria.llm.catalog import QUERIES
from tests.llm import brute


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1. -@+()9é\n%", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == brute.pii_spans(text)


def test_base_spans_of_examples():
    for t in ["a@b@c.d", "a@b.c.@d.e", "x@y.z@w.v", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.3.4", "4111 1111 1111 1111 5", "+1 (741) 555-3069.",
              "+1 2", "4111-1111-1111-1111", "1" * 3000 + ".1.1.1", "+" * 50 + "1" * 12, "000000000000"]:
        assert pii.base_spans(t) == brute.pii_spans(t)
    assert pii.base_spans("9" * 300_000 + "@" * 300_000) == []


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op5_pii_bootstrap"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute.pii_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        assert set(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want) <= set(r.spans.split(",")) if want else True


def test_contexts_discover(spark):
    rows = [(i, f"Bitte Telefon dienstlich: +49 {i} 555 30{i}9 anrufen", "x") for i in range(100, 112)]
    rows += [(1, "Bitte Telefon dienstlich: 0049-30-1234567 anrufen", "x"), (2, "Los Nummer 0049-30-1234568 anrufen", "x"),
             (3, None, "x"), (4, "", "x"), (None, "Bitte Telefon dienstlich: 0049-30-1234567 anrufen", "x"),
             (5, "und " * 50_000 + "Telefon dienstlich: 0049-30-1234569", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k string")
    got = {r.doc_id: r for r in pii.extract(docs).collect()}
    assert [tuple(s) for s in got[1].added] == [(26, 3, 41)] and got[None].added == got[1].added
    assert [(s.k, s.end - s.start) for s in got[5].added] == [(3, 15)]
    assert not got[2].added and not got[3].added and not got[4].base
    assert all([tuple(s) for s in got[i].base] == brute.pii_spans(t) for i, t, _ in rows)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pii.extract(none).count() == 0
