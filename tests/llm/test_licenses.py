"""Licence scan: base places against a plain search, passages, and the defined cases."""

from scoria.llm import licenses
from scoria.llm.catalog import QUERIES
from tests.llm import brute

TEXTS = licenses.PASSAGES


def base(text):
    ws = brute.words(text)
    return sorted((i, licenses.PHRASES[p]) for p in licenses.PHRASES for n in [len(p.split())]
                  for i in range(len(ws) - n + 1) if ws[i:i + n] == p.split())


def index(docs):
    vocab = {w for t in [*licenses.PHRASES, *(p for p, _ in TEXTS.values())] for w in t.split()}
    return licenses.Index(*licenses.document_frequencies(docs, vocab))


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op1_license_scan"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = base(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (len(brute.words(texts[r.doc_id])), len(want))
        assert (r.first_word, r.last_word) == ((want[0][0], want[-1][0]) if want else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in want}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert sum(r.n_base > 0 for r in got) > 10


def test_passages_and_cases(spark):
    bsd, mit = TEXTS["bsd"][0], TEXTS["mit-text"][0]
    loose = bsd.replace("permitted", "hereby allowed and also permitted")
    rows = [(1, "x " * 40 + bsd.upper()), (2, loose), (3, " ".join(sorted(bsd.split()))), (4, None), (5, ""),
            (6, "MIT-License; the mit   license\nmit License"), (7, "mít license"), (None, mit), (1, "x " * 40 + bsd.upper()),
            (8, "license " * 50_000 + "mit license"), (9, bsd.replace("must retain", "may drop"))]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, hits string")
    got = [(r.doc_id, r.n_words, [(h.label, h.start, h.end) for h in r.hits]) for r in licenses.scan(docs, index(docs)).collect()]
    by = {d: (n, h) for d, n, h in got}
    n = len(bsd.split())
    assert len(got) == len(rows) and by[1] == (40 + n, [("bsd", 40, 40 + n)])
    assert [h[0] for h in by[2][1]] == ["bsd"] and by[3][1] == [] and by[9][1] == []
    assert by[4] == by[5] == (0, []) and by[7][1] == []
    assert [h for h in by[6][1]] == [("mit", 0, 2), ("mit", 3, 5), ("mit", 5, 7)]
    assert [h[0] for h in by[None][1]] == ["mit-text"] and by[8][1] == [("mit", 50_000, 50_002)]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.document_frequencies(none, {"mit"}) == (0, {}) and licenses.scan(none, index(docs)).count() == 0


def test_words_of_a_passage_before_it():
    """One to six words of a passage in front of it leave the passage where it stands."""
    found = licenses.Index(1000, {})
    for label, (text, _) in TEXTS.items():
        words = text.encode().split()
        assert any(h[0] == label and h[2:4] == (0, len(words)) for h in found.find(words)), label
        for k in range(1, 7):
            for j in range(0, max(1, len(words) - k), 3):
                hits = [h for h in found.find(words[j:j + k] + words) if h[0] == label]
                assert any(h[2] <= k and h[3] >= len(words) and h[4] > 0.999 for h in hits), (label, k, j)


def test_two_copies_are_two_hits():
    words = TEXTS["bsd"][0].encode().split()
    n = len(words)
    hits = [h[2:4] for h in licenses.Index(1000, {}).find(words + words) if h[0] == "bsd"]
    assert hits == [(0, n), (n, 2 * n)]
