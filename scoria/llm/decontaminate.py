"""Benchmark decontamination with a positional inverted index (DataFrame functions only).

The test side is cut into windows of consecutive words.  Every window is
represented by its rarest terms, by their number of places in the whole
corpus.  The index holds the postings (term, document, position) of those
rare terms only, over all documents; lists of one window are intersected
after subtracting each term's offset, and what is left is compared word
for word (exact) or reported as a proximity match, where two of the rarest
three terms of a window stand nearly as far apart as in the item and most of its
other words stand around.  ``near_report`` returns both from one reading,
``report`` the exact half.  The pipeline drops
documents by exact matches alone: two rare terms near each other are a
hint for a reader, not proof of a copy.

Documents are addressed by (id, xxhash64 of the text), so repeated rows
share their result and no row number is needed.

Defined cases: null texts have no words and match nothing; an item without
words has no window and is never found; an item shorter than a window is
one window of its own length; empty tables give empty results (no items:
every document is clean); a null item id is written as the empty text;
items with equal text are found together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoria.llm.common import col
from scoria.session import cut_lineage

__all__ = ["words", "windows", "term_counts", "rare_terms", "postings", "matches", "exact_matches", "proximity_matches",
           "report", "near_report", "WINDOW", "SLACK", "MAX_BROADCAST_ROWS"]

WINDOW = 10
#: Words by which the distance of two rare terms may differ from the item's.
SLACK = 5
#: Share of a window's distinct words that must stand around a near place.
MIN_SHARE = 0.6
#: The test side is broadcast up to so many rows (some 200 bytes each); beyond, Spark shuffles the join.
MAX_BROADCAST_ROWS = 100_000
#: What stands between words, before A-Z are lower-cased.
GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text, as written (null: none)."""
    # only the first and the last piece can be empty
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def windows(items: DataFrame, *, id_col: str = "item_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """(item_id string, at, n, phrase): the windows of each item; phrase is lower-cased and space-joined."""
    it = items.select(F.coalesce(col(id_col).cast("string"), F.lit("")).alias("item_id"),
                      words(F.translate(col(text_col), UPPER, LOWER)).alias("w")).where(F.size("w") > 0)
    it = it.select("item_id", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - n + 1))).alias("at"))
    return it.select("item_id", (F.col("at") - 1).alias("at"),
                     F.slice("w", F.col("at"), n).alias("ws")).select(
        "item_id", "at", F.size("ws").alias("n"), F.array_join("ws", " ").alias("phrase"))


def _few(df: DataFrame) -> bool:
    """Whether a test-side table may be broadcast, by its counted rows."""
    return df.count() <= MAX_BROADCAST_ROWS


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if _few(df) else df


def term_counts(docs: DataFrame, wins: DataFrame, *, text_col: str = "text") -> DataFrame:
    """(term, places): places in the whole corpus of each test term, 0 included."""
    terms = wins.select(F.explode(F.split("phrase", " ")).alias("term")).select(F.lower("term").alias("term")).distinct()
    terms = cut_lineage(terms)
    # outer: else a filter on the words is pushed down, and every text is split twice
    found = docs.select(F.explode_outer(words(col(text_col))).alias("raw")).select(F.lower("raw").alias("term"))
    seen = found.join(_small(terms), "term").groupBy("term").agg(F.count("*").alias("places"))
    return cut_lineage(terms.join(seen, "term", "left").select("term", F.coalesce("places", F.lit(0)).alias("places")))


def rare_terms(wins: DataFrame, counts: DataFrame, k: int = 2) -> DataFrame:
    """The ``k`` rarest terms of each distinct window phrase: (phrase, n, rare), rarest first, with their offsets.

    Ties go to the smaller offset, so that neighbouring windows do not
    needlessly choose different terms.
    """
    ph = wins.select("phrase", "n").distinct()
    at = ph.select("phrase", "n", F.posexplode(F.split("phrase", " ")).alias("off", "raw"))
    at = at.select("phrase", "n", "off", F.lower("raw").alias("term")).join(counts, "term")
    best = at.groupBy("phrase", "n").agg(F.sort_array(F.collect_list(F.struct("places", "off", "term"))).alias("t"))
    return best.select("phrase", "n", F.slice("t", 1, k).alias("rare"))


def postings(docs: DataFrame, terms: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(term, doc_id, h, pos, ws): places of the given terms in all documents.

    ``ws`` is the document's words; it is only read where a later filter in
    the same stage keeps the row, and must be dropped before any shuffle.
    """
    d = docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text_col)).alias("h"),
                    words(col(text_col)).alias("ws"))
    d = d.select("doc_id", "h", "ws", F.posexplode_outer("ws").alias("pos", "raw"))
    return d.withColumn("term", F.lower("raw")).join(terms, "term")


def exact_matches(docs: DataFrame, rare: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, phrase, start, n): every exact occurrence of a window.

    The rarest term's postings give the aligned start; the next rare term
    must stand at its own offset from there, then the whole phrase is compared.
    """
    second = F.try_element_at("rare", F.lit(2))
    key = cut_lineage(rare.select(
        F.col("rare")[0]["term"].alias("term"), F.col("rare")[0]["off"].alias("off"), "phrase", "n",
        F.coalesce(second["off"], F.col("rare")[0]["off"]).alias("off2"),
        F.coalesce(second["term"], F.col("rare")[0]["term"]).alias("term2")))
    start = F.col("pos") - F.col("off")
    if not _few(key):
        return _exact_shuffled(docs, postings(docs, key, id_col=id_col, text_col=text_col).where(start >= 0).select(
            "doc_id", "h", "phrase", start.alias("start"), "n"), id_col=id_col, text_col=text_col)
    p = postings(docs, F.broadcast(key), id_col=id_col, text_col=text_col)
    met = p.where((start >= 0) & (start + F.col("n") <= F.size("ws")) &
                  (F.lower(F.try_element_at("ws", start + F.col("off2") + 1)) == F.col("term2")))
    met = met.where(_phrase_at(F.col("ws"), F.greatest(start, F.lit(0)), F.col("n")) == F.col("phrase"))
    return met.select("doc_id", "h", "phrase", start.alias("start"), "n").distinct()


def _phrase_at(ws: Column, start: Column, n: Column) -> Column:
    return F.translate(F.array_join(F.slice(ws, start + 1, n), " "), UPPER, LOWER)


def _exact_shuffled(docs: DataFrame, aligned: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """The same for a test side that is too large to broadcast: alignments are brought to their document,
    whose words stay in one row."""
    at = aligned.distinct().groupBy("doc_id", "h").agg(F.collect_list(F.struct("phrase", "start", "n")).alias("at")).alias("a")
    d = docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text_col)).alias("h"),
                    words(col(text_col)).alias("ws")).alias("d")
    both = d.join(at, F.col("d.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("d.h") == F.col("a.h")))
    met = F.filter("at", lambda x: _phrase_at(F.col("ws"), x["start"], x["n"]) == x["phrase"])
    return both.select("d.doc_id", "d.h", F.explode(met).alias("m")).select("doc_id", "h", "m.*").distinct()


def _pairs_of(rare: DataFrame) -> DataFrame:
    """(phrase, n, i, term, off, term2, off2): the pairs of a window's rare terms; a lone term is paired with itself."""
    key = rare.select("phrase", "n", "rare", F.posexplode("rare").alias("i", "a"))
    key = key.select("phrase", "n", "i", "a", F.size("rare").alias("of"), F.posexplode("rare").alias("j", "b")).where("i < j OR of = 1")
    return cut_lineage(key.select("phrase", "n", "i", "j", F.col("a.term").alias("term"), F.col("a.off").alias("off"),
                                  F.col("b.term").alias("term2"), F.col("b.off").alias("off2")))


def _lower_slice(ws: Column, first: Column, end: Column) -> Column:
    """The words [first, end) of a document in lower case, cut at its ends."""
    first = F.greatest(first, F.lit(0))
    return F.split(F.lower(F.array_join(F.slice(ws, first + 1, F.greatest(end - first, F.lit(0))), " ")), " ")


def _dense(ws: Column, phrase: Column, start: Column, n: Column, slack: int) -> Column:
    """Whether the words around a window's place hold ``MIN_SHARE`` of its distinct words."""
    own = F.array_distinct(F.split(F.lower(phrase), " "))
    return F.size(F.array_intersect(own, _lower_slice(ws, start - slack, start + n + slack))) >= F.ceil(MIN_SHARE * F.size(own))


def matches(docs: DataFrame, rare: DataFrame, *, slack: int = SLACK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, phrase, start, n, exact): where windows stand word for word, and where they nearly do.

    Near is a place where two of the window's three rarest terms stand within ``slack`` words of their
    distance in the item, and the words from ``slack`` before to ``slack`` after the window hold ``MIN_SHARE``
    of its distinct words; ``start`` is aligned by the rarer of the two, and a place is not its own second term.
    One of the three rare terms may so be missing.  Both kinds come from one reading of the documents,
    with the words of a document beside its postings.
    """
    key = _pairs_of(rare)
    if not _few(key):
        return _matches_shuffled(docs, rare, key, slack=slack, id_col=id_col, text_col=text_col)
    p = postings(docs, F.broadcast(key), id_col=id_col, text_col=text_col)
    start, second, ws = F.col("pos") - F.col("off"), F.col("pos") - F.col("off") + F.col("off2"), F.col("ws")
    first, end = F.greatest(second - slack, F.lit(0)), second + slack + 1
    part = lambda a, b: F.slice("ws", a + 1, F.greatest(b - a, F.lit(0)))
    # the words around the second term's place, the first term's own excepted; no lambda over the words, as
    # generated code keeps one array of them a document where other code copies it with every row
    around = F.concat(part(first, F.least(end, F.col("pos"))), part(F.greatest(first, F.col("pos") + 1), end))
    there = F.array_contains(F.split(F.lower(F.array_join(around, " ")), " "), F.col("term2"))
    exact = (start >= 0) & (start + F.col("n") <= F.size("ws")) & (
        F.lower(F.try_element_at(ws, start + F.col("off2") + 1)) == F.col("term2")) & (
        _phrase_at(ws, F.greatest(start, F.lit(0)), F.col("n")) == F.col("phrase"))
    met = p.where(exact | (there & _dense(ws, F.col("phrase"), start, F.col("n"), slack)))
    return met.select("doc_id", "h", "phrase", start.alias("start"), "n", F.coalesce(exact, F.lit(False)).alias("exact")).distinct()


def proximity_matches(docs: DataFrame, rare: DataFrame, *, slack: int = SLACK, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(doc_id, h, phrase, near): the number of near places of each window, those word for word excepted."""
    met = matches(docs, rare, slack=slack, id_col=id_col, text_col=text_col).where(~F.col("exact"))
    return met.groupBy("doc_id", "h", "phrase").agg(F.count("*").alias("near"))


def _matches_shuffled(docs: DataFrame, rare: DataFrame, key: DataFrame, *, slack: int, id_col: str, text_col: str) -> DataFrame:
    """The same for a test side that is too large to broadcast.  Lists are matched by position blocks of
    ``slack`` + 1 words, so a term that is frequent in a document does not meet all places of the other; what
    is near is brought to its document, whose words stay in one row."""
    two = key.where("i < j").select("phrase", "n", "i", "j", F.posexplode(F.array(F.struct("term", "off"), F.struct(
        F.col("term2").alias("term"), F.col("off2").alias("off")))).alias("which", "r"))
    two = two.select("phrase", "n", "i", "j", "which", "r.term", "r.off")
    p = postings(docs, cut_lineage(two), id_col=id_col, text_col=text_col)
    p = p.select("doc_id", "h", "phrase", "n", "i", "j", "which", "pos", (F.col("pos") - F.col("off")).alias("start")).distinct()
    block = F.floor(F.col("start") / (slack + 1))
    a = p.where("which = 0").select("doc_id", "h", "phrase", "n", "i", "j", F.col("start").alias("s0"), F.col("pos").alias("p0"), block.alias("b"))
    b = p.where("which = 1").select("doc_id", "h", "phrase", "i", "j", F.col("start").alias("s1"), F.col("pos").alias("p1"),
                                    F.explode(F.array(block - 1, block, block + 1)).alias("b"))
    same = [F.col("a." + c).eqNullSafe(F.col("b." + c)) for c in ("doc_id", "h", "phrase", "i", "j", "b")]
    on = same[0] & same[1] & same[2] & same[3] & same[4] & same[5]
    met = a.alias("a").join(b.alias("b"), on).where((F.abs(F.col("s0") - F.col("s1")) <= slack) & (F.col("p0") != F.col("p1")))
    met = met.select("a.doc_id", "a.h", "a.phrase", F.col("s0").alias("start"), "a.n").distinct()
    at = met.groupBy("doc_id", "h").agg(F.collect_list(F.struct("phrase", "start", "n")).alias("at")).alias("a")
    d = docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text_col)).alias("h"),
                    words(col(text_col)).alias("ws")).alias("d")
    both = d.join(at, F.col("d.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("d.h") == F.col("a.h")))
    near = F.filter("at", lambda x: _dense(F.col("ws"), x["phrase"], x["start"], x["n"], slack))
    near = both.select("d.doc_id", "d.h", F.explode(near).alias("m")).select("doc_id", "h", "m.*", F.lit(False).alias("exact"))
    exact = exact_matches(docs, rare, id_col=id_col, text_col=text_col).withColumn("exact", F.lit(True))
    every = near.unionByName(exact).groupBy("doc_id", "h", "phrase", "start", "n").agg(F.max("exact").alias("exact"))
    return every


def report(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", n: int = WINDOW) -> DataFrame:
    """(doc_id, h, n_hit, item_ids): the contaminated documents, their hit words and the items found in them."""
    wins, rare = _index(docs, items, text_col=text_col, item_id=item_id, item_text=item_text, n=n)
    return _exact_report(cut_lineage(exact_matches(docs, rare, id_col=id_col, text_col=text_col)), wins)


def near_report(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                item_id: str = "item_id", item_text: str = "text", n: int = WINDOW,
                slack: int = SLACK) -> tuple[DataFrame, DataFrame]:
    """``report`` and (doc_id, h, n_near, near_ids): the places near a window that is not there word for word,
    summed over the distinct windows, and the items of those windows, for documents with any."""
    wins, rare = _index(docs, items, text_col=text_col, item_id=item_id, item_text=item_text, n=n, k=3)
    met = cut_lineage(matches(docs, rare, slack=slack, id_col=id_col, text_col=text_col))
    near = met.where(~F.col("exact")).groupBy("doc_id", "h", "phrase").agg(F.count("*").alias("near"))
    by_item = wins.select("phrase", "item_id").distinct()
    ids = near.join(by_item, "phrase").groupBy("doc_id", "h").agg(
        F.sort_array(F.collect_set("item_id")).alias("near_ids")).alias("i")
    s = near.groupBy("doc_id", "h").agg(F.sum("near").alias("n_near")).alias("s")
    near = s.join(ids, F.col("s.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("s.h") == F.col("i.h"))).select(
        "s.doc_id", "s.h", "n_near", "near_ids")
    return _exact_report(met.where("exact").drop("exact"), wins), near


def _index(docs: DataFrame, items: DataFrame, *, text_col: str, item_id: str, item_text: str, n: int, k: int = 2):
    """The windows of the items and their rarest terms."""
    wins = cut_lineage(windows(items, id_col=item_id, text_col=item_text, n=n))
    return wins, cut_lineage(rare_terms(wins, term_counts(docs, wins, text_col=text_col), k))


def _exact_report(met: DataFrame, wins: DataFrame) -> DataFrame:
    """(doc_id, h, n_hit, item_ids) of exact matches."""
    # words hit: the union of [start, start + n), folded over the sorted starts
    spans = met.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("s"))
    hit = F.aggregate("s", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit")), lambda a, x: F.struct(
        F.greatest(a["end"], x["end"]).alias("end"),
        (a["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["end"]))).alias("hit")), lambda a: a["hit"])
    by_item = wins.select("phrase", "item_id").distinct()
    ids = met.select("doc_id", "h", "phrase").distinct().join(by_item, "phrase").groupBy("doc_id", "h").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    s, i = spans.select("doc_id", "h", hit.alias("n_hit")).alias("s"), ids.alias("i")
    return s.join(i, F.col("s.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("s.h") == F.col("i.h"))).select(
        "s.doc_id", "s.h", "n_hit", "item_ids")
