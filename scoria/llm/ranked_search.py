"""Ranked lexical search: term at a time over blocks of documents, with limited accumulators.

Each task cuts its documents into blocks and keeps, per block, the
postings of the query terms alone (term -> documents and occurrences) and
the number of terms of every document; these blocks are stored once.  The
number of documents, their length and the document frequencies are summed
from the blocks.  Then each task reads its blocks, and for each item its
terms from the rarest to the most frequent, adding whole numbers to one
accumulator per document.  A term adds at most the largest of its
postings' parts in the block.  When the terms that remain cannot lift a
new document to the k-th best score known so far (of the partial scores in
this block and of the blocks read before), no accumulators are created any
more; those that can still reach it are updated exactly.  Ties are kept,
so the best k are exact; every task returns k rows per item at most.

Items are taken in blocks by hash, so that the terms given to all tasks
are at most some ``MAX_TERMS``; each block of items is one more reading.

Defined cases: a null text has no terms, and its document is not counted;
documents are rows: repeated rows are documents of their own, with ranks
of their own, and rows of one id and score are ranked one after the other;
a null document id ranks last among equals; an item without terms gives no
row; items of equal id and text are one item, items of equal id and other
text are ranked apart; empty tables give an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoria.llm.common import ALNUM, col, pack, unpack, utf8
from scoria.session import cut_lineage

__all__ = ["search", "part_scores", "term_at_a_time", "MAX_TERMS", "BLOCK_DOCS", "BLOCK_TERMS"]

#: Terms of items that one reading of the documents serves (an item is not cut).
MAX_TERMS = 200_000
#: A block of documents is closed after so many documents, or postings.
BLOCK_DOCS = 8192
BLOCK_TERMS = 2_000_000
_BLOCK = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("terms", pa.list_(pa.int32())),
                    ("dfs", pa.list_(pa.int64())), ("docs", pa.list_(pa.binary()))])
_BLOCK_SQL = "n_docs long, n_terms long, terms array<int>, dfs array<long>, docs array<binary>"
_TOP = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
#: Between terms, before A-Z are lower-cased.
GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, item, terms): one row per distinct item with its distinct terms."""
    low = F.translate(F.coalesce(col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    it = items.select(col(id_col).alias("item"), F.array_distinct(F.array_remove(F.split(low, GAP), "")).alias("terms"),
                      F.md5(F.coalesce(col(text_col), F.lit(""))).alias("text"))
    return it.where(F.size("terms") > 0).dropDuplicates(["item", "text"]).select(
        F.xxhash64("item", "text").alias("key"), "item", "terms")


def _blocks(docs: DataFrame, terms: dict[bytes, int], block_docs: int, block_terms: int) -> DataFrame:
    """Stored blocks: documents and terms of each, and the postings of ``terms`` sorted by term."""
    def cut(batches):
        ids, sizes, where, which, times = [], [], [], [], []

        def close():
            t = np.array(which, np.int32)
            order = np.argsort(t, kind="stable")
            t = t[order]
            edges = np.concatenate(([0], np.nonzero(np.diff(t))[0] + 1, [len(t)])) if len(t) else np.zeros(1, int)
            row = [len(sizes), sum(sizes), t[edges[:-1]], np.diff(edges), [
                pack(np.array([i or 0 for i in ids], np.int64)), pack(np.array([i is not None for i in ids], np.uint8)),
                pack(np.array(sizes, np.int64)), pack(np.array(where, np.int32)[order]), pack(np.array(times, np.int64)[order])]]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _BLOCK)], schema=_BLOCK)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                ws = text.translate(ALNUM).split()
                if not ws:
                    continue
                found: dict[int, int] = {}
                for t in map(terms.get, ws):
                    if t is not None:
                        found[t] = found.get(t, 0) + 1
                where += [len(ids)] * len(found)
                which += found.keys()
                times += found.values()
                ids.append(doc)
                sizes.append(len(ws))
                if len(ids) >= block_docs or len(which) >= block_terms:
                    yield close()
                    ids, sizes, where, which, times = [], [], [], [], []
        if ids:
            yield close()

    return docs.mapInArrow(cut, _BLOCK_SQL)


def part_scores(tf: np.ndarray, n: np.ndarray, w: int, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term of weight ``w`` adds to documents of ``n`` terms that hold it ``tf`` times, in whole numbers."""
    most = int(max(n.max(initial=0), tf.max(initial=0)))
    if 90 * most * n_docs >= 1 << 63 or 1_000_000_000 * most >= 1 << 63:  # beyond 64 bits: Python's whole numbers
        n, tf = n.astype(object), tf.astype(object)
    m = 100 - 90 + (90 * n * n_docs) // n_terms
    return (w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))).astype(np.int64)


def term_at_a_time(parts: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a block that may belong to the best k: those of at least ``floor`` and the k-th best.

    ``parts`` are (documents, what they get) per term, rarest term first.
    """
    rest = np.cumsum([0] + [int(p.max(initial=0)) for _, p in parts[::-1]])[::-1]  # rest[j]: most that terms j.. can add
    if rest[0] < floor:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    acc, least = np.zeros(n_docs, np.int64), floor
    for j, (docs, part) in enumerate(parts):
        acc[docs] += part
        if rest[0] - rest[j + 1] > rest[j + 1] and n_docs > k:  # else the k-th score cannot pass what remains
            least = max(least, int(np.partition(acc, n_docs - k)[n_docs - k]))
        if rest[j + 1] < least:
            break
    # no new accumulators from here on
    alive = np.nonzero(acc + rest[j + 1] >= least)[0]
    acc = acc[alive]
    for j in range(j + 1, len(parts)):
        docs, part = parts[j]
        at = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
        hit = docs[at] == alive
        acc[hit] += part[at[hit]]
        keep = acc + rest[j + 1] >= least
        alive, acc = alive[keep], acc[keep]
    keep = acc >= least
    return alive[keep], acc[keep]


def _best(ids: np.ndarray, known: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest scores, ties to smaller ids, null ids last."""
    return np.lexsort((ids, ~known, -scores))[:k]


def search(docs: DataFrame, items: DataFrame, *, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", max_terms: int = MAX_TERMS,
           block_docs: int = BLOCK_DOCS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of each item."""
    spark = docs.sparkSession
    queries = cut_lineage(_item_terms(items, item_id, item_text))
    total = queries.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    turns = max(1, -(-total // max_terms))
    d = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    found = [_search_block(d, queries.where(F.pmod("key", F.lit(turns)) == b), k, block_docs, block_terms) for b in range(turns)]
    found = [f for f in found if f is not None]
    kind = queries.schema["item"].dataType.simpleString()
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    by = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    out = out.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    out = out.join(queries.select("key", "item"), "key")
    return out.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def _search_block(docs: DataFrame, queries: DataFrame, k: int, block_docs: int, block_terms: int) -> DataFrame | None:
    """(key, doc_id, score): each task's best k of every item of one block of items."""
    got = queries.select("key", "terms").orderBy("key").collect()
    if not got:
        return None
    names = sorted({t for r in got for t in r.terms})
    number = {t: i for i, t in enumerate(names)}
    blocks = cut_lineage(_blocks(docs, {t.encode(): i for t, i in number.items()}, block_docs, block_terms))
    n_docs, n_terms = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    if not n_docs:
        return None
    df = np.zeros(len(names), np.int64)
    counted = blocks.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).groupBy("x.terms").agg(F.sum("x.dfs").alias("df"))
    for r in counted.collect():  # a row per query term at most
        df[r.terms] = r.df
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in df.tolist()]
    # rarest first; a term without documents adds nothing
    asked = [(r.key, sorted((i for i in map(number.get, r.terms) if df[i]), key=lambda i: (df[i], i))) for r in got]

    def score(batches):
        best = [(np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)) for _ in asked]
        for batch in batches:
            for row in batch.to_pylist():
                ids, known, size, where, times = (unpack(x, t) for x, t in zip(row["docs"], (np.int64, np.uint8, np.int64, np.int32, np.int64)))
                known = known == 1
                edges = np.cumsum([0] + row["dfs"])
                place = {t: (a, b) for t, a, b in zip(row["terms"], edges.tolist(), edges[1:].tolist())}
                parts = {t: (where[a:b], part_scores(times[a:b], size[where[a:b]], weight[t], n_docs, n_terms)) for t, (a, b) in place.items()}
                for i, (_, ts) in enumerate(asked):
                    own = [parts[t] for t in ts if t in parts]
                    if not own:
                        continue
                    at_ids, at_known, at = best[i]
                    new, s = term_at_a_time(own, len(ids), k, max(1, int(at[-1])) if len(at) >= k else 1)
                    if not len(new):
                        continue
                    all_ids, all_known, all_s = (np.concatenate(x) for x in ((at_ids, ids[new]), (at_known, known[new]), (at, s)))
                    top = _best(all_ids, all_known, all_s, k)
                    best[i] = all_ids[top], all_known[top], all_s[top]
        for (key, _), (ids, known, s) in zip(asked, best):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), key, np.int64)), pa.array(ids, mask=~known), pa.array(s)], schema=_TOP)

    return blocks.mapInArrow(score, "key long, doc_id long, score long")
