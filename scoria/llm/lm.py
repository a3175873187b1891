"""Language-model scores by a weighted backoff automaton that is assembled per block of documents.

The model is an n-gram of a chosen order with Dirichlet smoothing, order by
order, ``P(w | h) = (c(hw) + mu * P(w | h')) / (c(h) + mu)``, where ``h'``
lacks the first word of ``h``, down to ``P(w) = (c(w) + 0.5) / (N + 0.5 (V
+ 1))``; all unseen words share one class, so each sums to one.  As an
automaton: a root state and one state per context of up to ``order - 1``
words (a text's begin counts as one); an arc per seen n-gram with its
log-probability; a failure arc from each state to that of ``h'`` with
weight ``log(mu / (c(h) + mu))``.  A text is read once from left to right:
each word takes the first arc met on the way down the failure arcs.

Counts cover all training documents.  A task cuts its documents into
blocks of bounded size and sends, to buckets by hash, its block's distinct
n-grams of each order with their counts; a bucket adds up what all blocks
sent and answers each block in the order it asked.  A block gets back
exactly the part of the automaton that its documents can reach, so nothing
of the model's size is broadcast or collected, and frequent words meet once
per block, not once per place.  N-grams travel as 64-bit hashes, arrays as
compressed columns, texts as word numbers and once only: they are cut a
second time beside the asking, which costs less than a second shuffle of
them.  There are as many buckets as the bytes of the texts need, whatever
the session's width.

Tokens: words are runs of non-space characters after lower-casing A-Z,
then one end token per text.  Defined cases: a null or empty text is the
end token alone; without training documents every count is 0 (the score is
that of one class); repeated rows count as often as they occur; a null id
is kept as null; an empty table gives an empty result.  The rows must come
in the same order whenever a partition is read again, as a scan's do; a
block that was cut otherwise is recognised by its digest and is an error,
never a wrong score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoria.llm.common import col, pack, partitions, unpack, utf8

__all__ = ["vocabulary", "score", "Automaton", "BLOCK_TOKENS", "MU", "ORDER"]

#: Tokens after which a task closes a block; it may pass it by one document.
BLOCK_TOKENS = 2_500_000
#: Distinct words a task holds before it sends them, while the vocabulary is counted.
HELD_WORDS = 400_000
#: Weight of the lower order in the smoothing, in tokens.
MU = 300.0
#: Longest n-gram of the model, in words.
ORDER = 3
#: Bytes of text, times the order, for each of the buckets that add up counts.
BUCKET_BYTES = 128_000_000
END, BEGIN = b"", b" "  # neither can be a word
_ROW = "bucket long, block long, kind int, digest long, parts array<binary>"
_SCHEMA = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("digest", pa.int64()),
                     ("parts", pa.list_(pa.binary()))])
TEXTS = 0  # kind of a row of texts; other kinds are the length of the n-grams


class _Ids(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _hashes(words) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _by_bucket(hashes: np.ndarray, n_buckets: int):
    """Slices of sorted hashes by bucket (ranges of the hash): (bucket, slice)."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    edges = np.searchsorted(bucket, np.arange(n_buckets + 1, dtype=np.uint64))
    return [(b, slice(edges[b], edges[b + 1])) for b in range(n_buckets) if edges[b] < edges[b + 1]]


def _gaps(hashes: np.ndarray) -> bytes:
    return pack(np.diff(hashes, prepend=np.uint64(0)))


def _ungaps(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def vocabulary(docs: DataFrame, train: Column, *, text_col: str = "text") -> tuple[int, int, int]:
    """(N, V, bytes): tokens of the training documents, end tokens included, distinct ones, and bytes of all texts."""
    buckets = partitions(docs.sparkSession)
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64()), ("size", pa.int64()), ("data", pa.binary())])

    def send(batches):
        words, n, size = set(), 0, 0

        def rows():
            h = np.sort(_hashes(words))
            cut = _by_bucket(h, buckets)
            out = {"bucket": [0, *[b for b, _ in cut]], "n": [n, *[0] * len(cut)], "size": [size, *[0] * len(cut)],
                   "data": [_gaps(h[:0]), *[_gaps(h[s]) for _, s in cut]]}
            return pa.RecordBatch.from_pydict(out, schema=schema)

        for batch in batches:
            for text, learn in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                size += len(text) + 1
                if not learn:
                    continue
                ws = text.lower().split()
                n += len(ws) + 1
                words.update(ws)
                words.add(END)
                if len(words) >= HELD_WORDS:
                    yield rows()
                    words, n, size = set(), 0, 0
        yield rows()

    def distinct(t: pa.Table) -> pa.Table:
        h = np.sort(np.concatenate([_ungaps(x) for x in t["data"].to_pylist()]))
        v = int((h[1:] != h[:-1]).sum()) + (len(h) > 0)
        return pa.table({"n": [sum(t["n"].to_pylist())], "size": [sum(t["size"].to_pylist())], "v": [v]})

    sent = docs.select(col(text_col).cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("learn")).mapInArrow(
        send, "bucket long, n long, size long, data binary")
    r = sent.groupBy("bucket").applyInArrow(distinct, "n long, size long, v long").agg(F.sum("n"), F.sum("v"), F.sum("size")).first()
    return r[0] or 0, r[1] or 0, r[2] or 0


def _grams(h: np.ndarray, tokens: np.ndarray, ends: np.ndarray, begin: np.uint64, order: int) -> list[np.ndarray]:
    """Hashes of the n-gram that ends at each place, for n = 1 .. order.

    A text's begin is its first word, but no n-gram of one word; where a
    text has no n-gram yet, the one of the order below stands.
    """
    grams = [h[tokens]]
    starts = np.concatenate(([0], ends[:-1]))
    place = np.arange(len(tokens)) - np.repeat(starts, np.diff(ends, prepend=0))
    for n in range(2, order + 1):
        before = np.empty_like(grams[0])
        before[1:] = grams[-1][:-1]
        if n == 2:
            before[starts] = begin
        gram = _pair_hash(before, grams[0])
        grams.append(gram if n == 2 else np.where(place >= n - 2, gram, grams[-1]))
    return grams


class Automaton:
    """States, arcs and failure arcs that a block can reach.

    ``counts[n - 1]`` are the training counts of its n-grams, which are
    numbered; a count of 0 is no arc.
    """

    def __init__(self, counts: list[np.ndarray], tokens: int, distinct: int, begins: float, mu: float):
        self.counts, self.begins, self.mu = counts, begins, mu
        self.root = np.log10((counts[0] + 0.5) / (tokens + 0.5 * (distinct + 1)))

    def traverse(self, arcs: list[np.ndarray], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count, root's log10-probability, automaton's log10-probability) of the word at each place.

        ``arcs[n - 1]`` holds the number of the n-gram that ends at each place.
        """
        starts = np.concatenate(([0], ends[:-1]))
        place = np.arange(len(arcs[0])) - np.repeat(starts, np.diff(ends, prepend=0))
        met = seen = self.counts[0][arcs[0]]
        root = out = self.root[arcs[0]]
        for n in range(2, len(arcs) + 1):
            state = np.empty_like(met)  # count of the state that the words before lead to
            state[1:] = met[:-1]
            if n == 2:
                state[starts] = self.begins
            met = self.counts[n - 1][arcs[n - 1]]
            fail = np.log10(self.mu / (state + self.mu))
            with np.errstate(divide="ignore"):
                arc = np.log10((met + self.mu * 10.0 ** out) / (state + self.mu))
            step = np.where(met > 0, arc, fail + out)
            out = step if n == 2 else np.where(place >= n - 2, step, out)
        return seen, root, out


def _blocks(batches, block_tokens: int):
    """Blocks of a task's documents: (block, ids, train flags, ends, words by number, hashes of the words, digest)."""
    part, seq = TaskContext.get().partitionId(), 0
    held: list = []

    def close(words):
        doc, learn, texts = zip(*held)
        tokens, h = np.concatenate(texts), _hashes(words)
        digest = xxhash.xxh64_intdigest(h.tobytes(), xxhash.xxh64_intdigest(tokens.tobytes())) >> 1
        return (part << 32) + seq, doc, np.array(learn), np.cumsum([len(t) for t in texts]), tokens, h, digest

    words, size = _Ids(), 0
    for batch in batches:
        for doc, learn, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))):
            ws = text.lower().split()
            ws.append(END)
            held.append((doc, bool(learn), np.fromiter(map(words.__getitem__, ws), np.int32, len(ws))))
            size += len(ws)
            if size >= block_tokens:
                yield close(words)
                held.clear()
                words, size, seq = _Ids(), 0, seq + 1
    if held:
        yield close(words)


def _rows(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def score(docs: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text", mu: float = MU, order: int = ORDER,
          block_tokens: int = BLOCK_TOKENS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: doc_id, train, n_tokens, n_known, train_tokens, base_score (unigram), score (automaton).

    ``order`` is the longest n-gram, in words; 1 is the unigram alone.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    n_all, n_distinct, size = vocabulary(docs, train, text_col=text_col)
    buckets = max(partitions(docs.sparkSession), -(-order * size // bucket_bytes))
    end, begin = np.uint64(xxhash.xxh64_intdigest(END)), np.uint64(xxhash.xxh64_intdigest(BEGIN))

    def ask(batches):
        """Each block's distinct n-grams and their counts in its training documents, to buckets."""
        for block, _, learn, ends, tokens, h, digest in _blocks(batches, block_tokens):
            learnt = np.repeat(learn, np.diff(ends, prepend=0))
            rows = []
            for n, gram in enumerate(_grams(h, tokens, ends, begin, order), 1):
                known, at = np.unique(gram, return_inverse=True)
                count = np.bincount(at[learnt], minlength=len(known)).astype(np.uint32)
                rows += [(b, block, n, digest, [_gaps(known[s]), pack(count[s])]) for b, s in _by_bucket(known, buckets)]
            yield _rows(rows)

    def texts(batches):
        """Each block's texts by word numbers, which fall with the frequency: so they compress better."""
        for block, doc, learn, ends, tokens, h, digest in _blocks(batches, block_tokens):
            by = np.argsort(-np.bincount(tokens, minlength=len(h)), kind="stable")
            number = np.empty(len(h), np.uint32)
            number[by] = np.arange(len(h))
            known = np.array([d is not None for d in doc])
            yield _rows([(-1, block, TEXTS, digest, [
                pack(number[tokens]), pack(ends.astype(np.int64)), pack(np.array([d or 0 for d in doc], np.int64)),
                pack(known.astype(np.uint8)), pack(learn.astype(np.uint8)), h[by].tobytes()])])

    def answer(t: pa.Table) -> pa.Table:
        """Counts over all blocks, to each block in the order it asked."""
        parts = t["parts"].to_pylist()
        asked = [_ungaps(p[0]) for p in parts]
        _, at = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([unpack(p[1], np.uint32) for p in parts])).astype(np.uint64)[at]
        edges = np.cumsum([0] + [len(a) for a in asked])
        out = [[pack(total[a:b])] for a, b in zip(edges, edges[1:])]
        return t.set_column(4, "parts", pa.array(out, pa.list_(pa.binary())))

    def read(answers: pa.Table, text: pa.Table) -> pa.Table:
        """Assemble the block's automaton and traverse its texts."""
        rows = sorted(answers.select(["kind", "bucket", "digest", "parts"]).to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
        if text.num_rows != 1 or {r["digest"] for r in rows} != set(text["digest"].to_pylist()):
            raise RuntimeError("a block was cut differently when it was read again")
        tokens, ends, doc, known, learn, h = text["parts"][0].as_py()
        tokens, ends, h = unpack(tokens, np.uint32), unpack(ends, np.int64), np.frombuffer(h, np.uint64)
        hashes, arcs = zip(*(np.unique(g, return_inverse=True) for g in _grams(h, tokens, ends, begin, order)))
        counts = [np.concatenate([unpack(r["parts"][0], np.uint64) for r in rows if r["kind"] == n]).astype(np.float64)
                  for n in range(1, order + 1)]
        auto = Automaton(counts, n_all, n_distinct, counts[0][np.searchsorted(hashes[0], end)], mu)
        seen, base, full = auto.traverse(arcs, ends)
        starts = np.concatenate(([0], ends[:-1]))
        add = lambda x: np.add.reduceat(x, starts)
        return pa.table({
            "doc_id": pa.array(unpack(doc, np.int64), mask=unpack(known, np.uint8) == 0),
            "train": unpack(learn, np.uint8) == 1, "n_tokens": ends - starts,
            "n_known": add((seen > 0).astype(np.int64)), "base_score": add(base), "score": add(full)})

    d = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"),
                    col(text_col).cast("string").alias("text"))
    answered = d.mapInArrow(ask, _ROW).groupBy("bucket", "kind").applyInArrow(answer, _ROW)
    out = answered.groupBy("block").cogroup(d.mapInArrow(texts, _ROW).groupBy("block")).applyInArrow(
        read, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(n_all).cast("long"))
