"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

Seeds are the base matches (email, ip, card, phone).  The words and marks
in front of a seed are its lexical patterns (the last word, and the last
two).  Identifier-like tokens outside base matches are instances without a
kind.  Spark scores the graph of patterns and instances in rounds: a
pattern's confidence for a kind is the mean score of its distinct
instances, an instance's score is the noisy-or of its confident patterns;
seeds keep score 1 for their own kind.  Patterns with enough support and
confidence then mark the instances behind them that look like the kind.

Defined cases: a null text is empty and has no spans; repeated rows count
once as instances, and each row gets its spans; ties in place go by kind
as listed; an empty table, or one without seeds, only has base spans.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoria.llm.common import col
from scoria.session import cut_lineage

__all__ = ["KINDS", "base_spans", "scan", "edges", "confident_patterns", "extract"]

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_WORD = re.compile(r"[^\W\d_]+")
#: Characters in front of an identifier that are read for its context.
REACH = 48


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        done = m.end() if m else at + 1
        if m:
            yield start, done
        at = text.find("@", done)


def _digits_run_starts(pattern, text):
    """Matches of a pattern of digit runs; tried at the start of a run only, where any match must begin."""
    at, search = 0, re.compile(r"[0-9]+").search
    while m := search(text, at):
        got = pattern.match(text, m.start())
        if got:
            yield got
        at = got.end() if got else m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base matches of one text, sorted."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _MARK.search(text):
        out += [(m.start(), 1, m.end()) for m in _digits_run_starts(_IP, text)
                if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0]) if m.end() - m.start() <= 64 else ""
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return sorted(out)


def _contexts(text: str, start: int) -> list[str]:
    """The lexical patterns in front of a place: last word, and last two, with what stands between."""
    left = text[max(0, start - REACH):start]
    line = left.rfind("\n") + 1
    words = [w.start() for w in _WORD.finditer(left, line)]
    if words and words[0] == 0 and start > REACH:
        del words[0]  # it may have begun before
    return [re.sub(r"\s+", " ", re.sub("[0-9]", "0", left[w:])).lower() for w in words[-2:]]


def _shape(token: str) -> int:
    """The kinds that a token could be, one bit each."""
    n = sum(map(str.isdigit, token))
    return (1 if "@" in token else 0) | (2 if n >= 3 and token.count(".") + token.count(":") >= 2 else 0) | \
        (4 if n >= 10 else 0) | (8 if n >= 7 else 0)


def _others(text: str, spans):
    """Identifier-like tokens outside the spans: (start, end, shape)."""
    at, k = 0, 0
    while m := _MARK.search(text, at):
        a = m.start()
        while a > at and not text[a - 1].isspace():
            a -= 1
        e = _SPACE.search(text, m.end())
        at = e.start() if e else len(text)
        while k < len(spans) and spans[k][2] <= a:
            k += 1
        if k < len(spans) and spans[k][0] < at:
            continue
        s, b = a, at
        while s < b and not text[s].isalnum() and text[s] not in "+(":
            s += 1
        while b > s and not text[b - 1].isalnum():
            b -= 1
        shape = _shape(text[s:b])
        if shape:
            yield s, b, shape


_SPAN = pa.struct([("start", pa.int64()), ("k", pa.int32()), ("end", pa.int64())])
_INST = pa.struct([("patterns", pa.list_(pa.string())), ("value", pa.int64()), ("start", pa.int64()), ("k", pa.int32()),
                   ("end", pa.int64()), ("shape", pa.int32())])
SCHEMA = ("rid long, doc_id long, base array<struct<start:long,k:int,end:long>>, "
          "inst array<struct<patterns:array<string>,value:long,start:long,k:int,end:long,shape:int>>")


def _value(token: str) -> int:
    return xxhash.xxh64_intdigest(token.lower().encode()) - (1 << 63)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: rid, doc_id, base spans, and instances (k is -1 for those that are no seeds)."""
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("base", pa.list_(_SPAN)), ("inst", pa.list_(_INST))])

    def run(batches):
        for batch in batches:
            base, inst = [], []
            for text in batch.column(2).to_pylist():
                text = text or ""
                spans = base_spans(text)
                base.append([dict(zip(("start", "k", "end"), s)) for s in spans])
                tokens = [(a, k, b, 0) for a, k, b in spans] + [(a, -1, b, s) for a, b, s in _others(text, spans)]
                inst.append([{"patterns": ps, "value": _value(text[a:b]), "start": a, "k": k, "end": b, "shape": s}
                             for a, k, b, s in tokens if (ps := _contexts(text, a))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(base, schema.field(2).type),
                                              pa.array(inst, schema.field(3).type)], schema=schema)

    d = docs.select(F.monotonically_increasing_id().alias("rid"), col(id_col).cast("long").alias("doc_id"),
                    col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, SCHEMA)


def edges(scanned: DataFrame) -> DataFrame:
    """(pattern, value, k, shape): distinct pairs of a pattern and an instance."""
    one = scanned.select(F.explode("inst").alias("i")).select("i.*")
    return one.select(F.explode("patterns").alias("pattern"), "value", "k", "shape").distinct()


def confident_patterns(graph: DataFrame, *, rounds: int = 3, min_support: float = 3.0, min_confidence: float = 0.6,
                       keep: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Patterns (pattern, k, confidence) and instances (value, k, score) after the rounds."""
    all_of = graph.groupBy("pattern").agg(F.count_distinct("value").alias("n"))
    seeds = graph.where("k >= 0").select("value", "k", F.lit(1.0).alias("score")).distinct()
    fresh = graph.where("k < 0").select("pattern", "value", "shape").distinct()
    scores, patterns = seeds, None
    pairs = graph.select("pattern", "value").distinct()
    for _ in range(rounds):
        support = pairs.join(scores, "value").groupBy("pattern", "k").agg(F.sum("score").alias("support"))
        patterns = cut_lineage(support.where(F.col("support") >= min_support).join(all_of, "pattern").select(
            "pattern", "k", F.least(F.lit(1.0), F.col("support") / F.col("n")).alias("confidence")).where(
            F.col("confidence") >= min_confidence))
        found = fresh.join(patterns, "pattern").where(F.expr("shape & shiftleft(1, k)") > 0)
        doubt = F.sum(F.log(F.greatest(F.lit(1e-6), 1 - F.col("confidence"))))
        found = found.groupBy("value", "k").agg((1 - F.exp(doubt)).alias("score"))
        scores = cut_lineage(seeds.union(found.join(seeds.select("value").distinct(), "value", "left_anti")))
    return patterns, scores.where(F.col("score") >= keep)


def extract(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3,
            min_support: float = 3.0, min_confidence: float = 0.6, keep: float = 0.8) -> DataFrame:
    """One row per document: doc_id, base (start, k, end) and added spans, sorted."""
    scanned = cut_lineage(scan(docs, id_col=id_col, text_col=text_col))
    patterns, good = confident_patterns(cut_lineage(edges(scanned)), rounds=rounds, min_support=min_support,
                                        min_confidence=min_confidence, keep=keep)
    new = scanned.select("rid", F.explode("inst").alias("i")).where("i.k < 0").select(
        "rid", "i.start", "i.end", "i.value", "i.shape", F.explode("i.patterns").alias("pattern"))
    new = new.join(patterns.select("pattern", "k"), "pattern").where(F.expr("shape & shiftleft(1, k)") > 0)
    new = new.join(good.select("value", "k"), ["value", "k"]).groupBy("rid").agg(
        F.sort_array(F.collect_set(F.struct("start", "k", "end"))).alias("added"))
    none = F.array().cast(scanned.schema["base"].dataType)
    return scanned.select("rid", "doc_id", "base").join(new, "rid", "left").select(
        "doc_id", "base", F.coalesce("added", none).alias("added"))
