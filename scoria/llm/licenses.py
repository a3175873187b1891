"""Licence scan with a positional rare-token index over licence templates.

Templates are short phrases ("mit license") and passages of licence texts
with mandatory key phrases.  Inverse document frequencies of the template
words are counted over all documents.  The index holds, for each template,
the positions of its highest-IDF words only; a file looks up those of its
words, and subtracting the template position from the place in the file
turns postings into alignments.  A phrase is verified word for word at
each alignment, so all its places are found (each holds the phrase's
rarest word).  A passage gathers the alignments within ``slack`` words of
one another, opening a run at every alignment, and keeps the best of the
runs that open together; a run counts if the index words met there carry at least
``min_share`` of the passage's index weight and every mandatory key phrase
stands in the aligned stretch.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Defined cases: a null or empty text has no words and no hits; ties in IDF
go to the earlier template word; overlapping places all count; repeated
rows are scanned alike; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoria.llm.common import ALNUM, col, utf8

__all__ = ["PHRASES", "PASSAGES", "document_frequencies", "Index", "scan", "HITS"]

#: Phrase -> label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Passages of public licence texts (words only): label -> (passage, mandatory key phrases).
PASSAGES = {
    "mit-text": ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction",
                 ("permission is hereby granted", "without restriction")),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met redistributions of source code must retain the above copyright "
            "notice this list of conditions and the following disclaimer",
            ("redistribution and use in source and binary forms", "must retain the above copyright notice")),
    "apache-notice": ("licensed under the apache license version 2 0 the license you may not use this file except in "
                      "compliance with the license you may obtain a copy of the license at",
                      ("apache license version 2 0", "in compliance with the license")),
    "gpl-notice": ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
                   "general public license as published by the free software foundation either version",
                   ("free software foundation", "general public license")),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
            ("with or without fee is hereby granted",)),
    "mpl": ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl "
            "was not distributed with this file you can obtain one at",
            ("mozilla public license v 2 0",)),
    "unlicense": ("this is free and unencumbered software released into the public domain anyone is free to copy "
                  "modify publish use compile sell or distribute this software",
                  ("free and unencumbered software", "public domain")),
    "mit-line": ("released under the mit license", ("mit license",)),
    "gpl-line": ("this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    "cc-by-nc": ("licensed under cc by nc 4 0", ("cc by nc",)),
    "cc-by": ("this work is licensed under a creative commons attribution 4 0 international license",
              ("creative commons attribution",)),
}

HITS = "array<struct<label:string,kind:string,start:long,end:long,share:double>>"
_HIT = pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                           ("share", pa.float64())]))


def _words(text: bytes) -> list[bytes]:
    return text.translate(ALNUM).split()


def document_frequencies(docs: DataFrame, vocabulary, *, text_col: str = "text") -> tuple[int, dict[str, int]]:
    """Number of documents, and of documents that hold each word of the (bounded) vocabulary."""
    vocab = frozenset(w.encode() for w in vocabulary)

    def count(batches):
        n, df = 0, defaultdict(int)
        for batch in batches:
            for text in utf8(batch.column(0)):
                n += 1
                for w in vocab.intersection(_words(text)):
                    df[w] += 1
        yield pa.RecordBatch.from_pydict({"word": ["", *[w.decode() for w in df]], "n": [n, *df.values()]},
                                         schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))

    got = docs.select(col(text_col).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    df = {r["word"]: r["n"] for r in got.collect()}  # at most one row a vocabulary word
    return df.pop("", 0), df


class Index:
    """Postings of the highest-IDF words of every template."""

    def __init__(self, n_docs: int, df: dict[str, int], *, phrases=None, passages=None, rare: int = 8,
                 slack: int = 3, min_share: float = 0.6):
        self.slack, self.min_share = slack, min_share
        self.templates = [(label, "phrase", p, ()) for p, label in (PHRASES if phrases is None else phrases).items()]
        self.templates += [(label, "passage", p, keys) for label, (p, keys) in (PASSAGES if passages is None else passages).items()]
        self.templates = [(label, kind, [w.encode() for w in p.split()], [[w.encode() for w in k.split()] for k in keys])
                          for label, kind, p, keys in self.templates]
        idf = lambda w: math.log((n_docs + 1) / (df.get(w.decode(), 0) + 1)) + 1e-9
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.weight: list[dict[int, float]] = []
        for t, (_, kind, ws, _) in enumerate(self.templates):
            best = sorted(range(len(ws)), key=lambda p: (-idf(ws[p]), p))[:1 if kind == "phrase" else rare]
            self.weight.append({p: idf(ws[p]) for p in best})
            for p in best:
                self.postings[ws[p]].append((t, p))
        self.postings = dict(self.postings)

    def find(self, words: list[bytes]) -> list[tuple[str, str, int, int, float]]:
        """(label, kind, start, end, share of the index weight) in the words of one file."""
        met: dict[int, dict[int, set[int]]] = {}
        get = self.postings.get
        for i, posts in [(i, get(w)) for i, w in enumerate(words) if w in self.postings]:
            for t, p in posts:
                met.setdefault(t, {}).setdefault(i - p, set()).add(p)
        out = []
        for t, starts in met.items():
            label, kind, ws, keys = self.templates[t]
            if kind == "phrase":
                out += [(label, kind, s, s + len(ws), 1.0) for s in sorted(starts) if s >= 0 and words[s:s + len(ws)] == ws]
                continue
            all_weight, passed = sum(self.weight[t].values()), []
            for run in _runs(sorted(starts), self.slack):
                seen = set().union(*(starts[s] for s in run))
                share = sum(self.weight[t][p] for p in seen) / all_weight
                a, b = max(0, run[0]), min(len(words), run[-1] + len(ws) + self.slack)
                if share >= self.min_share and all(_holds(words[a:b], k) for k in keys):
                    passed.append((run[0], -share, run[-1] - run[0]))
            for first, share, width in _best(passed, self.slack):
                out.append((label, kind, max(0, first), min(len(words), first + width + len(ws)), min(1.0, -share)))
        return sorted(out, key=lambda h: (h[2], h[3], h[0]))


def _runs(starts, slack):
    """The starts within ``slack`` of each start, from it on: words before a passage cannot take its start away."""
    end = 0
    for i, s in enumerate(starts):
        while end < len(starts) and starts[end] - s <= slack:
            end += 1
        yield starts[i:end]


def _best(passed, slack):
    """Of the runs that open within ``slack`` of one another, that of most weight, then the narrowest, then the first."""
    near: list = []
    for run in passed:
        if near and run[0] - near[0][0] > slack:
            yield min(near, key=lambda r: (r[1], r[2], r[0]))
            near = []
        near.append(run)
    if near:
        yield min(near, key=lambda r: (r[1], r[2], r[0]))


def _holds(words, phrase):
    return any(words[i:i + len(phrase)] == phrase for i in range(len(words) - len(phrase) + 1))


def scan(docs: DataFrame, index: Index, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, hits (label, kind, start and end in words, share)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("hits", _HIT)])

    def run(batches):
        for batch in batches:
            n, hits = [], []
            for text in utf8(batch.column(1)):
                words = _words(text)
                n.append(len(words))
                hits.append([dict(zip(("label", "kind", "start", "end", "share"), h)) for h in index.find(words)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(hits, _HIT)], schema=schema)

    return docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text")).mapInArrow(
        run, f"doc_id long, n_words long, hits {HITS}")
