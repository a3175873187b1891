"""Prefix trie against a plain re-statement; shards, hot conversations and the defined cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from scoria.llm import prefix_trie
from scoria.llm.catalog import QUERIES
from tests.llm.brute import TOKEN

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0, key), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: tuple(own.get(c - c % 20, [])[:h[c]] + own[c][h[c]:]) for c in own}


def plain_trie(paths):
    members, ends = defaultdict(list), defaultdict(list)
    for c, p in paths.items():
        ends[p].append(c)
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(TOKEN.findall(p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids[p])
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=repr)


def tree(df, **kw):
    got = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(df)), **kw)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_query_against_plain_trie(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op11_prefix_trie"](spark, sf).collect()), key=repr)
    assert got == plain_trie(plain_rebuilt(rows))


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards_and_hot_paths(spark, shards, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 7)  # the ids of a path come in many pieces
    rnd = random.Random(3)
    rows = []
    for c in range(400):
        # a third repeat one conversation; the rest share few texts, so that nodes have many members
        n = rnd.randrange(7)
        own = [("user", "a b c"), ("assistant", "d e")] if c % 3 == 0 else [(rnd.choice("ua"), "w " * rnd.randrange(4)) for _ in range(n)]
        rows += [(c, t, r, x) for t, (r, x) in enumerate(own)]
    rows += [(401, t, "u", f"long {t % 5}") for t in range(300)] + [(402, t, "u", f"long {t % 5}") for t in range(299)]
    rows += [(403, t, "u", f"long {t % 5}") for t in range(250)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain_trie(plain_rebuilt(rows))
    assert tree(df, shards=shards) == want
    assert tree(df, shards=shards, sample=2) == want  # any splitters give the same nodes


def test_splitters_are_short_and_sorted(spark):
    df = spark.createDataFrame([(c, t, "u", f"{c * 7 % 50} {t}") for c in range(50) for t in range(4)], SCHEMA)
    paths = prefix_trie.distinct_paths(prefix_trie.sequences(df))
    got = prefix_trie.splitters(paths, 8)
    assert got == sorted(set(got)) and 5 <= len(got) <= 7 and all(len(x) == 16 for x in got)


def test_defined_cases(spark):
    rows = [(None, 0, "u", "lost"), (20, None, "u", "x"), (20, 0, None, None), (20, 0, None, None), (21, 5, "a", ""),
            (21, 5, "a", " one two \x0b three"), (-3, 1, "u", "neg"), (45, 0, "u", "only"), (7, 0, "u", "z " * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'q' AS path", "1 AS depth", "0 AS `a.b`")
    # a negative id's remainder has its sign, here and in plain_rebuilt's place
    own = plain_rebuilt([r for r in rows if r[0] is None or r[0] >= 0])
    neg = plain_rebuilt([(0, 1, "u", "neg")])[0]
    h = zlib.crc32(b"-3") % 4
    own[-3] = neg[h:]
    assert tree(df) == plain_trie(own)
    assert tree(spark.createDataFrame([], SCHEMA)) == []
