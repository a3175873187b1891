"""Permutation importance and its row numbers: ties, nulls, what stays on disk."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoria.operators import ranking as K
from scoria.operators import select as S



def _auc(y, s):
    y, s = np.array(y), np.array(s)
    a, b = s[y == 1][:, None], s[y == 0][None, :]
    return ((a > b) + 0.5 * (a == b)).mean()


def test_like_plain_shuffles_with_equal_and_null_keys(spark):
    rng = np.random.default_rng(4)
    rows = [(None if i % 40 == 0 else f"k{i // 3}", i, float(rng.integers(0, 4)), None if i % 9 == 0 else float(rng.integers(0, 3)),
             int(rng.integers(0, 2))) for i in range(240)]
    df = spark.createDataFrame(rows, "k string, t long, a double, b double, target int").repartition(5)

    def value(a, b):
        return a + 2 * (b if b is not None else 1.5)

    def score(d):
        return d.withColumn("score", F.col("a") + 2 * F.coalesce("b", F.lit(1.5)))

    first = lambda x: (x is not None, x or "")  # noqa: E731  nulls first
    base = sorted(rows, key=lambda r: (first(r[0]), r[1]))
    y = [r[4] for r in base]
    whole = _auc(y, [value(r[2], r[3]) for r in base])
    drops = {"a": [], "b": []}
    for it in range(3):
        other = sorted(rows, key=lambda r: (first(None if r[0] is None else hashlib.md5(f"{r[0]}|{it}".encode()).hexdigest()), first(r[0]), r[1]))
        drops["a"].append(whole - _auc(y, [value(o[2], r[3]) for r, o in zip(base, other)]))
        drops["b"].append(whole - _auc(y, [value(r[2], o[3]) for r, o in zip(base, other)]))
    got = S.permutation_importance(df, score, ["a", "b"], "k", n_iter=3, tiebreak=["t"])
    assert dict(got) == pytest.approx({f: min(v) for f, v in drops.items()}, abs=1e-12)


def test_row_numbers_by_place_and_by_hash(spark, monkeypatch):
    monkeypatch.setattr(K, "BUCKET_ROWS", 7)
    df = spark.range(300).select((F.col("id") * 7 % 300).alias("id"), F.lit("x").alias("c")).repartition(4)
    got, n = K.stored_row_number(df, ["id"], ["id", "c"], slices=6)
    assert n == 300 and [(r.id, r.c) for r in got.orderBy("rn").collect()] == [(i, "x") for i in range(300)]
    by = K.hash_row_number(got, F.md5(F.col("id").cast("string")), ["rn"], ["id"], n, name="to")
    want = sorted(range(300), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    assert [(r.to, r.id) for r in by.orderBy("to").collect()] == [(k + 1, i) for k, i in enumerate(want)]
    none, n = K.stored_row_number(df.where("id < 0"), ["id"], ["id"])
    assert n == 0 and none.count() == 0 and none.columns == ["id", "rn"]


def test_a_shuffle_stores_no_rows(spark, monkeypatch):
    """every iteration stored all columns of all rows twice; now one narrow copy serves them all."""
    df = spark.range(4000).select(F.concat(F.lit("a-long-key-of-a-row-"), F.col("id")).alias("k"), (F.col("id") % 7).cast("double").alias("x"),
                                  *[F.col("id").alias(f"t{i}") for i in range(8)]).withColumn("target", (F.col("x") > 3).cast("int"))
    stored = []

    def cut(d):
        stored.append((d.count(), d.columns))
        return d.persist()

    for where in (K, S):
        monkeypatch.setattr(where, "cut_lineage", cut)
    S.permutation_importance(df, lambda f: f.withColumn("score", F.col("x")), ["x"], "k", n_iter=3, tiebreak=[f"t{i}" for i in range(8)])
    spark.catalog.clearCache()
    many = [c for n, c in stored if n >= 4000]
    assert len(many) == 1 and not any(c.startswith("t") and c != "target" for c in many[0])
