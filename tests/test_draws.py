"""Array draws of the bootstrap against hashlib and the column expression."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scoria.functions import draws as D
from scoria.operators import report as R


@pytest.mark.parametrize("length", [0, 1, 7, 44, 53, 55, 56, 63, 64, 130])
def test_md5_of_pairs(length):
    rng = np.random.default_rng(length)
    prefixes, suffixes = rng.integers(0, 256, (4, length)).astype(np.uint8), [f"{r}|1".encode() for r in (0, 9, 10, 999, 12345)]
    x, y = D.md5_pairs(prefixes, suffixes)
    for i, p in enumerate(prefixes):
        for j, s in enumerate(suffixes):
            h = hashlib.md5(p.tobytes() + s).hexdigest()
            assert (x[i, j], y[i, j]) == (int(h[:8], 16), int(h[8:16], 16))


def test_draws_are_those_of_the_column(spark):
    rows = [(f"{'é' * (i % 70)}{i}|", [0, 1, 2, 5, 32, 33, 400][i % 7]) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, n long").withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(11))))
    want = {(r.k, r.rep): r.w for r in df.select("k", "rep", R.poisson_weight(F.col("n"), F.concat("k", F.col("rep").cast("string"), F.lit("|1"))).alias("w")).collect()}
    text = pa.array(["cut", *[k for k, _ in rows]]).slice(1)  # an array that does not begin with its buffer
    got = D.poisson_pairs(*D.strings(text), np.array([n for _, n in rows]), [f"{rep}|1".encode() for rep in range(12)], R.LADDERS)
    assert got.tolist() == [[want[k, rep] for rep in range(12)] for k, _ in rows]


def test_continuous_interval_has_all_replicates(spark, monkeypatch):
    """the registered job and its SQL draw 1000 replicates, as the interval of the scorecard does."""
    from scoria.plans import q_model as Q
    from scoria.plans.catalog import ORACLES, QUERIES
    seen = []
    real = R.gini_ci
    monkeypatch.setattr(Q.R, "gini_ci", lambda *a, n, **k: seen.append(n) or real(*a, n=1, **k))
    for name in ("gini_ci_continuous", "gini_ci"):
        QUERIES[name](spark, "/root/testdata/sf0.001")
        assert "range(0, 1000)" in ORACLES[name]
    assert seen == [1000, 1000]
