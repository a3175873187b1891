"""Pair correlations of many columns: sums by column blocks against one expression a pair and NumPy."""

import numpy as np
import pandas as pd
import pytest

from scoria.operators.metrics import corr_pairs


def _pairs(frame):
    return {(r.f1, r.f2): r.corr for r in frame.collect()}


@pytest.mark.parametrize("block", [2, 3, 64])
def test_blocks_equal_expressions(spark, block):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 7)) + [0, 1e6, 3, 0, -5, 0, 0]
    x[:, 3] = 2 * x[:, 0] + rng.normal(size=300) / 10
    x[:, 5] = 4.1  # no spread
    rows = [[None if rng.random() < 0.1 else float(v) for v in r] for r in x]
    for r in rows:
        r[6] = None  # no values
    names = ["a", "b.c", "c`d", "d", "e", "f", "g"]
    df = spark.createDataFrame(rows, "struct<" + ", ".join(f"c{i}: double" for i in range(7)) + ">").toDF(*names).repartition(5)
    got, want = _pairs(corr_pairs(df, names, block=block)), {}
    for i, a in enumerate(names):
        for j in range(i + 1, 7):
            v = pd.DataFrame([(r[i], r[j]) for r in rows], dtype=float).dropna().to_numpy()
            flat = len(v) == 0 or np.ptp(v, axis=0).min() == 0
            want[a, names[j]] = None if flat else np.corrcoef(v.T)[0, 1]
    assert got.keys() == want.keys()
    for k in want:
        assert (got[k] is None) == (want[k] is None), k
        if got[k] is not None:
            assert got[k] == pytest.approx(want[k], abs=1e-9)
    strong = _pairs(corr_pairs(df, names, min_abs=0.9, absolute=True, block=block))
    assert strong.keys() == {("a", "d")}


def test_no_rows_and_no_finite_values(spark):
    names = ["a", "b", "c"]
    empty = spark.createDataFrame([], "a double, b double, c double")
    assert corr_pairs(empty, names, block=2).count() == 0
    rows = [(1.0, 2.0, float("nan")), (2.0, 4.0, 1.0), (3.0, 6.0, 2.0)]
    got = _pairs(corr_pairs(spark.createDataFrame(rows, "a double, b double, c double"), names, block=2))
    assert got[("a", "b")] == pytest.approx(1.0) and got[("a", "c")] is None and got[("b", "c")] is None


def test_two_thousand_columns(spark, tmp_path):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 2000))
    x[:, 1999] = x[:, 3] + rng.normal(size=400) / 50
    x[:, 1000] = -x[:, 999]
    names = [f"f{i}" for i in range(2000)]
    pd.DataFrame(x, columns=names).to_parquet(tmp_path / "wide.parquet")
    got = _pairs(corr_pairs(spark.read.parquet(str(tmp_path / "wide.parquet")), names, min_abs=0.95))
    assert got.keys() == {("f3", "f1999"), ("f999", "f1000")}
    assert got[("f999", "f1000")] == pytest.approx(-1.0)
