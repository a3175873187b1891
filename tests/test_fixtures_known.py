"""Hand-computed answers (FIXTURES.md section C)."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoria.functions.exprs import bin_index, period_end, prev_month_end
from scoria.operators import labels as L
from scoria.operators import metrics as T
from scoria.operators import woe as W
from scoria.operators.model import wald_pvalues


def _woe(spark, rows, **kw):
    st = spark.createDataFrame(rows, "feature string, bin double, spec string, n long, n1 long, n0 long")
    return pd.DataFrame([r.asDict() for r in W.finalize_woe(st, **kw).collect()])


def test_woe_and_iv(spark):
    t = _woe(spark, [("f", 0.0, None, 5, 1, 4), ("f", 1.0, None, 5, 4, 1)])
    assert t.loc[t["bin"] == 0, "woe"].iloc[0] == pytest.approx(1.386294, abs=1e-6)
    assert t.loc[t["bin"] == 1, "woe"].iloc[0] == pytest.approx(-1.386294, abs=1e-6)
    assert t["iv"].iloc[0] == pytest.approx(1.663553, abs=1e-6)


def test_woe_empty_class(spark):
    t = _woe(spark, [("f", 0.0, None, 3, 0, 3), ("f", 1.0, None, 4, 3, 1)])
    assert t.loc[t["bin"] == 0, "woe"].iloc[0] == pytest.approx(1.504077, abs=1e-6)
    assert t.loc[t["bin"] == 1, "woe"].iloc[0] == pytest.approx(-1.386294, abs=1e-6)


def test_left_open_bins(spark):
    xs = [float("-inf"), 1.0, 1.5, 2.0, 3.0, float("nan")]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = [r["b"] for r in df.select("i", bin_index("x", [1.0, 2.0]).alias("b")).orderBy("i").collect()]
    assert got == [0, 0, 1, 1, 2, 2]


def test_psi_known_and_identity(spark):
    tr = spark.createDataFrame([("a",)] * 5 + [("b",)] * 5, "x string")
    te = spark.createDataFrame([("a",)] * 8 + [("b",)] * 2, "x string")
    v = T.psi(tr, te, ["x"]).first()["psi"]
    assert v == pytest.approx(0.414767, abs=1e-6)
    assert T.psi(tr, tr, ["x"]).first()["psi"] == pytest.approx(0.0, abs=1e-12)


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (2.0, 0), (2.0, 1)], "s double, y int")
    assert T.auc(df, "y", "s").first()["auc"] == pytest.approx(0.5)


def test_vif_two_columns():
    v = T.vif(np.array([[1.0, 0.9], [0.9, 1.0]]))
    assert v == pytest.approx([5.263158, 5.263158], abs=1e-6)


def test_wilson():
    lo, hi = T.wilson(2, 10)
    assert lo == pytest.approx(0.056682, abs=1e-6)
    assert hi == pytest.approx(0.509838, abs=1e-6)


def test_wald_tail():
    # one coefficient with beta^2 / var = 3.841459 -> p = 0.05
    H = np.array([[1.0]])
    p, _ = wald_pvalues(H, np.array([math.sqrt(3.841459)]))
    assert p[0] == pytest.approx(0.05, abs=1e-6)


def test_percentile_linear(spark):
    df = spark.createDataFrame([(float(i),) for i in range(4)], "x double")
    assert T.describe(df, "x").first()["p25"] == pytest.approx(0.75)


def test_month_key_weekday_period(spark):
    df = spark.createDataFrame([(dt.date(2020, 12, 15),)], "d date")
    r = df.select(prev_month_end("d").alias("m"), F.weekday("d").alias("w")).first()
    assert r["m"] == dt.date(2020, 11, 30)
    assert r["w"] == 1
    d2 = spark.createDataFrame([(dt.date(1995, 1, 5),), (dt.date(1995, 1, 6),)], "d date")
    ends = sorted(r["e"] for r in d2.select(period_end("d", dt.date(1995, 1, 1), 5).alias("e")).collect())
    assert ends == [dt.date(1995, 1, 5), dt.date(1995, 1, 10)]


def test_smoothed_mean(spark):
    df = spark.createDataFrame([(3.0, 3)], "s double, n long")
    v = df.select(W.smoothed_mean(df, 1.0, F.lit(0.5)).alias("v")).first()["v"]
    assert v == pytest.approx(0.875)


def test_special_keys(spark):
    t = _woe(spark, [("f", 0.0, None, 20, 4, 16), ("f", 1.0, None, 10, 8, 2), ("f", 2.0, None, 10, 1, 9),
                 ("f", None, "__NaN_maxfreq__", 1, 0, 1), ("f", None, "__NaN_maxp__", 1, 0, 1),
                 ("f", None, "__NaN_minp__", 1, 0, 1), ("f", None, "__NaN_0__", 1, 0, 1)])
    w = {(r.bin if r.spec is None else r.spec): r.woe for r in t.itertuples()}
    assert w["__NaN_maxfreq__"] == pytest.approx(w[0.0])
    assert w["__NaN_maxp__"] == pytest.approx(w[1.0])
    assert w["__NaN_minp__"] == pytest.approx(w[2.0])
    assert w["__NaN_0__"] == 0.0


def test_fanout_and_dedup(spark):
    feats = spark.createDataFrame([(1, dt.date(2020, 1, 1), 5.0)], "id int, report_dt date, x double")
    sales = spark.createDataFrame([(1, dt.date(2020, 1, 4)), (1, dt.date(2020, 1, 4))], "id int, d date")
    lab_dup = L.label_events(sales, id_col="id", date_col="d", shift_days=3, dedup=False)
    lab = L.label_events(sales, id_col="id", date_col="d", shift_days=3)
    assert L.build_dataset(feats, lab_dup, ["id", "report_dt"]).count() == 2
    assert L.build_dataset(feats, lab, ["id", "report_dt"]).count() == 1


def test_special_merge_by_hand(spark):
    # missing has the WoE nearest to bin 0: the two are pooled, bin 1 stays
    rows = [("f", 0.0, None, 100, 40, 60), ("f", 1.0, None, 100, 80, 20), ("f", None, "__NaN__", 50, 19, 31),
            ("f", None, "__Small_nan__", 3, 1, 2)]
    t = _woe(spark, rows, woe_diff_th=0.2)
    w = {(r.bin if r.spec is None else r.spec): r.woe for r in t.itertuples()}
    t0, t1 = 113.0, 140.0
    pooled = np.log((91 / t0) / (59 / t1))
    assert w[0.0] == pytest.approx(pooled) and w["__NaN__"] == pytest.approx(pooled)
    assert w["__Small_nan__"] == pytest.approx(pooled)
    assert w[1.0] == pytest.approx(np.log((20 / t0) / (80 / t1)))
    far = {r.spec: r.woe for r in _woe(spark, rows, woe_diff_th=0.001).itertuples()}
    assert far["__NaN__"] == pytest.approx(np.log((31 / t0) / (19 / t1)))
    fixed = {r.spec: r.woe for r in _woe(spark, rows, fixed={"f": {"__Small_nan__": 0.25, "__NaN__": 9.0}}).itertuples()}
    assert fixed["__Small_nan__"] == 0.25 and fixed["__NaN__"] == pytest.approx(far["__NaN__"])


def test_missing_inputs(spark):
    df = spark.createDataFrame([("1", "nan", 10115), ("x", "a", 20095), ("nan", None, 30159), (None, "b", 40213)], "r string, c string, z int")
    got = {(r.feature, r.xr, r.xc) for r in W.to_long_mixed(df, {"r": "real", "c": "cat"}, []).collect()}
    assert got == {("r", 1.0, None), ("r", None, None), ("c", None, None), ("c", None, "a"), ("c", None, "b")}
    codes = df.select(F.col("z").cast("string").alias("z"), F.lit(1).alias("target"))
    assert W.infer_types(codes, "target") == {"z": "cat"}
    from scoria.operators.mart import pivot_features
    agg = spark.createDataFrame([(None, "a", 100, 100, 100), (0, "a", 200, 200, 200)], "id long, column_name string, sum_amt long, max_amt long, min_amt long")
    assert {(r.id, r.a_sum_amt) for r in pivot_features(agg, ["id"], ["a", "b"]).collect()} == {(None, 1.0), (0, 2.0)}
