"""Null groups in running sums, exact quantiles, Poisson bootstraps and balanced group folds."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoria.operators import metrics as T
from scoria.operators import report as R
from scoria.operators import sampling as P
from scoria.operators.binning import quantile_splits
from scoria.operators.ranking import join_null_safe, running_sums


def test_null_groups_stay(spark):
    rows = [(None if i % 4 == 0 else "a", i, 1) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, i long, v long")
    got = running_sums(df, ["g"], ["i"], ["v"], slices=3).collect()
    assert len(got) == 40
    assert all(r.cum_v == sum(1 for g, i, _ in rows if g == r.g and i < r.i) for r in got)
    folds = P.assign_folds(spark.createDataFrame([(str(i), None if i < 10 else i % 2) for i in range(100)], "k string, t int"), 5, "k", target="t")
    per = {(r.t, r.fold): r["count"] for r in folds.groupBy("t", "fold").count().collect()}
    assert folds.count() == 100 and all(per[(None, f)] == 2 and per[(0, f)] == 9 for f in range(5))
    a = T.auc(df.withColumn("y", (F.col("i") % 3 == 0).cast("int")), "y", "i", by=["g"]).collect()
    assert {r.g for r in a} == {None, "a"}
    s = T.shares(df.withColumn("b", F.col("i") % 2), ["b"], within=["g"]).collect()
    assert sum(r.share for r in s if r.g is None) == pytest.approx(1)
    both = join_null_safe(df.select("g", "i"), df.groupBy("g").agg(F.count("*").alias("n")), ["g"])
    assert both.columns == ["g", "i", "n"] and both.count() == 40


@pytest.mark.parametrize("slices", [1, 7])
def test_quantiles_like_pandas(spark, slices, monkeypatch):
    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    rng = np.random.default_rng(slices)
    rows = [(str(g) if g else None, float(x) if x != 7 else None) for g, x in zip(rng.integers(0, 4, 900), rng.integers(0, 300, 900))]
    rows += [("one", 5.0), ("none", None), ("ties", 1.0), ("ties", 1.0), ("ties", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    pdf = pd.DataFrame(rows, columns=["g", "x"])
    probs = [0, 0.1, 1 / 3, 0.5, 0.99, 1]
    got = {r.g: r.q for r in T.quantiles(df, "x", probs, ["g"]).collect()}
    want = {None if g is None or g != g else g: d["x"].quantile(probs).tolist() for g, d in pdf.groupby("g", dropna=False) if d["x"].notna().any()}
    assert got.keys() == want.keys()
    assert all(got[g] == pytest.approx(want[g]) for g in want)
    assert T.quantiles(df, "x", [0.5]).first().q == pytest.approx([pdf["x"].median()])
    d = {r.g: r for r in T.describe(df, "x", by=["g"]).collect()}
    assert d["none"]["count"] == 0 and d["none"].p50 is None and d["one"].p25 == d["one"].p75 == 5.0
    whole, stat = T.describe(df, "x").first(), pdf["x"].describe()
    assert [whole[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(stat.tolist())
    sketch = T.describe(df, "x", exact=False).first()
    assert abs(sketch.p50 - whole.p50) <= 2 and sketch["count"] == whole["count"]
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_quantiles_of_nothing(spark):
    none = spark.createDataFrame([], "g string, x double")
    assert T.quantiles(none, "x", [0.5], ["g"]).count() == 0 and T.quantiles(none, "x", [0.5]).count() == 0
    r = T.describe(none, "x").first()
    assert r["count"] == 0 and r.p50 is None
    assert quantile_splits(none.withColumnRenamed("g", "feature"), 4, "x", exact=True).count() == 0


@pytest.mark.parametrize("mean", [1, 3, 20, 32, 33, 400, 1_000_000])
def test_poisson_weights(spark, mean):
    n = 20_000
    w = spark.range(n).select(R.poisson_weight(F.lit(mean).cast("long"), F.concat(F.lit(f"{mean}|"), F.col("id").cast("string"))).alias("w"))
    x = np.array([r.w for r in w.collect()])
    assert (x >= 0).all() and (x == np.floor(x)).all()
    assert abs(x.mean() - mean) < 5 * math.sqrt(mean / n)
    assert x.var() / mean == pytest.approx(1, abs=0.06)
    if mean <= 32:  # the whole distribution
        for k in range(0, 2 * mean + 2):
            p = math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1))
            assert abs((x == k).mean() - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3
    assert spark.range(3).select(R.poisson_weight(F.lit(0).cast("long"), F.col("id").cast("string")).alias("w")).agg(F.max("w")).first()[0] == 0


def test_gini_interval_of_a_continuous_score(spark):
    rng = np.random.default_rng(0)
    n = 1500
    y = rng.integers(0, 2, n)
    s = rng.normal(size=n) + y
    rows = [(None if i % 2 else "g", int(y[i]), float(s[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r.g: r for r in R.gini_ci(df, "y", "s", by=["g"], n=60).collect()}
    point = {r.g: r.gini for r in T.auc(df, "y", "s", by=["g"]).collect()}
    for g in (None, "g"):
        # rank correlation's spread: sd of Gini is about 0.035 here
        assert got[g].gini_lo < point[g] < got[g].gini_hi and 0.06 < got[g].gini_hi - got[g].gini_lo < 0.25
    assert R.gini_ci(df, "y", "s", n=30).collect() == R.gini_ci(df.repartition(5), "y", "s", n=30).collect()
    plan = R.gini_ci(df, "y", "s", n=3)._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Arrow" not in plan


def test_woe_replicates_of_many_categories(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 50 > 0, F.concat(F.lit("c"), F.col("id") % 900)).alias("c"),
                                  (F.col("id") % 7 == 0).cast("int").alias("y"))
    got = R.woe_bootstrap(df, "c", "y", n=5)
    assert got.count() == 5 * df.select("c").distinct().count() and got.where("woe IS NULL").count() == 0
    assert sorted(got.collect(), key=repr) == sorted(R.woe_bootstrap(df.repartition(3), "c", "y", n=5).collect(), key=repr)


def test_largest_groups_first(spark):
    sizes = {None: 50, "a": 900, "b": 300, "c": 300, "d": 299, "e": 2, "f": 1}
    df = spark.createDataFrame([(g, i) for g, n in sizes.items() for i in range(n)], "g string, i long")
    got = P.assign_folds(df, 3, "i", group="g", method="largest_first")
    fold = {r.g: r.fold for r in got.select("g", "fold").distinct().collect()}
    assert fold == {"a": 0, "b": 1, "c": 2, "d": 1, None: 2, "e": 2, "f": 2} and got.count() == sum(sizes.values())
    # beyond the bound, the small groups go by hash and no group is lost or split
    many = spark.createDataFrame([(f"g{i}", 100 if i < 3 else 1) for i in range(500)], "g string, n long")
    got = P.largest_first(many, 5, "g", max_groups=10)
    rows = got.collect()
    assert len(rows) == 500 == len({r.g for r in rows}) and {r.fold for r in rows} == set(range(5))
    assert len({r.fold for r in rows if r.g in ("g0", "g1", "g2")}) == 3


def test_gini_interval_shuffles_no_replicate(spark, monkeypatch):
    """replicates are drawn in place from sorted scores; slices and batches add up to one running sum."""
    def plain(rows, n):
        from hashlib import md5
        out = {}
        for g in {r[0] for r in rows}:
            own = sorted({r[2] for r in rows if r[0] == g})
            count = {s: [sum(r[0] == g and r[2] == s and r[1] == y for r in rows) for y in (0, 1)] for s in own}
            ginis = []
            for rep in range(n):
                below, at, area, total = 0.0, 0, 0.0, [0.0, 0.0]
                for s in own:
                    name = "1" if g is None else "0" + g
                    w = []
                    for y in (0, 1):
                        u = int(md5(f"0|{name}|{at}|{rep}|{y}".encode()).hexdigest()[:8], 16) / 2 ** 32
                        w.append(sum(c <= u for c in R.LADDERS[count[s][y]]))
                    area += w[1] * (below + w[0] / 2)
                    below, at, total = below + w[0], at + sum(count[s]), [a + b for a, b in zip(total, w)]
                if all(total):
                    ginis.append(2 * area / (total[0] * total[1]) - 1)
            out[g] = tuple(round(float(np.quantile(ginis, q)), 3) for q in (0.025, 0.975))
        return out

    rows = [(g, int((i * 7 + k) % 11 < 4 + i % 3), float((i * 13 + k) % 61)) for k, g in enumerate(("a", "b", None)) for i in range(150)]
    monkeypatch.setattr(R, "auc", None)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        got = R.gini_ci(spark.createDataFrame(rows, "g string, y int, s double"), "y", "s", by=["g"], n=9).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = plain(rows, 9)
    assert len(got) == 3 and all((r.gini_lo, r.gini_hi) == pytest.approx(want[r.g], abs=1.1e-3) for r in got)
