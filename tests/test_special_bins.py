"""Merging over bins and special points: against a plain graph, all small graphs, and a planted frame."""

import math
import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoria.operators import binning as B
from scoria.operators.metrics import wilson


def plain_merge(n, n1, special, most, score, better, wanted):
    """Groups as sets and neighbours as a set of frozensets, re-made after every merge."""
    k = len(n) - len(special)
    groups = [{i} for i in range(len(n))]
    touch = {(i, i + 1) for i in range(k - 1)} | {(b, k + j) for j, b in enumerate(special)}
    while len(groups) > 2:
        near = [(a, b) for a in range(len(groups)) for b in range(a + 1, len(groups))
                if any((i, j) in touch or (j, i) in touch for i, j in product(groups[a], groups[b]))]
        if not near:
            break
        value = {p: score(groups[p[0]], groups[p[1]]) for p in near}
        best = better(value[p] for p in near)
        pick = next(p for p in near if value[p] == best)
        if not (wanted(best) or len(groups) > most):
            break
        groups[pick[0]] |= groups.pop(pick[1])
        groups.sort(key=min)
    return [next(g for g, s in enumerate(groups) if i in s) for i in range(len(n))]


def woe(events, size, t1, t0):
    return math.log((max(events, 0.5) / t1) / (max(size - events, 0.5) / t0))


def ci_score(n, n1):
    t1, t0 = max(sum(n1), 0.5), max(sum(n) - sum(n1), 0.5)

    def ends(g):
        size, events = sum(n[i] for i in g), sum(n1[i] for i in g)
        return [woe(max(math.trunc(p * size), 0.5), size, t1, t0) for p in wilson(events, size)]

    def overlap(a, b):
        (la, ha), (lb, hb) = ends(a), ends(b)
        return min(ha, hb) - max(la, lb)
    return overlap


@pytest.mark.parametrize("most", [2, 3, 9])
def test_all_graphs_of_five_nodes(most):
    """Every way in which up to three special points hang on bins, with random counts."""
    rnd = random.Random(most)
    for n_special in range(4):
        for special in product(range(5 - n_special), repeat=n_special):
            for _ in range(6):
                n = [float(rnd.randrange(1, 400)) for _ in range(5)]
                n1 = [float(rnd.randrange(0, int(x) + 1)) for x in n]
                got = B.merge_ci(n, n1, most, special=special)
                assert got == plain_merge(n, n1, special, most, ci_score(n, n1), max, lambda v: v > 0)
                as_written = B.merge_ci(n, n1, most, order="as_written", special=special)
                assert as_written == plain_merge(n, n1, special, most, ci_score(n, n1), min, lambda v: v < 0)


def test_groups_are_connected_and_folds_agree():
    rnd = np.random.default_rng(3)
    for _ in range(60):
        k, m = int(rnd.integers(2, 7)), int(rnd.integers(0, 5))
        special = rnd.integers(0, k, m).tolist()
        fold_n = rnd.integers(5, 90, (4, k + m)).astype(float)
        fold_n1 = np.floor(fold_n * rnd.random((4, k + m)))
        most = int(rnd.integers(2, 5))
        got = B.merge_folds(fold_n.sum(0), fold_n1.sum(0), fold_n, fold_n1, most, special=special)
        assert len(set(got)) == min(max(most, 2), k + m)
        touch = B._pairs(k + m, special)
        for g in set(got):  # a group hangs together by neighbours
            nodes = {i for i, x in enumerate(got) if x == g}
            seen, todo = set(), [min(nodes)]
            while todo:
                i = todo.pop()
                seen.add(i)
                todo += [j for p in touch for i2, j in (p, p[::-1]) if i2 == i and j in nodes - seen]
            assert seen == nodes


def test_a_special_point_like_its_bin_merges_with_it():
    # bins of rates 0.1, 0.5, 0.9; a heap in the middle bin that is like it, one in the first that is like the last
    n, n1 = [1000.0, 1000.0, 1000.0, 800.0, 800.0], [100.0, 500.0, 900.0, 400.0, 720.0]
    assert B.merge_ci(n, n1, special=[1, 0]) == [0, 1, 2, 1, 3]
    # forced below four groups the odd heap can only join its own bin
    assert len(set(B.merge_ci(n, n1, 3, special=[1, 0]))) == 3
    assert B.held_in([2.0, 5.0], [2.0, 2.5, 9.0]) == [0, 1, 2]


def test_points_and_counts_of_a_frame(spark):
    rows = [(float(i % 100) if i % 4 else 50.0, int(i % 3 == 0), i % 2) for i in range(4000)]
    rows += [(None, 1, 0), (float("nan"), 1, 1)]
    df = spark.createDataFrame(rows, "x double, target int, fold int")
    special = B.special_points(df, ["x"], share=0.2)
    assert special == {"x": [50.0]}
    cuts = {"x": [30.0, 60.0]}
    got = {(r.node, r.fold): (r.n, r.n1) for r in B.special_stats(df, cuts, special, by=["fold"]).collect()}
    for node, holds in enumerate([lambda x: x <= 30, lambda x: 30 < x <= 60 and x != 50, lambda x: x > 60, lambda x: x == 50]):
        for fold in (0, 1):
            own = [y for x, y, f in rows if f == fold and x is not None and x == x and holds(x)]
            assert got.get((node, fold), (0, 0)) == (len(own), sum(own))
    t = B.merge_special(B.special_stats(df, cuts, special, by=["fold"]), cuts, special, max_bin_count=3).collect()
    assert [r.special for r in sorted(t, key=lambda r: r.node)] == [False, False, False, True]
    assert len({r.group_folds for r in t}) == 3 and sum(r.n for r in t) == 4000


def test_many_codes_are_looked_up_in_sets(spark):
    """a row is not compared with every code, neither by the columns nor by the exported SQL."""
    from scoria.operators import model as M
    codes = {f"c{i}": i % 3 for i in range(300)} | {"__NaN__": 1, "__Small__": 2}
    m = M.ScorecardModel({"x": M.FeatureBins("x", "cat", [], codes, {0: 0.5, 1: -0.25, 2: 0.1}, "__NaN__", "__Small__")}, {"x": 1.0}, 0.0)
    xs = ["c0", "c1", "c299", "new", "nan", None, "o'k"]
    df = spark.createDataFrame(list(enumerate(xs)), "k long, x string")
    df.createOrReplaceTempView("many_codes")
    want = {"c0": 0.5, "c1": -0.25, "c299": 0.1, "new": 0.1, "nan": -0.25, None: -0.25, "o'k": 0.1}
    for d in (m.transform(df), spark.sql(m.to_sql("many_codes", keep=["k"]))):
        assert {xs[r.k]: r.prob for r in d.collect()} == {k: pytest.approx(1 / (1 + math.exp(-v))) for k, v in want.items()}
        plan = d._jdf.queryExecution().optimizedPlan().toString()
        assert "INSET" in plan and "map(" not in plan
    assert m.to_sql("many_codes").count("WHEN") == 4


def test_code_tables_do_not_shuffle_the_rows(spark, tmp_path):
    """rows meet a small table of codes by broadcast, and the four scoring forms read their input once."""
    import __spark_entry__ as E
    from scoria.operators import model as M
    codes = spark.createDataFrame([(f"c{i}", i % 2) for i in range(300)], "code string, bin int")
    m = M.ScorecardModel({"x": M.FeatureBins("x", "cat", [], {"__NaN__": 1, "__Small__": 0}, {0: 0.5, 1: -0.25}, "__NaN__", "__Small__",
                                             cat_table=codes)}, {"x": 1.0}, 0.0)
    xs = ["c0", "c1", "c299", "new", "nan", None, "c1"]
    d = m.transform(spark.createDataFrame(list(enumerate(xs)), "k long, x string"))
    want = [0.5, -0.25, -0.25, 0.5, -0.25, -0.25, -0.25]
    assert {r.k: r.prob for r in d.collect()} == {k: pytest.approx(1 / (1 + math.exp(-v))) for k, v in enumerate(want)}
    plan = d._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # a row of a repeated key is scored as often as it stands
    li = [(key, 7, 3, 1, 5.0, 0.05, 0.02, 900.0, "R", "O", "1996-01-01") for key in (1, 2, 50, 51, 952, 952, None)]
    spark.createDataFrame(li, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, "
                          "l_tax double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate string") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    q = E.queries()["score_high_card"](spark, str(tmp_path))
    woe = {"1-7-3-1": -0.25, "2-7-3-1": 0.1, "50-7-3-1": -0.25, "51-7-3-1": -0.25, "952-7-3-1": 0.1, "7-3-1": -0.25}
    got = sorted((r.form, r.k, r.prob) for r in q.collect())
    assert got == sorted((form, k, pytest.approx(1 / (1 + math.exp(0.5 + woe[k])), abs=1e-6))
                         for form in ("literal", "table", "sql_literal", "sql_table") for k in [*woe, "952-7-3-1"])
    plan = q._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
