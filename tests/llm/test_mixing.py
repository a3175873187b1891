"""The curriculum mix: targets, totals, positions, against SQL and by its rules."""

import random

from pyspark.sql import functions as F

from scoria.llm import mixing
from scoria.llm.catalog import ORACLES, QUERIES
from scoria.plans.check import compare, duck


def test_query_against_sql(spark, sf):
    got = compare(spark, duck(sf), "op10", QUERIES["op10_curriculum_mix"], ORACLES["op10_curriculum_mix"], sf)
    assert got["ok"], got


def test_targets(spark):
    sizes = {"a": 100, "b": 1000, "c": 10_000, "d": 5000, "e": 0}
    got = {r.source: r for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    assert [got[s].weight for s in "abcde"] == [5, 2, 1, 5, 2]
    total = 1.5 * sum(sizes.values())
    assert abs(sum(r.target for r in got.values()) - total) < 1e-6
    level = max(r.target / r.weight for r in got.values())
    for s, r in got.items():
        assert r.target <= 2 * sizes[s] and (r.target == 2 * sizes[s] or abs(r.target / r.weight - level) < 1e-9)


def test_targets_of_many_sources(spark):
    # against the rounds that the contract names: cap what is above, share again until none is above
    rnd = random.Random(8)
    for n in (1, 2, 60):
        sizes = {f"s{i:03d}": rnd.choice([0, 3, 50, 1000, 40_000]) for i in range(n)}
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
        weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes))}
        full: set = set()
        while True:
            free = [s for s in sizes if s not in full]
            level = (1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in free))
            more = {s for s in free if level * weight[s] > 2 * sizes[s]}
            if not more:
                break
            full |= more
        for s in sizes:
            assert abs(got[s] - (2 * sizes[s] if s in full else level * weight[s])) < 1e-6


def test_hot_ids_and_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 7)
    rows = [(None, "a b c", "s")] * 40 + [(None, "d e f", "s")] * 20 + [(3, "x y", "s")] * 15 + [(i, "w " * i, "t") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    texts = {r.h: r.text for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    assert sorted((str(r.doc_id), texts[r.text_hash]) for r in got) == sorted((str(d), t) for d, t, _ in rows)
    for size in {r.source_size for r in got}:
        mine = [r for r in got if r.source_size == size]
        assert sum(r.taken for r in mine) == round(mine[0].target) and all(r.taken <= 2 * r["size"] for r in mine)
    at = [p for r in got for p in r.positions if r.doc_id is None or r.doc_id == 3]
    assert len(at) == len(set(at)) and sum(r.copy is not None for r in mixing.copies(docs).collect()) == sum(len(r.positions) for r in got)


def test_rules_and_defined_cases(spark):
    rows = [(i, "w " * (i % 17), f"s{i % 3}") for i in range(400)] + [(1000, None, "s0"), (None, "a b c\x1f d", None), (None, "a b c\x1f d", None),
            (7, "w " * 7, "s1"), (8, "x " * 100_000, "é"), (9, "", "s9")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, source string, target double")
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r)
    for (_, target), rs in by.items():
        assert sum(r.taken for r in rs) == round(target)
    assert all((r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1) for r in got)
    at = [r.position for r in got if r.position is not None]
    assert at == sorted(at)
    assert [r["size"] for r in got if r.doc_id is None] == [3, 3]
    assert mixing.mix(docs.limit(0)).count() == 0


def test_copies_against_sql(spark, sf):
    got = compare(spark, duck(sf), "op10", QUERIES["op10_curriculum_copies"], ORACLES["op10_curriculum_copies"], sf)
    assert got["ok"], got


def test_every_copy_has_its_place(spark):
    # the sources beside the hot one are taken twice over
    rows = [(i, "w " * 10, "hot") for i in range(300)] + [(1000 + i, "w " * (1 + i % 7), f"s{i % 3}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    by_doc = {r.doc_id: r for r in mixing.mix(docs).collect()}
    got = mixing.copies(docs).collect()
    at = [r.position for r in got if r.position is not None]
    assert at == sorted(at) and {r.doc_id for r in got} == set(by_doc)
    source = {d: s for d, _, s in rows}
    slope = dict(zip(sorted(set(source.values())), [*mixing.SLOPES, mixing.SLOPES[0]]))
    seen, many = {}, 0
    for r in got:
        s = source[r.doc_id]
        many += r.copy == 2
        if r.position is not None:
            # the schedule's integral up to this position is the share of the words placed before it
            t, a = r.position, slope[s]
            assert abs((t + a * (t * t - t)) * r.target - seen.get(s, 0)) < 1e-6
            seen[s] = seen.get(s, 0) + r.taken
    assert many > 50 and all(seen[s] == round(r.target) for d, r in by_doc.items() for s in [source[d]])
    for d, r in by_doc.items():
        mine = [x for x in got if x.doc_id == d and x.copy]
        assert [x.position for x in mine] == r.positions and sum(x.taken for x in mine) == r.taken
        assert r.position == (r.positions[0] if r.positions else None)
