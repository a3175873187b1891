"""Runs of the streaming mart: their number stays small, and merging them changes nothing."""

import datetime as dt
import glob
import random
from collections import Counter, defaultdict

from scoria.streaming.incremental import live_runs, merge_batch, read_mart

CATS = ["a", "b"]


def test_live_runs_cover_every_batch_once():
    for fan in (2, 3, 8):
        for n in range(200):
            runs = live_runs(n, fan)
            held = Counter(i for level, c in runs for i in range(c * fan ** level, (c + 1) * fan ** level))
            assert held == Counter(range(n))
            assert max(Counter(level for level, _ in runs).values(), default=0) < fan


def _mart(spark, root):
    return {(r.client, r.report_dt): tuple(r[f"{c}_{s}_amt"] for c in CATS for s in ("sum", "max", "min"))
            for r in read_mart(spark, root).collect()}


def test_fifty_batches(spark, tmp_path):
    """Every batch touches two of three periods; files of a period stay bounded; batches that merge are tried twice."""
    rng, root, fan = random.Random(5), str(tmp_path / "root"), 3
    days = [dt.date(2024, 1, d) for d in (8, 15, 22)]
    amounts = defaultdict(list)
    most = 0
    for i in range(50):
        rows = [(rng.randint(1, 4), rng.choice([d for d in days if d != days[i % 3]]), rng.choice(CATS), rng.randint(-500, 500))
                for _ in range(6)]
        for c, d, k, x in rows:
            amounts[c, d, k].append(x)
        batch = spark.createDataFrame(rows, "client long, report_dt date, column_name string, amt long").coalesce(1)
        for _ in range(2 if i in (2, 8, 26, 49) else 1):
            merge_batch(batch, i, root, id_col="client", categories=CATS, fan=fan)
        files = Counter(f.split("report_dt=")[1].split("/")[0] for f in glob.glob(f"{root}/parts/*/*/report_dt=*/*.parquet"))
        most = max(most, *files.values())
    # four levels of at most two runs, and the runs that the last batch has merged
    assert most <= 2 * 4 + 1 + 2 * 3
    clients = {(c, d) for c, d, _ in amounts}

    def three(x):
        return (sum(x) / 100, max(x) / 100, min(x) / 100) if x else (0.0, 0.0, 0.0)

    want = {(c, d): tuple(v for k in CATS for v in three(amounts.get((c, d, k)))) for c, d in clients}
    assert _mart(spark, root) == want


def test_an_empty_batch_keeps_the_mart(spark, tmp_path):
    root = str(tmp_path / "root")
    schema = "client long, report_dt date, column_name string, amt long"
    batch = spark.createDataFrame([(1, dt.date(2024, 1, 8), "a", 250)], schema)
    for i, b in enumerate([batch, batch.limit(0), batch, batch.limit(0)]):
        merge_batch(b, i, root, id_col="client", categories=CATS, fan=2)
    assert _mart(spark, root) == {(1, dt.date(2024, 1, 8)): (5.0, 2.5, 2.5, 0.0, 0.0, 0.0)}
