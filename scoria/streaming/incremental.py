"""Incremental category mart with Structured Streaming (G3/U2/S5 as a stream).

New transaction files are picked up by the file source and joined to the
static code table.  Each micro-batch writes its own partial aggregates per
(client, period, category) as a run of its own, and then merges all runs'
partials of the periods it touched and replaces exactly those periods of
the mart.  Late rows are never dropped, whatever their order; a retried
batch overwrites its own partials and gives the same mart; a period is
there as soon as its rows are, not only when later ones arrive.  Days are
dates throughout, so no time zone shifts a period.

Runs are merged by levels: ``fan`` runs of one level become one of the
next, so after n batches at most ``fan - 1`` runs a level are read and each
partial is rewritten once a level, log(n) times in all.  Which runs stand
follows from the batch id alone, so a retry merges the same ones; runs that
a batch has merged are deleted by the batch after it, which Spark starts
only when the first is committed.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoria.functions.exprs import period_end
from scoria.operators.mart import n_periods
from scoria.sources.io import write_partitioned

__all__ = ["stream_rows", "merge_batch", "run_available", "live_runs", "FAN"]

REPORT = "report_dt"
#: Runs of one level that are merged into one of the next.
FAN = 8


def stream_rows(tx_stream: DataFrame, codes: DataFrame, *, id_col: str, amount: str, code: str, day: str,
                start: _dt.date, stop: _dt.date, delta: int, type_col: str | None = None,
                types: Sequence | None = None) -> DataFrame:
    """(id, report_dt, column_name, amt) of the complete periods in [start, stop): no state, no watermark."""
    last = start + _dt.timedelta(days=n_periods(start, stop, delta) * delta)
    dtype = dict(tx_stream.dtypes)[day]
    raw = F.col(day)
    t = tx_stream.where((raw >= F.lit(str(start)).cast(dtype)) & (raw < F.lit(str(last)).cast(dtype)))
    if type_col is not None and types is not None:
        t = t.where(F.col(type_col).isin(list(types)))
    t = t.where(F.col(id_col).isNotNull()).select(
        F.col(id_col), F.col(code).try_cast("bigint").alias("merchant"),
        F.col(amount).try_cast("bigint").alias("amt"), period_end(F.to_date(raw), start, delta).alias(REPORT))
    return t.join(codes, "merchant").select(id_col, REPORT, "column_name", "amt")


def live_runs(batches: int, fan: int = FAN) -> list[tuple[int, int]]:
    """(level, number) of the runs that hold the first ``batches`` batches; run c of level l holds fan ** l of them."""
    out, level = [], 0
    while batches:
        out += [(level, c) for c in range(batches // fan * fan, batches)]
        batches, level = batches // fan, level + 1
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _combine(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return parts.groupBy(*keys).agg(F.sum("s").alias("s"), F.max("x").alias("x"), F.min("n").alias("n"))


def merge_batch(batch: DataFrame, batch_id: int, root: str, *, id_col: str, categories: Sequence[str],
                scale: float = 100.0, fan: int = FAN) -> None:
    """Write the batch's partials, replace the periods it touches in ``root``/mart, merge runs that are due."""
    if fan < 2:
        raise ValueError("fan must be at least 2")
    spark = batch.sparkSession
    keys = [id_col, REPORT, "column_name"]

    def path(run):
        return f"{root}/parts/level={run[0]}/run={run[1]}"

    own, before, after = (0, batch_id), live_runs(batch_id, fan), live_runs(batch_id + 1, fan)
    if batch_id:  # merged by the batch before, which is committed now
        for run in sorted({*live_runs(batch_id - 1, fan), (0, batch_id - 1)} - set(before)):
            _delete(spark, path(run))
    part = batch.groupBy(*keys).agg(F.sum("amt").alias("s"), F.max("amt").alias("x"), F.min("amt").alias("n"))
    write_partitioned(part, path(own), REPORT, replace="table")

    def read(runs):
        return spark.read.option("basePath", f"{root}/parts").schema(part.schema).parquet(*[path(r) for r in runs]).select(part.columns)

    touched = read([own]).select(REPORT).distinct()
    merged = read([*before, own]).join(touched, REPORT, "left_semi").groupBy(id_col, REPORT)
    aggs = []
    for c in categories:
        hit = F.col("column_name") == F.lit(c)
        aggs += [F.coalesce(f(F.when(hit, F.col(v))) / scale, F.lit(0.0)).alias(f"{c}_{name}_amt")
                 for name, f, v in (("sum", F.sum, "s"), ("max", F.max, "x"), ("min", F.min, "n"))]
    write_partitioned(merged.agg(*aggs), f"{root}/mart", REPORT, replace="partitions")
    due = sorted({*before, own} - set(after))
    if due:
        (new,) = set(after) - set(before)
        write_partitioned(_combine(read(due), keys), path(new), REPORT, replace="table")


def run_available(rows: DataFrame, root: str, *, id_col: str, categories: Sequence[str], scale: float = 100.0,
                  fan: int = FAN) -> None:
    """Process everything available now; ``root`` (a shared folder) holds parts, mart and the stream's checkpoint."""
    q = (rows.writeStream.outputMode("append").option("checkpointLocation", f"{root}/ckpt")
         .foreachBatch(lambda df, i: merge_batch(df, i, root, id_col=id_col, categories=categories, scale=scale, fan=fan))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_mart(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/mart").withColumn(REPORT, F.col(REPORT).cast("date"))
