"""Running sums and row numbers that never put a whole group in one task.

``Window.partitionBy(g).orderBy(o)`` sends every row of group ``g`` to one
task.  When a group can hold a third of all rows (one class of a binary
target, one feature's distinct scores) that task becomes the job.  The
two-level form here range-partitions on ``(g, o)`` so each slice is
bounded, computes local sums inside each slice, and adds the totals of
the earlier slices of the same group (a table of ``groups x slices``
rows).  Every input takes this path, whatever its size.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoria.session import cut_lineage

__all__ = ["running_sums", "dist_row_number", "stored_row_number", "hash_row_number", "join_null_safe"]


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """``left.join(right, on, how)`` in which a null key meets a null key (an inner or left join)."""
    mine = {c: f"__r_{i}" for i, c in enumerate(on)}
    r = right.select(*[F.col(c).alias(mine[c]) for c in on], *[c for c in right.columns if c not in mine])
    met = F.lit(True)
    for c in on:
        met = met & left[c].eqNullSafe(F.col(mine[c]))
    return left.join(r, met, how).drop(*mine.values())


def _n_slices(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def running_sums(df: DataFrame, group: Sequence[str], order: Sequence[str],
                 values: Sequence[str], prefix: str = "cum_", inclusive: bool = False,
                 slices: int | None = None, materialise: bool = True) -> DataFrame:
    """Add ``cum_<v>``: sum of ``v`` over earlier rows of the same group.

    Rows are ordered by ``order`` (which should be unique within a group
    for a deterministic result).  Exclusive by default.  Null is a group like any other.
    """
    group, order, values = list(group), list(order), list(values)
    frame = (Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    n = _n_slices(df, slices)
    # the range partitioner reads its input twice (sample, then shuffle): an aggregate is
    # evaluated once and kept; a plain projection of a scan is cheaper to read again
    r = (cut_lineage(df) if materialise else df).repartitionByRange(n, *[F.col(c) for c in group + order]).withColumn("_slice", F.spark_partition_id())
    # Both branches below must see the same slice ids; range bounds come
    # from sampling, so materialise once (reliable checkpoint in the shared
    # folder — also survives executor loss).
    r = cut_lineage(r)
    w_local = Window.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(*frame)
    local = r.select("*", *[F.coalesce(F.sum(v).over(w_local), F.lit(0)).alias(f"_l_{v}") for v in values])
    tot = r.groupBy(*group, "_slice").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    w_off = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*group, "_slice",
                     *[F.coalesce(F.sum(f"_t_{v}").over(w_off), F.lit(0)).alias(f"_o_{v}") for v in values])
    out = join_null_safe(local, off, group + ["_slice"])
    return out.select(*df.columns, *[(F.col(f"_l_{v}") + F.col(f"_o_{v}")).alias(f"{prefix}{v}") for v in values])


def dist_row_number(df: DataFrame, group: Sequence[str], order: Sequence[str],
                    name: str = "rn", slices: int | None = None, materialise: bool = False) -> DataFrame:
    """1-based ``row_number() over (partition by group order by order)``, distributed."""
    one = "_one_"
    r = running_sums(df.withColumn(one, F.lit(1)), group, order, [one], prefix="_rn", inclusive=True,
                     slices=slices, materialise=materialise)
    return r.withColumnRenamed(f"_rn{one}", name).drop(one)


def _before(counts: dict[int, int], n: int) -> list[int]:
    """For each of ``n`` slices the rows of those before it."""
    return [0, *accumulate(counts.get(i, 0) for i in range(n))][:-1]


def stored_row_number(df: DataFrame, order: Sequence[str], keep: Sequence[str], name: str = "rn", slices: int | None = None) -> tuple[DataFrame, int]:
    """``keep`` and the 1-based ``row_number() over (order by order)``, stored, and the number of rows.

    A row is numbered by its place in its slice, so only the kept columns are stored and the sort leaves nothing else."""
    n = _n_slices(df, slices)
    cols = [F.col(c) for c in order]
    placed = cut_lineage(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).select(*keep, F.monotonically_increasing_id().alias("_at")))
    piece = F.shiftright("_at", 33)
    counts = {r.piece: r["count"] for r in placed.groupBy(piece.alias("piece")).count().collect()}
    if not counts:
        return placed.withColumnRenamed("_at", name), 0
    before = F.lit(_before(counts, max(counts) + 1))
    place = before[piece.cast("int")] + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.select(*keep, place.alias(name)), sum(counts.values())


#: Rows of a bucket of ``hash_row_number``.
BUCKET_ROWS = 100_000


def hash_row_number(df: DataFrame, digest: Column, order: Sequence[str], keep: Sequence[str], rows: int, name: str = "rn") -> DataFrame:
    """``keep`` and the 1-based ``row_number() over (order by digest, order)`` of about ``rows`` rows; ``digest`` is a hex hash.

    Buckets of the hash are alike in size and in order: they are counted first, and each row is moved once, without its hash."""
    n = min(1 << 20, max(_n_slices(df, None), rows // BUCKET_ROWS + 1))
    first = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    bucket = F.coalesce(F.floor(first * n / (1 << 32)), F.lit(0)).cast("int")
    counts = {r.bucket: r["count"] for r in df.groupBy(bucket.alias("bucket")).count().collect()}
    w = Window.partitionBy("_bucket").orderBy("_digest", *order)
    moved = df.withColumn("_bucket", bucket).repartition("_bucket").withColumn("_digest", digest)
    return moved.select(*keep, (F.lit(_before(counts, n))[F.col("_bucket")] + F.row_number().over(w)).alias(name))
