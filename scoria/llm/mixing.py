"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1]: linear,
``base * (1 + slope * (2t - 1))``.  Its integral is the share of the
source's demand that is met by time t; inverting it turns a document's
place in its source's token sequence into a training position.  Each copy
of a document has a position of its own: in lap ``k`` (from 0) the place is
``start + k * source_size``.  ``copies`` gives a row per copy, range-sorted
by position; ``mix`` a row per document, sorted by its first one.

Targets: sources ordered by code point (null last) weigh ``weights`` in
turn and share ``total`` times all words.  No target passes ``most`` times
its source's size; what is above is shared again by weight among the
others until none is above.  The solution is ``min(most * size, level *
weight)``; ``level`` comes from one running sum over the sources by size per
weight, which no task holds whole.

A source's documents stand in the order of ``md5(id), id, size`` and the
hash of the text; rows equal in all of these are counted first and laid out
one after another, so that a hot id, null among them, is one row of the
sums.  The mix
runs over that sequence, again from its start after its end, until the
target (rounded) is reached: the document there is cut, so a source's
taken words equal its rounded target and no document passes ``most`` times
its size.  The running sum is taken in two levels: a source is split by
the leading digits of the hash, each slice sums by itself, and the slices'
totals are added up, so that no task holds a whole source.

Defined cases: null or empty text has size 0 and takes 0; a null source is
a source of its own, the last; a null id is hashed as the empty text;
repeated rows are rows like any others; an empty table gives an empty
table; a source of size 0 has target 0.  Reruns agree, because only
column values decide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoria.llm.common import col, partitions
from scoria.operators.ranking import dist_row_number, running_sums
from scoria.session import cut_lineage

__all__ = ["n_words", "targets", "mix", "copies", "WEIGHTS", "SLOPES"]

WEIGHTS = (5, 2, 1)
#: Slopes of the schedules, in turn by source: early, even and late sources.
SLOPES = (-0.5, 0.0, 0.5)
#: Equal rows that are laid out from one array.
RUN = 4096


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, *, weights: Sequence[int] = WEIGHTS, slopes: Sequence[float] = SLOPES,
            total: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, weight, slope, target) from rows (source, size)."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.col("rank") - 1
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (rank % len(xs) + 1).cast("int"))
    by = dist_row_number(by, [], ["source"], name="rank", materialise=True)
    room = F.col("source_size") * float(most)
    by = cut_lineage(by.select("source", "source_size", pick([int(w) for w in weights]).alias("weight"),
                               pick([float(s) for s in slopes]).alias("slope")))
    # by rising room per weight: what is left for a source and those after it, if all before it are full, per
    # weight of them.  This level rises as long as the source before it was below it, so the largest one holds.
    ratio = F.coalesce(F.try_divide(room, F.col("weight").cast("double")), F.lit(float("inf")))
    sums = running_sums(by.select("source", ratio.alias("ratio"), room.alias("room"), F.col("weight").cast("long").alias("weight")),
                        [], ["ratio", "source"], ["room", "weight"], prefix="full_")
    r = by.agg(F.sum("source_size").alias("all"), F.sum("weight").alias("w")).first()
    left = F.lit(float(total * (r["all"] or 0))) - F.col("full_room")
    level = sums.agg(F.max(F.try_divide(left, (F.lit(r["w"] or 0) - F.col("full_weight")).cast("double")))).first()[0] or 0.0
    return by.withColumn("target", F.least(room.cast("double"), F.col("weight") * F.lit(float(level))))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, slopes: Sequence[float] = SLOPES, total: float = 1.5,
        most: float = 2.0, digits: int = 3) -> DataFrame:
    """One row per document: doc_id, text_hash (xxhash64), size, source_size, target, taken, position (of its first copy), positions
    (of all copies, an array), range-sorted.

    ``digits`` hexadecimal digits of the hash cut a source into 16**digits
    slices.  ``position`` is null for a document of which nothing is taken,
    ``positions`` empty.
    """
    placed = _placed(docs, id_col=id_col, text_col=text_col, source_col=source_col, weights=weights, slopes=slopes,
                     total=total, most=most, digits=digits)
    out = placed.select("doc_id", "text_hash", "size", "source_size", "target", "taken",
                        F.try_element_at("copies", F.lit(1))["position"].alias("position"),
                        F.col("copies")["position"].alias("positions"))
    return _sorted(out)


def copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: Sequence[int] = WEIGHTS, slopes: Sequence[float] = SLOPES, total: float = 1.5,
           most: float = 2.0, digits: int = 3) -> DataFrame:
    """One row per copy of a document: doc_id, text_hash (xxhash64), size, source_size, target, copy (1 is the
    first), taken (words of this copy), position, range-sorted.

    A document of which nothing is taken has one row, with taken 0 and
    without copy and position, after all others.
    """
    placed = _placed(docs, id_col=id_col, text_col=text_col, source_col=source_col, weights=weights, slopes=slopes,
                     total=total, most=most, digits=digits)
    out = placed.select("doc_id", "text_hash", "size", "source_size", "target", F.explode_outer("copies").alias("c"))
    return _sorted(out.select("doc_id", "text_hash", "size", "source_size", "target", "c.copy",
                              F.coalesce("c.taken", F.lit(0)).cast("long").alias("taken"), "c.position"))


def _sorted(out: DataFrame) -> DataFrame:
    # the id spreads documents without a position, too
    order = [F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_last()]
    return out.repartitionByRange(partitions(out.sparkSession), *order).sortWithinPartitions(*order)


def _placed(docs: DataFrame, *, id_col: str, text_col: str, source_col: str, weights: Sequence[int],
            slopes: Sequence[float], total: float, most: float, digits: int) -> DataFrame:
    """One row per document, with its copies (copy, taken, position) in the order of their laps."""
    key = ["source", "h", "doc_id", "size", "text_hash"]
    sizes = cut_lineage(docs.select(
        col(id_col).cast("long").alias("doc_id"), n_words(col(text_col)).alias("size"),
        # a key without nulls, in the order of sources, null last
        F.when(col(source_col).isNull(), "1").otherwise(F.concat(F.lit("0"), col(source_col).cast("string")))
        .alias("source"),
        F.md5(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")).alias("h"),
        F.xxhash64(col(text_col)).alias("text_hash")).groupBy(*key).agg(F.count(F.lit(1)).alias("n")))
    words = F.col("size") * F.col("n")
    goal = targets(sizes.select("source", words.alias("size")), weights=weights, slopes=slopes, total=total, most=most)
    cut = sizes.withColumn("slice", F.substring("h", 1, digits))
    # source -> (slice totals before): at most 16**digits rows a source
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = cut.groupBy("source", "slice").agg(F.sum(words).alias("n_slice"))
    slices = slices.select("source", "slice", F.coalesce(F.sum("n_slice").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "slice").orderBy("h", F.col("doc_id").asc_nulls_last(), "size", "text_hash") \
        .rowsBetween(Window.unboundedPreceding, -1)
    rows = cut.withColumn("own", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    placed = rows.join(slices, ["source", "slice"]).join(goal, "source")
    # equal rows again, by runs, so that no array is longer than a run
    placed = placed.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long"))))
    placed = placed.withColumn("nth", F.explode(F.sequence("run", F.least(F.col("run") + (RUN - 1), F.col("n") - 1))))
    start = F.col("own") + F.col("base") + F.col("nth") * F.col("size")
    want = F.round("target").cast("long")
    part = lambda lap: F.greatest(F.lit(0), F.least(F.col("size"), want - start - lap * F.col("source_size")))
    laps = range(int(-(-most // 1)))
    taken = sum((part(lap) for lap in laps[1:]), part(0)).cast("long")
    slope = F.col("slope")

    def when(lap):
        share = F.try_divide((start + lap * F.col("source_size")).cast("double"), F.col("target"))
        # t with t + slope * (t*t - t) = share
        return F.when(slope == 0, share).otherwise(
            F.try_divide(slope - 1 + F.sqrt((1 - slope) * (1 - slope) + 4 * slope * share), 2 * slope))

    each = [F.when(part(lap) > 0, F.struct(F.lit(lap + 1).alias("copy"), part(lap).cast("long").alias("taken"),
                                           when(lap).alias("position"))) for lap in laps]
    return placed.select("doc_id", "text_hash", "size", "source_size", "target", taken.alias("taken"),
                         F.array_compact(F.array(*each)).alias("copies"))
