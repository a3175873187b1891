"""Secret scan with corpus-wide ownership frequencies (DataFrame functions only).

Candidates are assignments to secret-looking names, access keys, long hex
strings (the base kinds) and mixed tokens of 24 or more letters, digits,
``_`` and ``-`` with lower case, upper case and at least three digits.
``split`` and ``regexp_extract_all`` give the text between and in the
matches of a kind; running sums of their lengths give code-point places.
The hash of each candidate's value is aggregated over the corpus by
distinct repositories and owners: a value that more than ``max_owners``
owners hold, or that stands in more than ``max_repos`` repositories, be it
of one owner, is a widely copied example; the others look live.  Base spans
always stay; a mixed token is reported if it looks live and does not
overlap a base span.

Defined cases: a null text is empty and has no spans; a null owner is an
owner of its own, as is a null repository; repeated rows are rows of their
own (with the same owner they do not raise the owners' count); ties in
place go by kind; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoria.llm.common import col
from scoria.session import cut_lineage

__all__ = ["KINDS", "candidates", "places", "ownership", "scan", "MAX_OWNERS", "MAX_REPOS"]

#: kind -> (pattern, group that holds the value, least length of the value, base kind or not); in the order of reports.
KINDS = {
    "assign": (r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8, True),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16, True),
    "hex": (r"[0-9a-f]{32,}", 0, 32, True),
    "mixed": (r"[A-Za-z0-9_-]{24,}", 0, 24, False),
}
MAX_OWNERS = 2
#: The documents table names no repositories, so by default a document is one.
MAX_REPOS = 10


def candidates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
               repo_col: str = "doc_id") -> DataFrame:
    """One row per document: rid, doc_id, h (xxhash64 of the text), owner, repo and, for each kind that
    matches, the lengths of what stands between (gap), in the match (len) and of the value, and its hash."""
    text = col(text_col)
    found = []
    for k, (pattern, group, _, base) in enumerate(KINDS.values()):
        p = F.lit(pattern)
        value = F.regexp_extract_all(text, p, F.lit(group))
        mixed = lambda x: F.lit(True) if base else (
            x.rlike("[a-z]") & x.rlike("[A-Z]") & x.rlike("[0-9][^0-9]*[0-9][^0-9]*[0-9]"))
        found.append(F.when(F.regexp_like(text, p), F.struct(
            F.lit(k).alias("k"), F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gap"),
            F.transform(F.regexp_extract_all(text, p, F.lit(0)), lambda x: F.length(x)).alias("len"),
            F.transform(value, lambda x: F.struct(F.length(x).alias("n"), F.xxhash64(x).alias("h"), mixed(x).alias("ok")))
            .alias("value"))))
    return docs.select(F.monotonically_increasing_id().alias("rid"), col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("h"), col(owner_col).cast("string").alias("owner"),
                       col(repo_col).cast("string").alias("repo"), F.array_compact(F.array(*found)).alias("found"))


def places(found: DataFrame) -> DataFrame:
    """(rid, owner, repo, k, start, end, value): candidates with their places, without those too short
    and without mixed tokens that overlap a base span."""
    one = found.select("rid", "owner", "repo", F.explode("found").alias("f"))
    one = one.select("rid", "owner", "repo", F.col("f.k").alias("k"),
                     F.posexplode(F.arrays_zip("f.gap", "f.len", "f.value")).alias("i", "m"))
    upto = Window.partitionBy("rid", "k").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = (F.sum("m.gap").over(upto) + F.sum("m.len").over(upto)).cast("long")
    at = one.where(F.col("m.len").isNotNull()).select(
        "rid", "owner", "repo", "k", (end - F.col("m.len")).alias("start"), end.alias("end"),
        F.col("m.value.h").alias("value"), F.col("m.value.n").alias("n"), F.col("m.value.ok").alias("ok"))
    least = F.element_at(F.array(*[F.lit(v[2]) for v in KINDS.values()]), F.col("k") + 1)
    base = F.element_at(F.array(*[F.lit(v[3]) for v in KINDS.values()]), F.col("k") + 1)
    at = at.where((F.col("n") >= least) & F.col("ok")).withColumn("base", base)
    order = Window.partitionBy("rid").orderBy("start", "k")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    alone = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    at = at.withColumn("alone", alone)
    return at.where(F.col("base") | F.col("alone")).select("rid", "owner", "repo", "k", "start", "end", "value", "base")


def ownership(at: DataFrame) -> DataFrame:
    """(value, owners, repos): distinct owners and repositories of each candidate value."""
    count = lambda c, name: at.select("value", c).distinct().groupBy("value").agg(F.count(F.lit(1)).alias(name))
    return count("owner", "owners").join(count("repo", "repos"), "value")


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_col: str = "doc_id", max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per document: doc_id, h and spans (start, kind number, end, base, live, owners, repos), sorted."""
    found = cut_lineage(candidates(docs, id_col=id_col, text_col=text_col, owner_col=owner_col, repo_col=repo_col))
    at = cut_lineage(places(found))
    few = (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
    known = at.join(ownership(at), "value").withColumn("live", few)
    known = known.where(F.col("base") | F.col("live"))
    spans = known.groupBy("rid").agg(F.sort_array(F.collect_list(
        F.struct("start", "k", "end", "base", "live", "owners", "repos"))).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return found.select("rid", "doc_id", "h").join(spans, "rid", "left").select(
        "doc_id", "h", F.coalesce("spans", none).alias("spans"))
