"""A training-corpus pipeline over the ``documents`` table, from the operators in ``scoria.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; every
stage but the last returns the columns of its input, and is written as
Parquet in the shared folder and read again before the next.

1. language_id: documents whose language is rejected go.
2. simhash_dedup: one document of each near-duplicate group stays, the
   one with the smallest id (null ids last, then the hash of the text).
3. decontamination: documents with a word in a benchmark window go.
4. secret_scan: documents with a live-looking secret go; examples that
   are copied widely, by many sources or in many documents, do no harm.
5. mixing: the curriculum mix of what is left, a row per copy in the order
   of training; a document that is not taken has one row without a copy.
   ``doc_id`` and ``text_hash`` (xxhash64) lead back to the document.

Rows are addressed by (doc_id, xxhash64 of the text), so null and repeated
ids, and other columns of any name, are carried along; an empty table
passes through every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoria.llm import decontaminate, langid, mixing, secret_scan, simhash
from scoria.llm.common import col, crc_mod5, table
from scoria.session import checkpoint_dir, ship_package


def _matching(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with ("left_semi") or without ("left_anti") their (doc_id, h) in ``keys``."""
    keys = keys.select(F.col("doc_id").alias("__llm_id"), F.col("h").alias("__llm_h"))
    on = F.col("__llm_id").eqNullSafe(col("doc_id").cast("long")) & (F.col("__llm_h") == F.xxhash64(col("text")))
    return docs.join(keys, on, how)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    model = langid.fit(docs, crc_mod5() != 0)
    return docs.where(~langid.identify(col("text"), model)["rejected"])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    rows = simhash.groups(docs).groupBy("root", "doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "n")).alias("b"))
    best = best.select("b.doc_id", "b.h", "b.n")
    kept = _matching(docs, best.where("n = 1"), "left_semi")
    # the same id and text in several rows: the smallest row by its JSON form stays
    again = _matching(docs, best.where("n > 1"), "left_semi")
    row = F.struct(*[col(c) for c in docs.columns])
    one = again.groupBy(col("doc_id").alias("__llm_id"), F.xxhash64(col("text")).alias("__llm_h")).agg(
        F.min_by(row, F.to_json(row)).alias("__llm_row"))
    return kept.unionByName(one.select("__llm_row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _matching(docs, decontaminate.report(docs, table(spark, sf_dir, "benchmark")), "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    live = secret_scan.scan(docs).where(F.exists("spans", lambda x: x["live"])).select("doc_id", "h").distinct()
    return _matching(docs, live, "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return mixing.copies(docs)


STAGES = [("language_id", language_id), ("simhash_dedup", simhash_dedup), ("decontamination", decontamination),
          ("secret_scan", secrets), ("mixing", mix)]

#: The stages hash, train and compress in ways that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    ship_package(spark)
    docs, folder = table(spark, sf_dir, "documents"), f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
