"""Stand-in inputs built from the driver tables, in Spark and in SQL.

The same definitions exist twice — as DataFrame code and as SQL text for
the DuckDB oracle — so every registered query and its oracle read the
identical derived rows.  See FIXTURES.md for the roles.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoria.functions.exprs import md5_bucket, row_key
from scoria.operators.mart import map_codes
from scoria.sources.io import read_table

# ---- fixed values of the stand-in mart (chosen here, not from the reference)
# merchant group (p_type) -> feature column prefix; the sixth type falls to "other"
CATEGORY_MAP = {"STANDARD": "standard", "ECONOMY": "economy", "SMALL": "small",
                "MEDIUM": "medium", "PROMO": "promo"}
CATEGORIES = ["standard", "economy", "small", "medium", "promo", "other"]
CHOSEN_TYPES = ["N", "R"]              # transaction types kept (l_returnflag)
MART_START = _dt.date(1995, 1, 1)
MART_STOP = _dt.date(1997, 1, 1)       # complete periods before this date
MART_DELTA = 7                         # days per period
OOT_PIVOT = _dt.date(2000, 1, 1)       # train < pivot <= out-of-time

# planted label: y = 0.06*q + 10*d + 0.8*[flag = 'R'] + 4*u > 5.4
FEATURES_REAL = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
FEATURES_CAT = ["l_returnflag", "l_linestatus"]
FEATURES = FEATURES_REAL + FEATURES_CAT


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [read_table(spark, n, sf_dir) for n in names]


# ---------------------------------------------------------------- Spark side

def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card-transaction stand-in: client, merchant, amount (minor units), type, day."""
    li, o = tables(spark, sf_dir, "lineitem", "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(F.col("o_custkey").alias("client_id"),
                    F.col("l_partkey").alias("merchant"),
                    F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("amount"),
                    F.col("l_returnflag").alias("trans_type"),
                    F.col("l_shipdate").alias("day"))   # raw timestamp: the mart filters it at the scan


def merchant_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    (part,) = tables(spark, sf_dir, "part")
    return map_codes(part, "p_partkey", "p_type", CATEGORY_MAP)


def scorecard_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted-label training frame with planted nulls and rare categories.

    Columns: k (row key), grp (group id), target, features, ship_dt,
    sample ('train' before OOT_PIVOT else 'oot').
    """
    (li,) = tables(spark, sf_dir, "lineitem")
    k = row_key("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    u = md5_bucket(k)
    y = (F.lit(0.06) * F.col("l_quantity") + F.lit(10.0) * F.col("l_discount")
         + F.when(F.col("l_returnflag") == "R", F.lit(0.8)).otherwise(F.lit(0.0))
         + F.lit(4.0) * u) > F.lit(5.4)
    ok = F.col("l_orderkey")
    return li.select(
        k.alias("k"),
        ok.alias("grp"),
        y.cast("int").alias("target"),
        F.when(ok % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.when(ok % 5003 == 0, F.lit(None).cast("double")).otherwise(F.col("l_discount")).alias("l_discount"),
        F.col("l_tax"), F.col("l_extendedprice"),
        F.when(ok % 211 == 0, F.concat(F.lit("Z"), (F.col("l_partkey") % 50).cast("string")))
         .otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        F.col("l_linestatus"),
        F.to_date("l_shipdate").alias("ship_dt"),
        F.when(F.to_date("l_shipdate") < F.lit(OOT_PIVOT), F.lit("train")).otherwise(F.lit("oot")).alias("sample"),
    )


# ---------------------------------------------------------------- SQL side

def _case_map() -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATEGORY_MAP.items())
    return f"CASE p_type {whens} ELSE 'other' END"


SQL_TX = f"""tx AS (
  SELECT o.o_custkey AS client_id, l.l_partkey AS merchant,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS amount,
         l.l_returnflag AS trans_type, CAST(l.l_shipdate AS DATE) AS day
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
codes AS (SELECT p_partkey AS merchant, {_case_map()} AS column_name FROM part)"""

SQL_KEY = ("concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), "
           "CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))")


def sql_md5_bucket(expr: str) -> str:
    return f"(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)"


SQL_FRAME = f"""frame AS (
  SELECT {SQL_KEY} AS k, l_orderkey AS grp,
    CAST((0.06 * l_quantity + 10.0 * l_discount
          + CASE WHEN l_returnflag = 'R' THEN 0.8 ELSE 0.0 END
          + 4.0 * {sql_md5_bucket(SQL_KEY)}) > 5.4 AS INTEGER) AS target,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
    CASE WHEN l_orderkey % 5003 = 0 THEN NULL ELSE l_discount END AS l_discount,
    l_tax, l_extendedprice,
    CASE WHEN l_orderkey % 211 = 0 THEN 'Z' || CAST(l_partkey % 50 AS VARCHAR) ELSE l_returnflag END AS l_returnflag,
    l_linestatus,
    CAST(l_shipdate AS DATE) AS ship_dt,
    CASE WHEN CAST(l_shipdate AS DATE) < DATE '{OOT_PIVOT}' THEN 'train' ELSE 'oot' END AS sample
  FROM lineitem)"""


def sql_long(features_real=FEATURES_REAL, features_cat=FEATURES_CAT, src: str = "frame",
             extra: str = "k, target, sample") -> str:
    """Unpivot SQL: (extra..., feature, xr DOUBLE, xc VARCHAR)."""
    parts = [f"SELECT {extra}, '{f}' AS feature, CAST({f} AS DOUBLE) AS xr, CAST(NULL AS VARCHAR) AS xc FROM {src}"
             for f in features_real]
    parts += [f"SELECT {extra}, '{f}' AS feature, CAST(NULL AS DOUBLE) AS xr, {f} AS xc FROM {src}"
              for f in features_cat]
    return "\n  UNION ALL ".join(parts)
