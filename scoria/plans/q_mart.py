"""Queries for build steps 1-2: marts, sources, filters, labels, datasets, sampling."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from scoria.functions.exprs import month_end, prev_month_end, sentinel_date
from scoria.operators import labels as L
from scoria.operators import mart as M
from scoria.operators import sampling as P
from scoria.plans import fixtures as X
from scoria.plans.registry import ORACLES, query
from scoria.sources.io import in_list

D0, D1 = X.MART_START, _dt.date(1995, 12, 31)
K = M.n_periods(X.MART_START, X.MART_STOP, X.MART_DELTA)
LAST = X.MART_START + _dt.timedelta(days=K * X.MART_DELTA - 1)
TYPES_SQL = ", ".join(f"'{t}'" for t in X.CHOSEN_TYPES)


def _tx_filtered_sql(first, last) -> str:
    return f"""WITH {X.SQL_TX},
t AS (SELECT tx.client_id, tx.amount AS amt, codes.column_name, tx.day
      FROM tx JOIN codes ON tx.merchant = codes.merchant
      WHERE tx.day BETWEEN DATE '{first}' AND DATE '{last}' AND tx.trans_type IN ({TYPES_SQL}))"""


def _agg(spark, sf):
    return M.category_agg(X.transactions(spark, sf), X.merchant_codes(spark, sf), id_col="client_id",
                          amount="amount", code="merchant", day="day", first=D0, last=D1,
                          type_col="trans_type", types=X.CHOSEN_TYPES)


@query("mart_agg", sql=_tx_filtered_sql(D0, D1) + """
SELECT client_id, column_name, CAST(sum(amt) AS BIGINT) AS sum_amt, max(amt) AS max_amt,
       min(amt) AS min_amt, count(amt) AS cnt
FROM t GROUP BY client_id, column_name""")
def mart_agg(spark, sf):
    """G1 (+F1, F4, F11, F12, J1): long-form category aggregates for 1995."""
    return _agg(spark, sf)


def _pivot_sql_cols(src_sum="sum_amt", src_max="max_amt", src_min="min_amt", agg="max") -> str:
    cols = []
    for c in X.CATEGORIES:
        for s, src in (("sum_amt", src_sum), ("max_amt", src_max), ("min_amt", src_min)):
            cols.append(f"round(coalesce({agg}(CASE WHEN column_name = '{c}' THEN {src} END) / 100.0, 0), 6) AS {c}_{s}")
    return ",\n       ".join(cols)


@query("mart_pivot", sql=_tx_filtered_sql(D0, D1) + """,
a AS (SELECT client_id, column_name, sum(amt) AS sum_amt, max(amt) AS max_amt, min(amt) AS min_amt
      FROM t GROUP BY client_id, column_name)
SELECT client_id,
       """ + _pivot_sql_cols() + """
FROM a GROUP BY client_id""")
def mart_pivot(spark, sf):
    """Pivot of the 1995 aggregates to one wide row per client."""
    return M.pivot_features(_agg(spark, sf), ["client_id"], X.CATEGORIES)


def _mart(spark, sf, start=X.MART_START, stop=X.MART_STOP, delta=X.MART_DELTA):
    return M.category_mart(X.transactions(spark, sf), X.merchant_codes(spark, sf), id_col="client_id",
                           amount="amount", code="merchant", day="day", start=start, stop=stop,
                           delta=delta, categories=X.CATEGORIES, type_col="trans_type",
                           types=X.CHOSEN_TYPES)


def _period_sql(start, delta, col="day") -> str:
    return (f"(DATE '{start}' + CAST((floor(datediff('day', DATE '{start}', {col}) / {delta}) + 1) "
            f"* {delta} - 1 AS INTEGER))")


def _mart_cols_sql() -> str:
    cols = []
    for c in X.CATEGORIES:
        cols += [f"round(coalesce(sum(CASE WHEN column_name = '{c}' THEN amt END) / 100.0, 0), 6) AS {c}_sum_amt",
                 f"round(coalesce(max(CASE WHEN column_name = '{c}' THEN amt END) / 100.0, 0), 6) AS {c}_max_amt",
                 f"round(coalesce(min(CASE WHEN column_name = '{c}' THEN amt END) / 100.0, 0), 6) AS {c}_min_amt"]
    return ",\n       ".join(cols)


MART_SQL = _tx_filtered_sql(X.MART_START, LAST) + f"""
SELECT client_id, {_period_sql(X.MART_START, X.MART_DELTA)} AS report_dt,
       {_mart_cols_sql()}
FROM t WHERE client_id IS NOT NULL GROUP BY 1, 2"""


@query("mart_periods", sql=MART_SQL)
def mart_periods(spark, sf):
    """G3 (+U2): weekly category mart over all complete periods in one job."""
    return _mart(spark, sf)


# ------------------------------------------------------------------ sources / filters

CITY_REGION = 3  # cities list = nations of one region


@query("semi_city", sql=f"""
SELECT c.c_custkey, n.n_name AS client_city
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_name IN (SELECT n_name FROM nation WHERE n_regionkey = {CITY_REGION})""")
def semi_city(spark, sf):
    """Profile rows whose city is in a list held in a table (left-semi join)."""
    c, n = X.tables(spark, sf, "customer", "nation")
    prof = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", F.col("n_name").alias("client_city"))
    cities = n.where(F.col("n_regionkey") == CITY_REGION).select(F.col("n_name").alias("value"))
    return in_list(prof, "client_city", cities)


@query("sentinel_date", sql="""
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END,
                            DATE '2046-01-01') AS contact_dt
FROM orders""")
def sentinel_date_q(spark, sf):
    """null dates -> far-future sentinel (partitionable)."""
    (o,) = X.tables(spark, sf, "orders")
    d = F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.to_date("o_orderdate"))
    return o.select("o_orderkey", sentinel_date(d).alias("contact_dt"))


@query("month_end", sql="""
SELECT o_orderkey, CAST(o_orderdate AS DATE) - CAST(day(o_orderdate) AS INTEGER) AS prev_month_end,
       last_day(CAST(o_orderdate AS DATE)) AS month_end,
       CAST(o_orderdate AS DATE) - 3 AS minus3, CAST(o_orderdate AS DATE) + 3 AS plus3
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""")
def month_end_q(spark, sf):
    """date shifts and month keys."""
    (o,) = X.tables(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    return (o.where(d.between(F.lit("1996-01-01").cast("date"), F.lit("1997-12-31").cast("date")))
             .select("o_orderkey", prev_month_end(d).alias("prev_month_end"), month_end(d).alias("month_end"),
                     F.date_sub(d, 3).alias("minus3"), F.date_sub(d, -3).alias("plus3")))


@query("class_counts", sql=f"""WITH {X.SQL_FRAME}
SELECT sample, target, count(*) AS n FROM frame GROUP BY sample, target""")
def class_counts_q(spark, sf):
    """Class counts per snapshot/sample."""
    return X.scorecard_frame(spark, sf).groupBy("sample", "target").agg(F.count(F.lit(1)).alias("n"))


@query("target_sum", sql=f"""WITH {X.SQL_FRAME}
SELECT CAST(sum(target) AS BIGINT) AS n_pos, count(*) AS n FROM frame""")
def target_sum(spark, sf):
    """Global sum of the target."""
    f = X.scorecard_frame(spark, sf)
    return f.agg(F.sum("target").cast("bigint").alias("n_pos"), F.count(F.lit(1)).alias("n"))


@query("left_dim", sql="""
SELECT o.*, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def left_dim(spark, sf):
    """Left join, all fact columns plus two dimension columns."""
    o, c = X.tables(spark, sf, "orders", "customer")
    return o.join(c.select("c_custkey", "c_name", "c_mktsegment"), o.o_custkey == c.c_custkey, "left").drop("c_custkey")


@query("join_literal", sql="""
SELECT o.o_orderkey, o.o_custkey, c.c_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_mktsegment = 'BUILDING'""")
def join_literal(spark, sf):
    """Inner join with a literal predicate in ON (pushed to the dimension scan)."""
    o, c = X.tables(spark, sf, "orders", "customer")
    cond = (o.o_custkey == c.c_custkey) & (c.c_mktsegment == F.lit("BUILDING"))
    return o.join(c, cond).select("o_orderkey", "o_custkey", "c_name")


# ------------------------------------------------------------------ labels and datasets

PARTNER = "1-URGENT"


@query("label_shift", sql=f"""
SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) - 3 AS report_dt, 1 AS target
FROM orders WHERE o_orderpriority = '{PARTNER}'""")
def label_shift(spark, sf):
    """F14/J2 labels: partner purchases keyed 3 days before the event, de-duplicated."""
    (o,) = X.tables(spark, sf, "orders")
    return L.label_events(o, id_col="o_custkey", date_col="o_orderdate", partner_col="o_orderpriority",
                          partner=PARTNER, shift_days=3)


@query("label_fanout", sql=f"""
SELECT o_custkey, CAST(o_orderdate AS DATE) - 3 AS report_dt, 1 AS target
FROM orders WHERE o_orderpriority = '{PARTNER}'""")
def label_fanout(spark, sf):
    """D15 reproduced: labels without de-duplication (fan-out on join)."""
    (o,) = X.tables(spark, sf, "orders")
    return L.label_events(o, id_col="o_custkey", date_col="o_orderdate", partner_col="o_orderpriority",
                          partner=PARTNER, shift_days=3, dedup=False)


FP_FIRST, FP_LAST = _dt.date(1995, 6, 1), _dt.date(1995, 8, 1)


@query("first_purchase", sql=f"""
WITH f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS d FROM orders
           WHERE o_orderpriority = '{PARTNER}' GROUP BY o_custkey)
SELECT o_custkey, d - CAST(day(d) AS INTEGER) AS report_dt_part, 1 AS target
FROM f WHERE d >= DATE '{FP_FIRST}' AND d < DATE '{FP_LAST}'""")
def first_purchase(spark, sf):
    """G4 + F15: first purchase per client, then the window filter, month-end key."""
    (o,) = X.tables(spark, sf, "orders")
    return L.label_events(o, id_col="o_custkey", date_col="o_orderdate", partner_col="o_orderpriority",
                          partner=PARTNER, first_only=True, first=FP_FIRST, last=FP_LAST,
                          month_end=True, key="report_dt_part")


SNAPS = (_dt.date(1995, 5, 31), _dt.date(1995, 6, 30))


def _in_months(c: str):
    """The snapshot months as ranges of the raw timestamp, which reach the scan (a function of it would not)."""
    ts = lambda d: F.lit(str(d)).cast("timestamp_ntz")
    months = [(F.col(c) >= ts(d.replace(day=1))) & (F.col(c) < ts(d + _dt.timedelta(days=1))) for d in SNAPS]
    return months[0] | months[1]


def _monthly_aggr(spark, sf):
    """Monthly snapshot features: spend per client per month end (from the mart source)."""
    t = X.transactions(spark, sf)
    me = F.last_day("day")
    t = t.where(_in_months("day"))
    return t.groupBy("client_id", me.alias("report_dt_part")).agg(
        (F.sum("amount") / 100.0).alias("spend"), F.count(F.lit(1)).alias("n_tx"),
        F.lit("x").alias("ctl_loading"))


def _profile(spark, sf):
    """Client profile snapshots: clients active in the month, with city."""
    o, c, n = X.tables(spark, sf, "orders", "customer", "nation")
    me = F.last_day(F.to_date("o_orderdate"))
    act = o.where(_in_months("o_orderdate")).select(
        F.col("o_custkey").alias("client_id"), me.alias("report_dt_part")).distinct()
    cn = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_custkey").alias("client_id"),
                                                          F.col("n_name").alias("client_city"))
    return act.join(cn, "client_id").withColumn("report_dt", F.col("report_dt_part"))


_SNAPS_SQL = ", ".join(f"DATE '{s}'" for s in SNAPS)


@query("dataset_month", sql=f"""
WITH {X.SQL_TX},
a AS (SELECT client_id, last_day(day) AS report_dt_part, sum(amount) / 100.0 AS spend, count(*) AS n_tx
      FROM tx WHERE last_day(day) IN ({_SNAPS_SQL}) GROUP BY 1, 2),
act AS (SELECT DISTINCT o_custkey AS client_id, last_day(CAST(o_orderdate AS DATE)) AS report_dt_part
        FROM orders WHERE last_day(CAST(o_orderdate AS DATE)) IN ({_SNAPS_SQL})),
prof AS (SELECT act.client_id, act.report_dt_part, n.n_name AS client_city
         FROM act JOIN customer c ON act.client_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
         WHERE n.n_name IN (SELECT n_name FROM nation WHERE n_regionkey = {CITY_REGION})),
f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS d FROM orders
      WHERE o_orderpriority = '{PARTNER}' GROUP BY o_custkey),
lab AS (SELECT DISTINCT o_custkey AS client_id, d - CAST(day(d) AS INTEGER) AS report_dt_part FROM f
        WHERE d >= DATE '1995-06-01' AND d < DATE '1995-08-01')
SELECT a.client_id, a.report_dt_part, round(a.spend, 6) AS spend, a.n_tx, prof.client_city,
       CASE WHEN lab.client_id IS NULL THEN 0 ELSE 1 END AS target
FROM a JOIN prof ON a.client_id = prof.client_id AND a.report_dt_part = prof.report_dt_part
LEFT JOIN lab ON a.client_id = lab.client_id AND a.report_dt_part = lab.report_dt_part""")
def dataset_month(spark, sf):
    """J3 + S11 + F3 + F7 + F9: monthly training set (snapshots, profile, city list, labels)."""
    (o, n) = X.tables(spark, sf, "orders", "nation")
    lab = L.label_events(o, id_col="o_custkey", date_col="o_orderdate", partner_col="o_orderpriority",
                         partner=PARTNER, first_only=True, first=FP_FIRST, last=FP_LAST,
                         month_end=True, key="report_dt_part").withColumnRenamed("o_custkey", "client_id")
    cities = n.where(F.col("n_regionkey") == CITY_REGION).select(F.col("n_name").alias("value"))
    ds = L.build_dataset(_monthly_aggr(spark, sf), lab, ["client_id", "report_dt_part"],
                         profile=_profile(spark, sf), cities=cities)
    return ds.select("client_id", "report_dt_part", "spend", "n_tx", "client_city", "target")


@query("snapshot_counts", sql=f"""
SELECT report_dt_part, count(*) AS n_rows, CAST(sum(target) AS BIGINT) AS n_target FROM ({ORACLES["dataset_month"]}) d GROUP BY 1""")
def snapshot_counts(spark, sf):
    """Rows and buyers of each snapshot of the monthly training set."""
    return dataset_month(spark, sf).groupBy("report_dt_part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("target").cast("bigint").alias("n_target"))


DAY_STOP = _dt.date(1995, 4, 1)


@query("dataset_day", sql=_tx_filtered_sql(X.MART_START, DAY_STOP - _dt.timedelta(days=1)) + f""",
m AS (SELECT client_id, day AS report_dt,
       {_mart_cols_sql()}
      FROM t WHERE client_id IS NOT NULL GROUP BY 1, 2),
lab AS (SELECT DISTINCT o_custkey AS client_id, CAST(o_orderdate AS DATE) - 3 AS report_dt
        FROM orders WHERE o_orderpriority = '{PARTNER}')
SELECT m.*, CASE WHEN lab.client_id IS NULL THEN 0 ELSE 1 END AS target
FROM m LEFT JOIN lab ON m.client_id = lab.client_id AND m.report_dt = lab.report_dt""")
def dataset_day(spark, sf):
    """Daily mart (delta=1) left-join labels keyed 3 days before purchase."""
    (o,) = X.tables(spark, sf, "orders")
    mart = _mart(spark, sf, X.MART_START, DAY_STOP, 1)
    lab = L.label_events(o, id_col="o_custkey", date_col="o_orderdate", partner_col="o_orderpriority",
                         partner=PARTNER, shift_days=3).withColumnRenamed("o_custkey", "client_id")
    return L.build_dataset(mart, lab, ["client_id", "report_dt"])


@query("scores_vs_sales", sql="""
SELECT c.c_custkey, round(c.c_acctbal, 6) AS score,
       CASE WHEN b.o_custkey IS NULL THEN 0 ELSE 1 END AS target
FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey FROM orders
                           WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31') b
  ON c.c_custkey = b.o_custkey""")
def scores_vs_sales(spark, sf):
    """Score table left-join buyers, non-buyers -> 0."""
    c, o = X.tables(spark, sf, "customer", "orders")
    buyers = o.where(F.to_date("o_orderdate").between(F.lit("1996-01-01").cast("date"),
                                                      F.lit("1996-12-31").cast("date"))).select(
        F.col("o_custkey").alias("c_custkey"))
    return L.scores_vs_sales(c.select("c_custkey", F.col("c_acctbal").alias("score")), buyers, "c_custkey")


# ------------------------------------------------------------------ sampling

SAMPLE_FRACTIONS = {1: 0.5, 0: 0.1}
SALT = "|sample"  # the planted label already uses md5(k); a salt decorrelates the sample


@query("md5_sample", sql=f"""WITH {X.SQL_FRAME}
SELECT k, target FROM frame
WHERE {X.sql_md5_bucket("k || '" + SALT + "'")} < CASE WHEN target = 1 THEN {SAMPLE_FRACTIONS[1]} ELSE {SAMPLE_FRACTIONS[0]} END""")
def md5_sample_q(spark, sf):
    """Reproducible stratified sample by md5 bucket of the row key."""
    f = X.scorecard_frame(spark, sf)
    return P.md5_sample(f, "k", SAMPLE_FRACTIONS, label="target", salt=SALT).select("k", "target")


TARGETS = {1: 1000, 0: 5000}
MULT_TRAIN = {1: 2.0, 0: 2.0}


@query("adaptive_fractions", sql=f"""WITH {X.SQL_FRAME},
c AS (SELECT sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS n1, sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) AS n0
      FROM frame WHERE sample = 'train'),
fr AS (SELECT least({MULT_TRAIN[1]} * {TARGETS[1]} / n1, 1.0) AS f1, least({MULT_TRAIN[0]} * {TARGETS[0]} / n0, 1.0) AS f0 FROM c)
SELECT target, count(*) AS n FROM frame, fr
WHERE sample = 'train' AND {X.sql_md5_bucket("k || '" + SALT + "'")} < CASE WHEN target = 1 THEN f1 ELSE f0 END
GROUP BY target""")
def adaptive_fractions_q(spark, sf):
    """P2 + P3: fractions from class counts (read by key), then the sample of the train snapshot."""
    f = X.scorecard_frame(spark, sf).where(F.col("sample") == "train")
    fr = P.adaptive_fractions(P.class_counts(f, "target"), TARGETS, MULT_TRAIN)
    return P.md5_sample(f, "k", fr, label="target", salt=SALT).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query("time_split", sql=f"""WITH {X.SQL_FRAME}
SELECT 'train' AS part, count(*) AS n FROM frame WHERE ship_dt < DATE '{X.OOT_PIVOT}'
UNION ALL SELECT 'oot', count(*) FROM frame WHERE ship_dt >= DATE '{X.OOT_PIVOT}'""")
def time_split_q(spark, sf):
    """Train before the pivot date, out-of-time after."""
    tr, oot = P.time_split(X.scorecard_frame(spark, sf), "ship_dt", X.OOT_PIVOT)
    return (tr.agg(F.count(F.lit(1)).alias("n")).select(F.lit("train").alias("part"), "n")
            .unionByName(oot.agg(F.count(F.lit(1)).alias("n")).select(F.lit("oot").alias("part"), "n")))


N_FOLDS = 6


@query("folds_strat", sql=f"""WITH {X.SQL_FRAME}
SELECT k, target, CAST((row_number() OVER (PARTITION BY target ORDER BY md5(k), k) - 1) % {N_FOLDS} AS INTEGER) AS fold
FROM frame""")
def folds_strat(spark, sf):
    """Stratified k-fold, exactly balanced per class, distributed row numbers."""
    f = X.scorecard_frame(spark, sf).select("k", "target")
    return P.assign_folds(f, N_FOLDS, "k", target="target")


@query("folds_group", sql=f"""WITH {X.SQL_FRAME}
SELECT k, grp, CAST(floor({X.sql_md5_bucket('grp')} * {N_FOLDS}) AS INTEGER) AS fold FROM frame""")
def folds_group(spark, sf):
    """Group k-fold — all rows of a group in one fold."""
    f = X.scorecard_frame(spark, sf).select("k", "grp")
    return P.assign_folds(f, N_FOLDS, "k", group="grp")


@query("folds_strat_null", sql=f"""WITH {X.SQL_FRAME},
t AS (SELECT k, CASE WHEN grp % 7 > 0 THEN target END AS target FROM frame)
SELECT k, target, CAST((row_number() OVER (PARTITION BY target ORDER BY md5(k), k) - 1) % {N_FOLDS} AS INTEGER) AS fold FROM t""")
def folds_strat_null(spark, sf):
    """Stratified folds of a target with missing values, which are a class of their own."""
    f = X.scorecard_frame(spark, sf).select("k", F.when(F.col("grp") % 7 > 0, F.col("target")).alias("target"))
    return P.assign_folds(f, N_FOLDS, "k", target="target")


@query("folds_group_balanced", sql=f"""WITH RECURSIVE {X.SQL_FRAME},
f AS (SELECT k, CASE WHEN l_returnflag <> 'A' THEN l_returnflag || '-' || CAST(l_quantity AS INTEGER) END AS g FROM frame),
s AS (SELECT g, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, g NULLS FIRST) AS i FROM f GROUP BY g),
d AS (SELECT 0::BIGINT AS i, 0 AS fold, [{', '.join(['0::BIGINT'] * N_FOLDS)}] AS loads
      UNION ALL
      SELECT s.i, list_position(loads, list_min(loads)) - 1,
             [CASE WHEN j = list_position(loads, list_min(loads)) THEN loads[j] + s.n ELSE loads[j] END FOR j IN range(1, {N_FOLDS + 1})]
      FROM d JOIN s ON s.i = d.i + 1)
SELECT k, f.g, CAST(d.fold AS INTEGER) AS fold FROM f JOIN s ON f.g IS NOT DISTINCT FROM s.g JOIN d USING (i)""")
def folds_group_balanced(spark, sf):
    """Group folds of equal rows: counted groups, the largest first, go to the lightest fold."""
    g = F.when(F.col("l_returnflag") != "A", F.concat("l_returnflag", F.lit("-"), F.col("l_quantity").cast("int").cast("string")))
    f = X.scorecard_frame(spark, sf).select("k", g.alias("g"))
    return P.assign_folds(f, N_FOLDS, "k", group="g", method="largest_first")


@query("md5_split", sql=f"""WITH {X.SQL_FRAME}
SELECT CASE WHEN {X.sql_md5_bucket('k')} < 0.6 THEN 'train'
            WHEN {X.sql_md5_bucket('k')} < 0.8 THEN 'valid' ELSE 'test' END AS split, count(*) AS n
FROM frame GROUP BY 1""")
def md5_split_q(spark, sf):
    """Random 0.6/0.2/0.2 split by md5 bucket."""
    f = P.md5_split(X.scorecard_frame(spark, sf), "k", [0.6, 0.2, 0.2], labels=["train", "valid", "test"])
    return f.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ streaming

@query("streaming_mart", sql=MART_SQL)
def streaming_mart(spark, sf):
    """G3/U2 as Structured Streaming: file source -> stream-static joins -> partial
    aggregates per micro-batch -> the touched periods of a partitioned mart replaced."""
    import uuid

    from scoria.session import checkpoint_dir
    from scoria.streaming.incremental import read_mart, run_available, stream_rows
    path = f"{sf}/lineitem.parquet"
    # the driver folder holds one file per table: a glob selects that table's
    # file(s) inside the folder the stream watches
    li = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{sf}/lineitem*.parquet")
    (o,) = X.tables(spark, sf, "orders")
    tx = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("client_id"), F.col("l_partkey").alias("merchant"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("amount"),
        F.col("l_returnflag").alias("trans_type"), F.col("l_shipdate").alias("day"))
    codes = X.merchant_codes(spark, sf)
    rows = stream_rows(tx, codes, id_col="client_id", amount="amount", code="merchant", day="day",
                       start=X.MART_START, stop=X.MART_STOP, delta=X.MART_DELTA,
                       type_col="trans_type", types=X.CHOSEN_TYPES)
    root = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    run_available(rows, root, id_col="client_id", categories=X.CATEGORIES)
    cols = ["client_id", "report_dt"] + [f"{c}_{s}_amt" for c in X.CATEGORIES for s in ("sum", "max", "min")]
    return read_mart(spark, root).select(*cols)


# ------------------------------------------------------------------ small variant: events as transactions

# fixed values of the events stand-in: event type -> category; "error" falls to "other"
EVENT_MAP = {"view": "browse", "click": "browse", "purchase": "buy", "signup": "account"}
EVENT_CATS = ["browse", "buy", "account", "other"]
EV_START, EV_STOP, EV_DELTA = _dt.date(2024, 1, 1), _dt.date(2024, 1, 29), 7


def _events_sql_cols() -> str:
    cols = []
    for c in EVENT_CATS:
        for s, agg in (("sum", "sum"), ("max", "max"), ("min", "min")):
            cols.append(f"round(coalesce({agg}(CASE WHEN column_name = '{c}' THEN amt END) / 100.0, 0), 6) AS {c}_{s}_amt")
    return ",\n       ".join(cols)


_EV_LAST = EV_START + _dt.timedelta(days=M.n_periods(EV_START, EV_STOP, EV_DELTA) * EV_DELTA - 1)
_EV_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_MAP.items()) + " ELSE 'other' END"


@query("events_mart", sql=f"""
WITH codes AS (SELECT DISTINCT event_type AS merchant, {_EV_CASE} AS column_name FROM events),
t AS (SELECT e.user_id, CAST(round(e.value * 100) AS BIGINT) AS amt, codes.column_name, CAST(e.ts AS DATE) AS day
      FROM events e JOIN codes ON e.event_type = codes.merchant
      WHERE CAST(e.ts AS DATE) BETWEEN DATE '{EV_START}' AND DATE '{_EV_LAST}')
SELECT user_id, {_period_sql(EV_START, EV_DELTA)} AS report_dt,
       {_events_sql_cols()}
FROM t WHERE user_id IS NOT NULL GROUP BY 1, 2""")
def events_mart(spark, sf):
    """G1-G3 on the small variant (FIXTURES): events as transactions, event type as merchant
    code (string codes), value as amount, weekly periods over complete weeks."""
    (ev,) = X.tables(spark, sf, "events")
    tx = ev.select("user_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("amount"),
                   F.to_date("ts").alias("day"))
    codes = M.map_codes(ev.select("event_type").distinct(), "event_type", "event_type", EVENT_MAP)
    return M.category_mart(tx, codes, id_col="user_id", amount="amount", code="event_type", day="day",
                           start=EV_START, stop=EV_STOP, delta=EV_DELTA, categories=EVENT_CATS,
                           code_type="string")



@query("dataset_single_key", sql=_tx_filtered_sql(D0, D1) + """,
a AS (SELECT client_id, column_name, sum(amt) AS sum_amt, max(amt) AS max_amt, min(amt) AS min_amt
      FROM t GROUP BY client_id, column_name),
m AS (SELECT client_id,
       """ + _pivot_sql_cols() + """
      FROM a GROUP BY client_id),
prof AS (SELECT c.c_custkey AS client_id, n.n_name AS client_city FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
b AS (SELECT DISTINCT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-03-31')
SELECT m.*, prof.client_city, CASE WHEN b.o_custkey IS NULL THEN 0 ELSE 1 END AS target
FROM m JOIN prof ON m.client_id = prof.client_id LEFT JOIN b ON m.client_id = b.o_custkey""")
def dataset_single_key(spark, sf):
    """Scoring base on one key — 1995 pivoted features inner-join the client profile,
    left-join next-quarter buyers, missing target -> 0."""
    o, c, n = X.tables(spark, sf, "orders", "customer", "nation")
    prof = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_custkey").alias("client_id"),
                                                            F.col("n_name").alias("client_city"))
    buyers = (o.where(F.to_date("o_orderdate").between(F.lit("1996-01-01").cast("date"),
                                                       F.lit("1996-03-31").cast("date")))
               .select(F.col("o_custkey").alias("client_id")).distinct().withColumn("target", F.lit(1)))
    feats = M.pivot_features(_agg(spark, sf), ["client_id"], X.CATEGORIES)
    return L.build_dataset(feats, buyers, ["client_id"], profile=prof)


@query("sampleby_sample")
def sampleby_sample(spark, sf):
    """P1 (Spark's seeded Bernoulli sampleBy, as in the reference): class counts of the sample."""
    f = X.scorecard_frame(spark, sf)
    s = P.stratified_sample(f, "target", {1: 0.5, 0: 0.1}, seed=42)
    return s.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query("transfer_partitioned", sql="""SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT'""")
def transfer_partitioned(spark, sf):
    """Copy a table into a folder partitioned by a column, then replace it by a
    source that lacks one partition value: nothing stale may be left; read back after a refresh."""
    import uuid

    from scoria.session import checkpoint_dir
    from scoria.sources.io import read_table, transfer
    (o,) = X.tables(spark, sf, "orders")
    root = f"{checkpoint_dir(spark).rstrip('/')}/transfer-{uuid.uuid4().hex}"
    transfer(spark, o, f"{root}/orders.parquet", partition_by="o_orderpriority")
    read_table(spark, "orders", root).count()
    transfer(spark, o.where("o_orderpriority <> '1-URGENT'"), f"{root}/orders.parquet", partition_by="o_orderpriority")
    back = read_table(spark, "orders", root, refresh=True)
    return back.select(*o.columns)
