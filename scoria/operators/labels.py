"""Event labels and labelled datasets.

Labels are joined to feature snapshots on ``(id, date key)``.  Every join
here is an equi-join Catalyst plans as broadcast or sort-merge; the label
side is de-duplicated on the join key by default so the left join cannot
fan out (the reference's fan-out is reproducible with ``dedup=False``).
"""

from __future__ import annotations

import datetime as _dt
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoria.functions.exprs import prev_month_end
from scoria.sources.io import in_list

__all__ = ["label_events", "build_dataset", "attach_profile", "scores_vs_sales", "drop_cols"]


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """drop bookkeeping columns; missing names are ignored."""
    return df.drop(*[c for c in cols if c in df.columns])


def label_events(sales: DataFrame, *, id_col: str, date_col: str, key: str = "report_dt",
                 shift_days: int | None = None, month_end: bool = False,
                 first_only: bool = False, first: _dt.date | None = None,
                 last: _dt.date | None = None, partner_col: str | None = None,
                 partner: str | None = None, dedup: bool = True, target: str = "target") -> DataFrame:
    """Turn purchase events into ``(id, key, target=1)`` labels.

    * ``partner`` keeps one partner's sales;
    * ``first_only`` keeps each client's first purchase (G4) — the
      ``first <= d < last`` window is applied *after* that aggregate;
    * without ``first_only`` the window filters events directly (F2);
    * ``shift_days=k`` keys the label ``k`` days before the event (F14;
      negative = after the event, which leaks the future: warned);
    * ``month_end`` keys it to the previous month end (F15).
    """
    s = sales
    if partner_col is not None and partner is not None:
        s = s.where(F.col(partner_col) == F.lit(partner))
    s = s.select(F.col(id_col).alias(id_col), F.to_date(F.col(date_col)).alias("_d"))
    if first_only:
        s = s.groupBy(id_col).agg(F.min("_d").alias("_d"))
    if first is not None:
        s = s.where(F.col("_d") >= F.lit(first))
    if last is not None:
        s = s.where(F.col("_d") < F.lit(last))
    if month_end:
        k = prev_month_end("_d")
    elif shift_days is not None:
        if shift_days < 0:
            warnings.warn("negative shift_days keys labels after the event (future leakage)")
        k = F.date_sub("_d", shift_days)
    else:
        k = F.col("_d")
    out = s.select(id_col, k.alias(key)).where(F.col(id_col).isNotNull())
    if dedup:
        out = out.dropDuplicates([id_col, key])
    return out.withColumn(target, F.lit(1))


def attach_profile(features: DataFrame, profile: DataFrame, keys: Sequence[str],
                   how: str = "inner", drop: Sequence[str] = ("report_dt", "ctl_loading")) -> DataFrame:
    """Join a client profile snapshot on keys after dropping bookkeeping columns."""
    p = drop_cols(profile, [c for c in drop if c not in keys])
    f = drop_cols(features, [c for c in drop if c not in keys])
    return f.join(p, list(keys), how)


def build_dataset(features: DataFrame, labels: DataFrame, keys: Sequence[str], *,
                  profile: DataFrame | None = None, cities=None, city_col: str = "client_city",
                  target: str = "target", drop: Sequence[str] = ("ctl_loading",)) -> DataFrame:
    """Features [inner profile] left-join labels, missing target -> 0.

    ``cities`` (list or one-column table, or None for no filter) keeps
    clients of those cities (F4/S11).
    """
    keys = list(keys)
    f = drop_cols(features, drop)
    if profile is not None:
        p = profile
        if cities is not None:
            p = in_list(p, city_col, cities)
        f = attach_profile(f, p, keys)
    elif cities is not None:
        f = in_list(f, city_col, cities)
    lab = labels.select(*keys, target)
    return f.join(lab, keys, "left").fillna({target: 0})


def scores_vs_sales(scores: DataFrame, buyers: DataFrame, id_col: str, target: str = "target") -> DataFrame:
    """Scores left-join buyers (one row per buyer), non-buyers -> 0."""
    b = buyers.select(id_col).distinct().withColumn(target, F.lit(1))
    return scores.join(b, id_col, "left").fillna({target: 0})
