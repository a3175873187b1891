"""Scalar column expressions (inventory 2.2).

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_", "md5_bucket", "bin_index", "period_end", "prev_month_end",
    "month_end", "date_parts", "DATE_PART_NAMES", "logistic", "logit", "is_missing",
    "nan_to_null", "try_int", "try_double", "try_date", "strptime_to_java",
    "map_lookup", "sentinel_date", "fmt_num",
    "interval_label", "row_key",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_key(*cols) -> Column:
    """String key ``a-b-c`` used to seed md5 buckets and orderings."""
    return F.concat_ws("-", *[col_(c).cast("string") for c in cols])


def md5_bucket(key) -> Column:
    """Reproducible uniform number in [0, 1) from a key (first 32 bits of md5).

    The same number comes out of any SQL engine with md5 and hex parsing,
    which is what makes samples, folds and shuffles reproducible and
    checkable, unlike a seeded RNG whose draws depend on partitioning.
    """
    h = F.substring(F.md5(col_(key).cast("string")), 1, 8)
    return F.conv(h, 16, 10).cast("double") / F.lit(4294967296.0)


# --- binning -------------------------------------------------------------

def bin_index(x, splits: Sequence[float]) -> Column:
    """Left-open / right-closed bin number: count of thresholds ``s < x``.

    x = -inf -> 0; NaN -> len(splits) (last bin); null stays null.
    Generated as a CASE ladder so it is codegen-friendly.
    """
    x = col_(x)
    splits = [float(s) for s in splits]
    n = len(splits)
    expr = F.when(F.isnan(x), F.lit(n))
    for i, s in enumerate(splits):
        expr = expr.when(x <= F.lit(s), F.lit(i))
    return F.when(x.isNull(), F.lit(None).cast("int")).otherwise(expr.otherwise(F.lit(n))).cast("int")


# --- dates ---------------------------------------------------------------

def period_end(day, start: _dt.date | str, delta: int) -> Column:
    """End date of the ``delta``-day period (counted from ``start``) holding ``day``."""
    start = F.lit(str(start)).cast("date")
    idx = F.floor(F.datediff(col_(day), start) / F.lit(delta))
    return F.date_add(start, ((idx + 1) * delta - 1).cast("int"))


def prev_month_end(day) -> Column:
    """``date_sub(d, dayofmonth(d))``: last day of the previous month."""
    d = col_(day)
    return F.date_sub(d, F.dayofmonth(d))


def month_end(day) -> Column:
    return F.last_day(col_(day))


# fixed values: names of date-part features, ``<column>__F__<part>``; Monday = 0 ... Sunday = 6
DATE_PART_NAMES = ("y", "m", "d", "wd", "h", "min")


def date_parts(day, name: str, parts: Sequence[str] = ("wd", "m", "y", "d")) -> list[Column]:
    """Date columns expanded into real features ``<name>__F__<part>``."""
    d = col_(day)
    fn = {"y": F.year, "m": F.month, "d": F.dayofmonth, "wd": F.weekday,
          "h": F.hour, "min": F.minute}
    out = []
    for p in parts:
        if p not in fn:
            raise ValueError(f"unknown date part {p!r}")
        out.append(fn[p](d).cast("double").alias(f"{name}__F__{p}"))
    return out


def sentinel_date(c, value: str = "2046-01-01") -> Column:
    """Null dates replaced by a far-future sentinel so they can partition."""
    return F.coalesce(col_(c).cast("date"), F.lit(value).cast("date"))


# --- casts and missing values -------------------------------------------

def try_int(c, to: str = "bigint") -> Column:
    """Cast that yields NULL instead of failing under ANSI mode."""
    return F.expr(f"try_cast({c} AS {to})") if isinstance(c, str) else c.try_cast(to)


def try_double(c) -> Column:
    """Numeric coercion: unparsable -> NULL, NaN -> NULL."""
    v = col_(c).try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


_STRPTIME = [("%Y", "yyyy"), ("%m", "MM"), ("%d", "dd"), ("%H", "HH"), ("%M", "mm"),
             ("%S", "ss"), ("%y", "yy"), ("%b", "MMM"), ("%B", "MMMM"), ("%j", "DDD"),
             ("%f", "SSSSSS")]


def strptime_to_java(fmt: str) -> str:
    for a, b in _STRPTIME:
        fmt = fmt.replace(a, b)
    return fmt


def try_date(c, fmt: str | None = None) -> Column:
    """Date parse with an optional (strptime or Java) format; bad -> NULL."""
    c = col_(c)
    if fmt is None:
        return F.coalesce(c.try_cast("timestamp"), c.cast("string").try_cast("date").cast("timestamp"))
    if "%" in fmt:
        fmt = strptime_to_java(fmt)
    return F.try_to_timestamp(c.cast("string"), F.lit(fmt))


def is_missing(c) -> Column:
    """One notion of missing: NULL, NaN, or the string 'nan'."""
    c = col_(c)
    return c.isNull() | (F.lower(c.cast("string")) == F.lit("nan"))


def nan_to_null(c) -> Column:
    c = col_(c)
    return F.when(is_missing(c), F.lit(None)).otherwise(c)


def map_lookup(c, mapping: Mapping, default=None) -> Column:
    """Literal map indexed by a column; absent key -> ``default``."""
    m = F.create_map(*[F.lit(x) for x in chain(*mapping.items())])
    v = F.try_element_at(m, col_(c))
    return v if default is None else F.coalesce(v, F.lit(default))


# --- scores --------------------------------------------------------------

def logistic(linear: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-linear))


def logit(p) -> Column:
    p = col_(p)
    return F.log(p / (F.lit(1.0) - p))


def fmt_num(x: float) -> str:
    if math.isinf(x):
        return "inf" if x > 0 else "-inf"
    return f"{x:.2f}"


def interval_label(lo: float | None, hi: float | None, name: str = "f") -> str:
    """Bin label used in scorecards: ``a < name <= b``, ``name > b``, ``name <= b``."""
    if lo is None and hi is None:
        return f"-inf < {name} < +inf"
    if lo is None:
        return f"{name} <= {fmt_num(hi)}"
    if hi is None:
        return f"{name} > {fmt_num(lo)}"
    return f"{fmt_num(lo)} < {name} <= {fmt_num(hi)}"
