"""Date handling for report text: four spellings, mixed-format parsing, spines.

All functions return Column expressions (JVM-side, codegen'd); nothing here
runs Python per row.

Semantics kept from the source system:
* ``normalize_date`` builds a *string* from regex groups and never checks the
  calendar (``2026年13月45日`` -> ``2026-13-45``).  ``strict_date`` is the typed,
  calendar-checked companion.
* ``\\d`` matches any Unicode digit (Python semantics), hence the ``(?U)`` flag.
* A range ``A～B`` yields its first (start) date: the search is unanchored and
  the first match wins.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The four report date spellings and their patterns.
#   rpp_range   -> 2026年07月13日 (2-digit month/day, unanchored search)
#   jp_range    -> 2026年7月3日   (1-2 digit month/day, zero-padded)
#   datetime_jp -> 2026/7/3 9:05 (1-2 digit month/day, zero-padded)
#   simple      -> 2026-07-13    (whole string)
PATTERNS = {
    "rpp_range": r"(?U)(\d{4})年(\d{2})月(\d{2})日",
    "jp_range": r"(?U)(\d{4})年(\d{1,2})月(\d{1,2})日",
    "datetime_jp": r"(?U)(\d{4})/(\d{1,2})/(\d{1,2})",
    "simple": r"(?U)^(\d{4})-(\d{2})-(\d{2})$",
}

# Fallback chains used by the different callers.
EXISTING_VALUES_ORDER = ("rpp_range", "datetime_jp", "simple")
EXPANSION_ORDER = ("jp_range", "rpp_range", "datetime_jp", "simple")
REFRESH_ORDER = ("rpp_range", "simple")


def new_rows_order(configured: str) -> tuple[str, ...]:
    """New rows try the family's configured spelling, then datetime_jp, then simple."""
    return (configured, "datetime_jp", "simple")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """NULL or only whitespace (Unicode-aware, like Python's ``str.strip``)."""
    c = _col(c)
    return c.isNull() | (F.regexp_replace(c.cast("string"), r"(?U)\s+", "") == F.lit(""))


def _normalize_one(s: Column, fmt: str) -> Column:
    """One spelling with one regex pass: the whole match, then fixed positions or a split.

    Every spelling needs digits, so blank text never matches (no separate
    blank check is needed).
    """
    m = F.regexp_extract(s, PATTERNS[fmt], 0)
    if fmt == "simple":     # the whole text is returned (``$`` also matches before a final line break)
        return F.when(m != "", s)
    if fmt == "rpp_range":   # fixed width: YYYY年MM月DD日
        return F.when(m != "", F.concat_ws("-", F.substring(m, 1, 4), F.substring(m, 6, 2), F.substring(m, 9, 2)))
    parts = F.split(m, "[年月日/]")
    return F.when(m != "", F.concat_ws("-", parts.getItem(0), F.lpad(parts.getItem(1), 2, "0"),
                                       F.lpad(parts.getItem(2), 2, "0")))


def normalize_date_chain(c, order: Sequence[str]) -> Column:
    """First spelling in ``order`` that matches wins (``a or b or c``); no match -> NULL.

    The text is bound once to a lambda variable (``transform`` over a
    one-element array): the chain refers to it several times, and without the
    binding the optimizer would inline whatever expression produced the text
    at every reference (and again into any filter pushed below it).
    """
    for f in order:
        if f not in PATTERNS:
            raise ValueError(f"unknown date format {f!r}")

    def body(s: Column) -> Column:
        return F.coalesce(*[_normalize_one(s, f) for f in order])

    return F.element_at(F.transform(F.array(_col(c).cast("string")), body), 1)


def normalize_date(c, fmt: str) -> Column:
    """One spelling -> ``YYYY-MM-DD`` string, NULL when it does not match or is blank."""
    return normalize_date_chain(c, (fmt,))


def strict_date(text) -> Column:
    """Calendar-checked DATE from a normalized ``YYYY-MM-DD`` string (NULL if impossible)."""
    return F.try_to_date(_col(text), "yyyy-MM-dd")


def parse_mixed_date(c) -> Column:
    """Warehouse-side parse of a column holding both spellings.

    Anchored 2-digit jp form first, then the first 10 characters as ISO.
    """
    s = _col(c).cast("string")
    jp = F.regexp_extract(s, r"^(\d{4}年\d{2}月\d{2}日)", 1)
    return F.coalesce(
        F.try_to_date(F.nullif(jp, F.lit("")), "yyyy年MM月dd日"),
        F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd"),
    )


def parse_mixed_date_iso_first(c) -> Column:
    """Baseline-side variant: ISO prefix first, then an unanchored jp match."""
    s = _col(c).cast("string")
    jp = F.regexp_extract(s, r"(\d{4}年\d{2}月\d{2}日)", 1)
    return F.coalesce(
        F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd"),
        F.try_to_date(F.nullif(jp, F.lit("")), "yyyy年MM月dd日"),
    )


def parse_iso_only(c) -> Column:
    """``SAFE.PARSE_DATE('%Y-%m-%d', x)`` on the whole text."""
    return F.try_to_date(_col(c).cast("string"), "yyyy-MM-dd")


def parse_iso_or_slash(c) -> Column:
    """ISO or ``yyyy/MM/dd`` (page-analysis date column)."""
    s = _col(c).cast("string")
    return F.coalesce(F.try_to_date(s, "yyyy-MM-dd"), F.try_to_date(s, "yyyy/MM/dd"))


def iso_text(d) -> Column:
    """DATE -> ``YYYY-MM-DD`` text (``FORMAT_DATE('%Y-%m-%d')``)."""
    return F.date_format(_col(d), "yyyy-MM-dd")


def jp_range_text(d) -> Column:
    """DATE -> ``YYYY年MM月DD日～YYYY年MM月DD日`` (a one-day report range)."""
    one = F.date_format(_col(d), "yyyy'年'MM'月'dd'日'")
    return F.concat(one, F.lit("～"), one)


def as_date(value) -> Column:
    """Literal date parameter (``as_of``/``target``) as a DATE column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.strftime("%Y-%m-%d")
    return F.to_date(F.lit(str(value)))


def date_spine(spark: SparkSession, as_of, days_back: int, col: str = "d") -> DataFrame:
    """``as_of - 1 … as_of - days_back`` (``GENERATE_ARRAY(1, N)`` + ``UNNEST``)."""
    a = as_date(as_of)
    return spark.range(1).select(
        F.explode(F.sequence(F.date_sub(a, days_back), F.date_sub(a, 1))).alias(col))


def trailing_window(spark: SparkSession, as_of, days: int, col: str = "d") -> DataFrame:
    """Refresh window: yesterday … ``days`` days ago (``days`` dates)."""
    return date_spine(spark, as_of, days, col)


def explicit_dates(spark: SparkSession, raw: str, col: str = "d") -> DataFrame:
    """Comma/space separated dates; ``-`` and ``/`` removed; 8 digits required.

    Returns (token, d) where ``d`` is NULL for a token that is not 8 digits (the
    caller reports those as ignored).
    """
    tok = F.explode(F.split(F.trim(F.lit(raw or "")), r"[,\s]+")).alias("token")
    df = spark.range(1).select(tok).where(F.col("token") != "")
    digits = F.regexp_replace(F.regexp_replace("token", "-", ""), "/", "")
    return df.select("token", F.when(digits.rlike(r"^\d{8}$"),
                                     F.try_to_date(digits, "yyyyMMdd")).alias(col))


def target_month(d) -> Column:
    """Report month for a date: day 1 belongs to the previous month."""
    d = _col(d)
    return F.date_format(F.when(F.dayofmonth(d) == 1, F.date_sub(d, 1)).otherwise(d), "yyyy-MM")


def age_days(newest, as_of) -> Column:
    return F.datediff(as_date(as_of), _col(newest))


def age_hours(modified_ts, now_ts) -> Column:
    """Elapsed hours between two timestamps, as a double."""
    return (F.unix_micros(_col(now_ts).cast("timestamp")) -
            F.unix_micros(_col(modified_ts).cast("timestamp"))) / F.lit(3.6e9)
