"""Duplicate-safe incremental loads.

The source system pulled the set of already-loaded dates/keys to the client
and filtered row by row.  Here a whole backfill is one job instead of one load
per file.

Plan notes: rules by day (loaded days, the first file of a day) look the day up
in the stage that reads the rows (``daytable``), so rows are not exchanged by
date and a day that holds a third of all rows is no hot group.  Rules by key are
one anti join against the target's distinct keys (partial aggregation first),
and no broadcast is forced -- AQE turns the join into a broadcast when the
distinct set is small at run time and keeps a sort-merge join otherwise.
Winners per date/key are computed with a ``min`` aggregate (collapses map-side),
never with a window over all rows of a date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.dates import EXISTING_VALUES_ORDER, iso_text, new_rows_order, normalize_date_chain
from tallyspark.functions.text import ustrip
from tallyspark.operators.daytable import day_table

NORM = "__norm__"
PDATE = "pdate"


def non_null(c: Column) -> Column:
    """Generator that yields ``c`` once, or nothing when it is NULL.

    A ``where(c IS NOT NULL)`` on a computed column is pushed below the
    projection and evaluates the (regex-heavy) expression a second time; a
    generator evaluates it once and drops the row in the same step.
    """
    return F.explode(F.filter(F.array(c), lambda x: x.isNotNull()))


def existing_dates(target: DataFrame, date_col: str,
                   order: Sequence[str] = EXISTING_VALUES_ORDER) -> DataFrame:
    """Distinct normalized dates already in the target (column ``__norm__``).

    A table partitioned by the parsed date gives them from its partition values; only rows without one
    (the NULL partition) are parsed again.
    """
    if PDATE in target.columns:
        known = target.where(F.col(PDATE).isNotNull()).select(iso_text(PDATE).alias(NORM)).distinct()
        return known.unionByName(existing_dates(target.where(F.col(PDATE).isNull()).drop(PDATE), date_col, order)).distinct()
    return target.select(non_null(normalize_date_chain(date_col, order)).alias(NORM)).distinct()


def normalize_rows(rows: DataFrame, date_col: str, order: Sequence[str]) -> DataFrame:
    """P5 + P6: normalize the date, drop rows whose date does not parse, write ISO back."""
    n = rows.select("*", non_null(normalize_date_chain(date_col, order)).alias(NORM))
    return n.withColumn(date_col, F.col(NORM))


def _not_loaded(n: DataFrame, target: DataFrame | None, date_col: str) -> DataFrame:
    """Normalized rows whose day the target has not, tested in the stage that reads them (a join beyond the table's bounds)."""
    if target is None:
        return n
    loaded = existing_dates(target, date_col)
    table = day_table(loaded, NORM)
    return n.join(loaded, NORM, "left_anti") if table is None else table.rows(n, NORM, lambda v: v.isNull())


def dedup_by_date(rows: DataFrame, target: DataFrame | None, date_col: str, fmt: str = "rpp_range",
                  order: Sequence[str] | None = None) -> DataFrame:
    """Keep new rows whose normalized date is not in the target yet.

    In-file duplicates survive (the source system never de-duplicated inside
    a file).
    """
    return _not_loaded(normalize_rows(rows, date_col, order or new_rows_order(fmt)), target, date_col).drop(NORM)


def day_winners(n: DataFrame, file_rank: str) -> DataFrame:
    """The lowest file rank of each normalized day (``__win__``)."""
    return n.groupBy(NORM).agg(F.min(file_rank).alias("__win__"))


def first_writer_wins(rows: DataFrame, target: DataFrame | None, date_col: str, file_rank: str,
                      fmt: str = "rpp_range", order: Sequence[str] | None = None) -> DataFrame:
    """J10 + J1: across many files, a date goes to the lowest-ranked file that has it.

    ``file_rank`` orders files by (modification time, path).  Dates already in
    the target are taken by nobody.
    """
    n = _not_loaded(normalize_rows(rows, date_col, order or new_rows_order(fmt)), target, date_col)
    winners = day_winners(n, file_rank)
    table = day_table(winners, NORM, "__win__")
    if table is not None:
        return table.rows(n, NORM, lambda v: v == F.col(file_rank)).drop(NORM)
    kept = n.join(winners, (n[NORM] == winners[NORM]) & (n[file_rank] == winners["__win__"]), "left_semi")
    return kept.drop(NORM)


def dedup_by_key(rows: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """New rows whose trimmed key is not in the target (target keys are not trimmed)."""
    n = rows.withColumn(key, ustrip(key))
    if target is None:
        return n
    existing = target.select(F.col(key).cast("string").alias("__k__")).distinct()
    return n.join(existing, n[key] == existing["__k__"], "left_anti")


def dedup_by_composite(rows: DataFrame, target: DataFrame | None, date_col: str, item_col: str,
                       order: Sequence[str] = ("jp_range", "rpp_range", "datetime_jp", "simple"),
                       file_rank: str | None = None) -> DataFrame:
    """(normalized date, trimmed item) not in the target.

    Files were processed one by one and each re-read the target, so a later
    file also loses keys an earlier file brought; with ``file_rank`` that is
    "first file wins" per key.
    """
    n = normalize_rows(rows, date_col, order).drop(NORM).withColumn(item_col, ustrip(item_col))
    if target is not None:
        t = target.select(F.col(date_col).alias("__d__"), F.col(item_col).alias("__i__")).distinct()
        # the normalized date is built from regex groups: it has no blanks to strip
        n = n.join(t, (n[date_col] == t["__d__"]) & (n[item_col] == t["__i__"]), "left_anti")
    if file_rank is not None:
        w = n.groupBy(date_col, item_col).agg(F.min(file_rank).alias("__win__"))
        n = n.join(w, (n[date_col] == w[date_col]) & (n[item_col] == w[item_col])
                   & (n[file_rank] == w["__win__"]), "left_semi")
    return n
