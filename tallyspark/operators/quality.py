"""Completeness, freshness and data-age checks (Q1-Q4, Q6, Q11, Q12; U1, A8, A9, J8, J9).

The source system checked one date at a time with one query per table.  These
take many tables and a date range and return one row per (table, date) from a
single job, so a year of history is one scan per table.  Every per-table scan
is reduced to distinct dates (or one aggregate row) before anything is joined,
so the joins only ever see (tables x days) rows.  The (date, table) grid is
built with generators (``explode(sequence)`` x ``explode(array)``), not joins.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.dates import age_days, as_date, date_spine, iso_text, parse_iso_only
from tallyspark.functions.numbers import safe_bigint
from tallyspark.functions.text import non_blank
from tallyspark.session import materialized

DateParser = Callable[[str], Column]


def present_dates(tables: Mapping[str, tuple[DataFrame, str, DateParser]], lo=None, hi=None) -> DataFrame:
    """U1 + A8: distinct (tbl, d) over all tables, optionally inside [lo, hi]."""
    def keep(x):
        c = x.isNotNull()
        if lo is not None:
            c = c & (x >= as_date(lo))
        if hi is not None:
            c = c & (x <= as_date(hi))
        return c

    out = None
    for name, (df, col, parse) in tables.items():
        # parse once and filter inside the generator (a pushed-down filter would re-parse)
        part = df.select(F.lit(name).alias("tbl"),
                         F.explode(F.filter(F.array(parse(col)), keep)).alias("d")).distinct()
        out = part if out is None else out.unionByName(part)
    return out


def missing_dates(spark: SparkSession, tables: Mapping[str, tuple[DataFrame | None, str, DateParser]],
                  as_of, days_back: int = 7, null_semantics: str = "anti") -> DataFrame:
    """Dates of the last ``days_back`` days without rows, per table.

    Returns (tbl, missing_date, state) with state ``missing`` (one row per
    date), ``none`` (nothing missing) or ``no_table``.  ``null_semantics="not_in"``
    reproduces the source query exactly: ISO-only parsing and ``NOT IN``, so a
    single unparseable value makes the table report nothing missing.
    """
    spine = date_spine(spark, as_of, days_back, "missing_date")
    parts = []
    for name, (df, col, parse) in tables.items():
        if df is None:
            parts.append(spark.range(1).select(F.lit(name).alias("tbl"),
                                               F.lit(None).cast("string").alias("missing_date"),
                                               F.lit("no_table").alias("state")))
            continue
        if null_semantics == "not_in":
            present = df.where(non_blank(col)).select(parse_iso_only(col).alias("pd")).distinct()
            v_spine, v_present = f"_spine_{id(spine)}", f"_present_{id(present)}"
            spine.createOrReplaceTempView(v_spine)
            present.createOrReplaceTempView(v_present)
            miss = spark.sql(f"SELECT missing_date FROM {v_spine} "
                             f"WHERE missing_date NOT IN (SELECT pd FROM {v_present})")
        else:
            lo = F.date_sub(as_date(as_of), days_back)
            present = df.select(F.explode(F.filter(F.array(parse(col)),
                                                   lambda x: x.isNotNull() & (x >= lo))).alias("pd")).distinct()
            miss = spine.join(present, spine.missing_date == present.pd, "left_anti")
        m = miss.select(F.lit(name).alias("tbl"), iso_text("missing_date").alias("missing_date"),
                        F.lit("missing").alias("state"))
        none = (m.groupBy().count().where(F.col("count") == 0)
                .select(F.lit(name).alias("tbl"), F.lit(None).cast("string").alias("missing_date"),
                        F.lit("none").alias("state")))
        parts.append(m.unionByName(none))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("tbl", "missing_date")     # O6: a handful of rows


def checked_missing_dates(spark: SparkSession, tables: Mapping[str, tuple[Callable[[], DataFrame | None], str, DateParser]],
                          as_of, days_back: int = 7, attempts: int = 1) -> DataFrame:
    """Q1 with errors as rows: (tbl, missing_date, state, message), state also ``error``.

    A table is given by a function that opens it (None: there is none).  Each table's days of the window (at
    most ``days_back``) are written aside on their own, so whatever goes wrong there -- a broken file, a missing
    column, text that a strict parser refuses -- is that table's row, and the others' plans hold only what is
    known to read.
    """
    days, bad = {}, []
    lo = F.date_sub(as_date(as_of), days_back)
    for name, (open_table, col, parse) in tables.items():
        for left in reversed(range(attempts)):
            try:
                df = open_table()
                days[name] = None if df is None else (materialized(df.select(
                    F.explode(F.filter(F.array(parse(col)), lambda x: x.isNotNull() & (x >= lo))).alias("pd")).distinct()), "pd", F.col)
                break
            except Exception as e:  # noqa: BLE001 -- reported as the table's row
                if not left:
                    condition = re.search(r"\[([A-Z][A-Z0-9_]+)", str(e))      # Spark names its errors so
                    bad.append((name, None, "error", condition.group(1) if condition else type(e).__name__))
    good = missing_dates(spark, {n: v or (None, "pd", F.col) for n, v in days.items()}, as_of, days_back) if days else None
    out = spark.createDataFrame(bad, "tbl string, missing_date string, state string, message string")
    return out if good is None else good.withColumn("message", F.lit(None).cast("string")).unionByName(out)


def completeness(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, str, DateParser]],
                 date_from, date_to, required: Sequence[str] | None = None) -> DataFrame:
    """(d, tbl, present) for every day in [date_from, date_to] x required table."""
    required = list(required or tables.keys())
    present = present_dates({k: v for k, v in tables.items() if k in required}, date_from, date_to)
    grid = (spark.range(1)
            .select(F.explode(F.sequence(as_date(date_from), as_date(date_to))).alias("d"))
            .select("d", F.explode(F.array(*[F.lit(t) for t in required])).alias("tbl")))
    p = present.withColumn("present", F.lit(True))
    j = grid.join(p, ["d", "tbl"], "left")
    return j.select(iso_text("d").alias("d"), "tbl",
                    F.coalesce("present", F.lit(False)).alias("present"))


def completeness_verdict(status: DataFrame) -> DataFrame:
    """Q11: per day, complete or the sorted list of missing tables."""
    missing = F.when(~F.col("present"), F.col("tbl"))
    return (status.groupBy("d")
            .agg(F.count(missing).cast("bigint").alias("n_missing"),
                 F.array_join(F.array_sort(F.collect_set(missing)), ",").alias("missing_list"))
            .withColumn("complete", F.col("n_missing") == 0))


def day_verdict(status: DataFrame, fresh: DataFrame, age: DataFrame, date_from, date_to) -> DataFrame:
    """Q11 over Q2-Q4: per day the labels of everything wrong, and whether the day is complete.

    ``status`` (d, tbl, present), ``fresh`` and ``age`` as ``freshness`` and ``data_age`` give them.  Labels:
    ``tbl`` (no rows that day), ``tbl(stale 40.1h)``, ``tbl(data_stale 3d, newest=2024-01-28)`` and, unless
    the table is listed already, ``tbl(no_data)`` or ``tbl(data_check_failed)``.  The last two frames have one
    row per table and hold for every day, so they are spread over the days by a generator, not a join.
    """
    days = F.explode(F.transform(F.sequence(as_date(date_from), as_date(date_to)), iso_text)).alias("d")
    t = F.col("tbl")
    gone = status.where(~F.col("present")).select("d", "tbl", t.alias("label"), F.lit(False).alias("soft"))
    stale = fresh.where("state = 'stale'").select(days, "tbl", F.concat(
        t, F.lit("(stale "), F.format_string("%.1f", F.col("age_minutes") / 60), F.lit("h)")).alias("label"), F.lit(False).alias("soft"))
    hard = F.col("state") == "data_stale"
    old = age.where("state <> 'ok'").select(days, "tbl", F.when(hard, F.concat(
        t, F.lit("(data_stale "), F.col("age_days").cast("string"), F.lit("d, newest="), "newest", F.lit(")")))
        .otherwise(F.concat(t, F.lit("("), "state", F.lit(")"))).alias("label"), (~hard).alias("soft"))
    wrong = gone.unionByName(stale).unionByName(old)
    every = status.select("d").distinct().select("d", F.lit(None).cast("string").alias("tbl"), F.lit(None).cast("string").alias("label"), F.lit(False).alias("soft"))
    got = wrong.unionByName(every).groupBy("d").agg(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("tbl", "label", "soft"))).alias("w"))
    listed = F.filter("w", lambda x: ~x["soft"] | ~F.exists("w", lambda y: (y["tbl"] == x["tbl"]) & ~y["soft"]))
    labels = F.array_sort(F.transform(listed, lambda x: x["label"]))
    return got.select("d", F.array_join(labels, ",").alias("labels"), F.size(labels).cast("bigint").alias("n_wrong"), (F.size(labels) == 0).alias("complete"))


def data_age(tables: Mapping[str, tuple[DataFrame, str]], as_of, max_days: int = 2) -> DataFrame:
    """Newest business date per table and its age in days.

    The newest date is the greatest first-10-characters that look like a
    date (zero-padded dates sort like time); state is ``data_stale`` when
    ``age >= max_days``, ``no_data`` for an empty table and
    ``data_check_failed`` when no value is a date or the newest is not a real one.
    """
    out = None
    for name, (df, col) in tables.items():
        head = F.substring(F.col(col).cast("string"), 1, 10)
        agg = df.agg(F.max(F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head)).alias("newest"), F.count(F.lit(1)).alias("n"))
        nd = F.try_to_date("newest", "yyyy-MM-dd")
        age = age_days(nd, as_of)
        row = agg.select(
            F.lit(name).alias("tbl"), "newest", age.cast("bigint").alias("age_days"),
            F.when(F.col("n") == 0, "no_data").when(nd.isNull(), "data_check_failed")
             .when(age >= max_days, "data_stale").otherwise("ok").alias("state"))
        out = row if out is None else out.unionByName(row)
    return out


def freshness(listing: DataFrame, now, max_hours: float = 36, *, tbl: str = "tbl",
              modified: str = "modified") -> DataFrame:
    """Last modification per table, its age in whole minutes, ``stale`` past ``max_hours``."""
    mtype = listing.schema[modified].dataType
    now_c = F.lit(now).cast(mtype) if isinstance(now, str) else now.cast(mtype)
    g = listing.groupBy(tbl).agg(F.max(modified).alias("modified"))
    age_us = F.timestamp_diff("MICROSECOND", F.col("modified"), now_c)
    return g.select(F.col(tbl).alias("tbl"), F.date_format("modified", "yyyy-MM-dd HH:mm:ss").alias("modified"),
                    F.timestamp_diff("MINUTE", F.col("modified"), now_c).cast("bigint").alias("age_minutes"),
                    F.when(age_us > F.lit(int(max_hours * 3600 * 1_000_000)), "stale").otherwise("fresh").alias("state"))


def table_modified(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """Listing (tbl, modified) from file metadata; no data column is read."""
    out = None
    for name, path in paths.items():
        df = (spark.read.format(fmt).load(path)
              .select(F.lit(name).alias("tbl"), F.col("_metadata.file_modification_time").alias("modified")))
        g = df.groupBy("tbl").agg(F.max("modified").alias("modified"))
        out = g if out is None else out.unionByName(g)
    return out


def daily_totals_latest(files: DataFrame, *, path: str = "path", n_cols: str = "n_cols",
                        clicks: str = "clicks_text", cost: str = "cost_text", expected_cols: int = 42) -> DataFrame:
    """S7 + S11: per target date, clicks and cost of the newest valid daily-total report.

    Valid = the header has ``expected_cols`` fields and both cells are integers
    (empty counts as 0).  The generation is read from the file name
    ``…_<target yyyymmdd>_<yyyymmdd>_<hhmm>.csv``; ties go to the greater path.
    """
    base = F.regexp_extract(F.col(path), r"[^/]*$", 0)
    pat = r"_(\d{8})_(\d{8})_(\d{4})\.csv$"
    c = safe_bigint(F.coalesce(F.nullif(F.col(clicks), F.lit("")), F.lit("0")))
    k = safe_bigint(F.coalesce(F.nullif(F.col(cost), F.lit("")), F.lit("0")))
    v = (files.where(base.rlike(pat) & (F.col(n_cols) == expected_cols))
         .select(F.regexp_extract(base, pat, 1).alias("ymd"),
                 F.concat(F.regexp_extract(base, pat, 2), F.regexp_extract(base, pat, 3)).alias("stamp"),
                 F.col(path).alias("path"), c.alias("clicks"), k.alias("cost"))
         .where(F.col("clicks").isNotNull() & F.col("cost").isNotNull()))
    return (v.groupBy("ymd")
            .agg(F.max_by(F.struct("clicks", "cost", "stamp", "path"), F.struct("stamp", "path")).alias("b"))
            .select(F.to_date("ymd", "yyyyMMdd").alias("d"), "b.clicks", "b.cost", "b.stamp", "b.path"))


def zero_delivery(totals: DataFrame, dates: DataFrame, date_col: str = "d") -> DataFrame:
    """Q6: per date, is it certain that nothing was delivered (clicks = 0 and cost = 0)?

    A date without a usable report is unknown, which counts as "not zero".
    """
    j = dates.join(totals.withColumnRenamed("d", "_td"), dates[date_col] == F.col("_td"), "left")
    return j.select(iso_text(date_col).alias("d"), "clicks", "cost",
                    F.coalesce((F.col("clicks") == 0) & (F.col("cost") == 0), F.lit(False)).alias("is_zero"),
                    F.col("clicks").isNotNull().alias("known"))


def maturation_uplift(frozen: DataFrame, matured: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Q12: frozen vs matured totals per key, difference and the share the frozen value lacks."""
    f = frozen.groupBy(*keys).agg(F.sum(measure).alias("frozen"))
    m = matured.groupBy(*keys).agg(F.sum(measure).alias("matured"))
    j = f.join(m, list(keys), "full")
    fz, mt = F.coalesce("frozen", F.lit(0)), F.coalesce("matured", F.lit(0))
    diff = (mt - fz).cast("double")
    return j.select(*keys, fz.cast("bigint").alias("frozen"), mt.cast("bigint").alias("matured"),
                    (mt - fz).cast("bigint").alias("diff"),
                    (F.try_divide(diff, fz.cast("double")) * 100).alias("uplift_pct"),
                    (F.try_divide(diff, mt.cast("double")) * 100).alias("short_pct"))
