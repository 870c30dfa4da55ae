"""Ingest and refresh jobs (I1-I6), composed from sources and operators.

Each job plans the whole batch of files as one DataFrame: the file listing is
ranked by (mtime, path), rows carry their file rank, and the de-duplication
rules decide per date/key in one aggregate + join.  Per-family failures become
status rows (I6) instead of stopping the other families.

Families (fixed values: file patterns, date column and spelling, dedup rule):
  raw_shohin_betsu  rpp_reports/RPP商品別*.csv            日付   rpp_range  by date
  raw_keyword       rpp_reports/RPPキーワード別*.csv      日付   rpp_range  by date (+ spike guard)
  raw_item          rms_reports/店舗カルテ_商品ページ分析*.csv 対象日 simple by date
  raw_affi          rms_reports/pending*.csv              -      -          by key 受注番号 (newest file only)
  raw_rppexp        rppexp_reports/RPPEXP商品別_*.csv     日付   (4 spellings) by (日付, 商品管理番号)
  raw_rpp_daily     rpp_reports/RPP日次12h_*.csv          日付   rpp_range  by date
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.dates import REFRESH_ORDER, explicit_dates, trailing_window
from tallyspark.operators import dedup as DD
from tallyspark.operators import guard as G
from tallyspark.operators import upsert as U
from tallyspark.sources import csv_reports as C
from tallyspark.sources import files as FL
from tallyspark.sources import snapshots as S
from tallyspark.sources.catalog import table_columns
from tallyspark.sources.sinks import PDATE, append_raw, prepare_for_target


log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Family:
    table: str
    pattern: str
    date_col: str | None
    date_format: str | None
    dedup: str                     # date | key | composite
    key_col: str | None = None
    item_col: str | None = None
    encoding: str = "UTF-8"


FAMILIES = {
    "raw_shohin_betsu": Family("raw_shohin_betsu", "rpp_reports/RPP商品別*.csv", "日付", "rpp_range", "date"),
    "raw_keyword": Family("raw_keyword", "rpp_reports/RPPキーワード別*.csv", "日付", "rpp_range", "date"),
    "raw_item": Family("raw_item", "rms_reports/店舗カルテ_商品ページ分析*.csv", "対象日", "simple", "date"),
    "raw_affi": Family("raw_affi", "rms_reports/pending*.csv", None, None, "key", key_col="受注番号"),
    "raw_rppexp": Family("raw_rppexp", "rppexp_reports/RPPEXP商品別_*.csv", "日付", None, "composite",
                         item_col="商品管理番号"),
    "raw_rpp_daily": Family("raw_rpp_daily", "rpp_reports/RPP日次12h_*.csv", "日付", "rpp_range", "date"),
}


STATUS = "family string, path string, state string, message string"


def _ranked_files(spark: SparkSession, root: str, fam: Family, day=None, tz: str = FL.REPORT_TZ) -> DataFrame:
    listing = FL.list_files(spark, f"{root}/{fam.pattern}")
    if day is not None:
        listing = FL.modified_on(listing, day, tz)
    return FL.with_file_rank(listing)


def _target(spark: SparkSession, path: str) -> DataFrame | None:
    """The raw table: a versioned one at its newest version, else a plain Parquet folder; None when there is none."""
    if S.is_snapshot(spark, path):
        return S.read(spark, path)
    return spark.read.parquet(path) if table_columns(spark, path) is not None else None


def _target_columns(spark: SparkSession, path: str) -> list[str]:
    target = _target(spark, path)
    return [] if target is None else [c for c in target.columns if c != PDATE]


def load(spark: SparkSession, rows: DataFrame, path: str, date_col: str | None, based_on: int | None) -> None:
    """Add accepted rows to a raw table: a new version when ``based_on`` is given (the version they were chosen against)."""
    if based_on is None:
        append_raw(spark, rows, path, date_col)
    else:
        S.append(spark, path, prepare_for_target(rows, _target_columns(spark, path)), date_col, based_on)


def accept_dated(lines: DataFrame, files: DataFrame, fam: Family, target: DataFrame | None, as_of=None):
    """I1 / I4 on numbered lines: (accepted rows or None, file status).

    New dates only, the first file of a date wins; keyword rows pass the spike guard file by file, with
    ``as_of`` as "today" of the 30-day baseline window (required there), against the target's history
    (none on the first load: then only earlier files of the batch count).
    """
    rows, status = C.parse_header_lines(lines, [fam.date_col])
    if rows is None:
        return None, status
    rows = rows.join(files.select(F.col("path").alias("source_file"), "file_rank"), "source_file")
    accepted = DD.first_writer_wins(rows, target, fam.date_col, "file_rank", fam.date_format)
    if fam.table == "raw_keyword":
        if as_of is None:
            raise ValueError("the keyword family needs as_of (the run day) for its price guard")
        accepted = G.spike_guard_many(accepted, target, as_of, file_rank="file_rank", tiebreak=["file_rank", "source_line"])
    return accepted, status


def ingest_dated(spark: SparkSession, root: str, fam: Family, target_path: str, day=None, as_of=None,
                 files: DataFrame | None = None):
    """Header CSVs of one family -> (new rows, not yet written, or None; file status or None).

    ``files`` (path, mtime, file_rank) restricts the load, as the backfill does.
    """
    files = _ranked_files(spark, root, fam, day) if files is None else files
    paths = [r.path for r in files.select("path").collect()]   # the listing of one load
    if not paths:
        return None, None
    return accept_dated(C.read_lines(spark, paths, fam.encoding), files, fam, _target(spark, target_path), as_of or day)


def ingest_affiliate(spark: SparkSession, root: str, fam: Family, target_path: str, day=None):
    """Newest file of the day, preamble format, new order numbers only."""
    files = _ranked_files(spark, root, fam, day)
    newest = FL.latest_file(files)
    paths = [r.path for r in newest.collect()]
    if not paths:
        return None, None
    rows, status = C.read_affiliate(spark, paths, fam.encoding)
    return DD.dedup_by_key(rows, _target(spark, target_path), fam.key_col), status


def ingest_expansion(spark: SparkSession, root: str, fam: Family, target_path: str, day=None):
    """Preamble format; new (date, item) pairs, a later file losing pairs an earlier one brought."""
    files = _ranked_files(spark, root, fam, day)
    paths = [r.path for r in files.select("path").collect()]
    if not paths:
        return None, None
    rows, status = C.read_expansion(spark, paths, fam.encoding)
    rows = rows.join(files.select(F.col("path").alias("source_file"), "file_rank"), "source_file")
    return DD.dedup_by_composite(rows, _target(spark, target_path), fam.date_col, fam.item_col,
                                 file_rank="file_rank"), status


def _status_rows(status: DataFrame, family: str) -> DataFrame:
    reason = F.col("reason") if "reason" in status.columns else F.lit(None).cast("string")
    return status.select(F.lit(family).alias("family"), "path", F.when(F.col("state") == "ok", "loaded").otherwise(F.col("state")).alias("state"), reason.alias("message"))


def run_daily(spark: SparkSession, root: str, warehouse: str, day, as_of=None,
              families: list[str] | None = None, versioned: bool = False) -> DataFrame:
    """Every family; one row per file (loaded / rejected and why).

    A family without files or one that fails gives one row without a path, and the other families go on.
    ``versioned`` keeps the raw tables as versioned ones: a load is seen whole or not at all, and a load that
    another writer overtook is an error row instead of a double load.  Versioned tables stay so in any case.
    """
    none: list[tuple] = []
    out = []
    for name in families or list(FAMILIES):
        fam = FAMILIES[name]
        path = f"{warehouse}/{fam.table}"
        try:
            seen = S.versions(spark, path)
            based_on = seen[-1] if seen else 0 if versioned and table_columns(spark, path) is None else None
            if fam.dedup == "key":
                rows, status = ingest_affiliate(spark, root, fam, path, day)
            elif fam.dedup == "composite":
                rows, status = ingest_expansion(spark, root, fam, path, day)
            else:
                rows, status = ingest_dated(spark, root, fam, path, day, as_of)
            if status is None:
                none.append((name, None, "no_files", None))
                continue
            kept = _status_rows(status, name).collect()     # one row per file of this load
            if rows is not None:
                load(spark, rows, path, fam.date_col, based_on)
            out += [tuple(r) for r in kept]
        except Exception as e:  # noqa: BLE001 -- reported per family, as the daily run does
            none.append((name, None, "error", f"{type(e).__name__}: {str(e)[:300]}"))
    return spark.createDataFrame(none + out, STATUS)


def backfill(spark: SparkSession, root: str, fam: Family, target_path: str, as_of, days: int | None = 7):
    """I4: load the family's files whose name is dated within ``days`` before ``as_of`` (``None``: all of them).

    Returns (new rows, not yet written, or None; file status or None); every date goes to its first file.
    """
    prefix = fam.pattern.rsplit("/", 1)[-1].split("*")[0]
    listing = FL.backfill_files(FL.list_files(spark, f"{root}/{fam.pattern}"), prefix, as_of, days)
    return ingest_dated(spark, root, fam, target_path, as_of=as_of, files=FL.with_file_rank(listing))


def refresh_window(spark: SparkSession, root: str, fam: Family, target_path: str, as_of, days: int = 14,
                   dates: str | None = None, today="as_of", dry_run: bool = False):
    """Re-fetched files of the window replace their days in the target.

    ``dates`` (explicit list) wins over the trailing ``days`` window.  Only files modified on ``today``
    are used, by default the run day ``as_of``: an older file would overwrite matured days with frozen
    ones.  ``None`` takes files of any day.
    Returns the plan frame (K4); writes only when not ``dry_run``.  In a versioned table all days change at
    once or not at all; rows without a real date are logged, not loaded.
    """
    if dates:
        parsed = explicit_dates(spark, dates)
        # the list is a job parameter (a few tokens), so reporting the bad ones reads it on the driver
        bad = [r.token for r in parsed.where(F.col("d").isNull()).collect()]
        if bad:
            log.warning("ignoring date tokens that are not 8 digits: %s", bad)
        wanted = parsed.where(F.col("d").isNotNull())
    else:
        wanted = trailing_window(spark, as_of, days)
    today = as_of if today == "as_of" else today
    sel = FL.window_files(FL.list_files(spark, f"{root}/{fam.pattern}"), wanted, today)
    paths = [r.path for r in sel.select("path").collect()]
    if not paths:
        return None
    rows, status = C.parse_header_lines(C.read_lines(spark, paths, fam.encoding), [fam.date_col])
    for r in status.where("state <> 'ok'").collect():
        log.warning("refresh leaves out %s: %s", r.path, r.reason)
    if rows is None:
        return None
    rows = DD.normalize_rows(rows, fam.date_col, REFRESH_ORDER).drop(DD.NORM)
    target_cols = _target_columns(spark, target_path)
    staged = prepare_for_target(rows, target_cols or None, empty_keeps_all=False)
    if staged is None:
        return None
    plan = U.upsert_plan(staged, fam.date_col)
    if not dry_run and S.is_snapshot(spark, target_path):
        done = S.replace_days(spark, target_path, staged, fam.date_col)
        if done.rejected is not None:
            log.warning("refresh leaves out %d rows without a date", done.rejected.count())
    elif not dry_run:
        U.write_replace_by_date(spark, staged, target_path, fam.date_col, target_cols or None)
    return plan
