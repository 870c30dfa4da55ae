"""Report-file listings (S8-S13, S16, S18; A10, O5).

A listing is a DataFrame of (path, mtime[, size]) -- from ``binaryFile``
without reading content, or from Spark's ``_metadata`` columns -- so file
selection is planned like any other query and never loops on the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.dates import as_date


# the shop's day, for "files modified today"
REPORT_TZ = "Asia/Tokyo"


def list_files(spark: SparkSession, glob_path: str, recursive: bool = False) -> DataFrame:
    """(path, name, mtime, size) of matching files; file contents are not read.

    Files of 0 bytes are not listed: Spark's file sources give no rows for them.
    """
    r = spark.read.format("binaryFile")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    try:
        df = r.load(glob_path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string, mtime timestamp, size bigint, name string")
    df = df.select("path", F.col("modificationTime").alias("mtime"), F.col("length").alias("size"))
    return df.withColumn("name", base_name("path"))


def base_name(path) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, r"[^/\\]*$", 0)


def modified_on(listing: DataFrame, day, tz: str | None = None, mtime: str = "mtime") -> DataFrame:
    """Files whose modification time falls on ``day`` (in ``tz`` if given), oldest first."""
    t = F.col(mtime)
    if tz:
        t = F.from_utc_timestamp(F.to_utc_timestamp(t, F.current_timezone()), tz)
    return listing.where(F.to_date(t) == as_date(day)).orderBy(mtime, "path")


def with_file_rank(listing: DataFrame, mtime: str = "mtime", path: str = "path") -> DataFrame:
    """The load order of files.  (mtime, path) itself is the rank: it compares, sorts and joins like a number
    and needs no ordering of the whole listing."""
    return listing.withColumn("file_rank", F.struct(F.col(mtime).alias("mtime"), F.col(path).alias("path")))


def latest_file(listing: DataFrame, mtime: str = "mtime", path: str = "path") -> DataFrame:
    """The newest file (ties: the greater path) as a one-row frame."""
    return listing.agg(F.max_by(F.struct(path, mtime), F.struct(mtime, path)).alias("f")).select("f.*") \
                  .where(F.col(path).isNotNull())


def file_target_date(path) -> Column:
    """The first ``_yyyymmdd_`` in the base name, else NULL."""
    m = F.regexp_extract(base_name(path), r"_(\d{8})_", 1)
    return F.nullif(m, F.lit(""))


def backfill_target_date(path, prefix: str) -> Column:
    """S12 (backfill variant): the text after ``prefix`` up to the first ``_``."""
    stem = F.replace(F.replace(base_name(path), F.lit(prefix), F.lit("")), F.lit(".csv"), F.lit(""))
    return F.split_part(stem, F.lit("_"), F.lit(1))


def latest_file_per_date(listing: DataFrame, path: str = "path", mtime: str = "mtime") -> DataFrame:
    """Newest file per file-name date; files without a date are ignored."""
    d8 = file_target_date(path)
    return (listing.where(d8.isNotNull()).groupBy(d8.alias("d8"))
            .agg(F.max_by(F.struct(F.col(path).alias("path"), F.col(mtime).alias("mtime")),
                          F.struct(mtime, path)).alias("f"))
            .select("d8", "f.path", "f.mtime"))


def window_files(listing: DataFrame, wanted: DataFrame, today=None, wanted_col: str = "d",
                 path: str = "path", mtime: str = "mtime") -> DataFrame:
    """S18 file part: the newest file per wanted date, re-fetched today unless ``today`` is None."""
    latest = latest_file_per_date(listing, path, mtime)
    w = wanted.select(F.date_format(wanted_col, "yyyyMMdd").alias("_w"))
    sel = latest.join(w, latest.d8 == w._w, "left_semi")
    if today is not None:
        sel = sel.where(F.to_date("mtime") == as_date(today))
    return sel


def backfill_files(listing: DataFrame, prefix: str, as_of=None, days: int | None = 7,
                   path: str = "path") -> DataFrame:
    """Files whose target date (text) is >= as_of - days; ``days=None`` takes all.

    A string comparison with no upper bound, as in the source: days+1 dates
    including ``as_of`` itself.
    """
    t = listing.withColumn("target_date", backfill_target_date(path, prefix))
    if days is None:
        return t
    cutoff = F.date_format(F.date_sub(as_date(as_of), days), "yyyyMMdd")
    return t.where(F.col("target_date") >= cutoff)


def new_since(listing: DataFrame, ledger: DataFrame, start, path: str = "path", mtime: str = "mtime",
              size: str = "size") -> DataFrame:
    """Files not seen before (anti join on the path ledger), modified since ``start``, non-empty."""
    st = F.to_timestamp(F.lit(start)) if isinstance(start, str) else start
    fresh = listing.where((F.col(mtime) >= st) & (F.col(size) > 0))
    return fresh.join(ledger.select(F.col(path).alias("_seen")), F.col(path) == F.col("_seen"), "left_anti")


def required_files(spark: SparkSession, listing: DataFrame, required: dict[str, str], date_from, date_to,
                   mtime: str = "mtime", name: str = "name") -> DataFrame:
    """Q5 (S8 + J9): per day, does each required report kind have a file modified that day?

    ``required`` maps a label to a regex on the file name.  The listing is
    reduced to distinct (label, day) pairs before anything else, and the
    (day x label) grid is built with generators, not a join.
    """
    kinds = F.array(*[F.struct(F.lit(k).alias("label"), F.lit(v).alias("pat")) for k, v in required.items()])
    hits = (listing.select(F.to_date(mtime).alias("d"), F.col(name).alias("_n"))
            .where((F.col("d") >= as_date(date_from)) & (F.col("d") <= as_date(date_to)))
            .select("d", F.explode(F.filter(kinds, lambda k: F.regexp_like(F.col("_n"), k["pat"]))).alias("k"))
            .select("d", F.col("k.label").alias("label")).distinct()
            .withColumn("present", F.lit(True)))
    grid = (spark.range(1).select(F.explode(F.sequence(as_date(date_from), as_date(date_to))).alias("d"))
            .select("d", F.explode(F.array(*[F.lit(k) for k in required])).alias("label")))
    return (grid.join(hits, ["d", "label"], "left")
            .select(F.date_format("d", "yyyy-MM-dd").alias("d"), "label",
                    F.coalesce("present", F.lit(False)).alias("present")))
