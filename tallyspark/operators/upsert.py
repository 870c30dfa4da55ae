"""Replace-by-date upsert for late-maturing report rows (K2, K3, K4, J7, I5 core).

Orders attributed to a click keep arriving for 720 hours, so recent days are
re-fetched and replaced wholesale.  The target holds both date spellings; the
delete side parses both, the staged side is already ISO.

Two forms:
* ``replace_by_date`` -- the new table as a DataFrame (target rows whose day is not
  staged, looked up where they are read, + union); for checks and formats without MERGE.
* ``write_replace_by_date`` -- the physical write: the table is partitioned by
  ``pdate`` (the parsed date, so both spellings of a day share a partition)
  and staged rows go in with dynamic partition overwrite, touching only the
  partitions being replaced.

Departure: a staged row whose date does not parse is returned as rejected
instead of being inserted (the source system inserted it without deleting
anything, so every re-run duplicated it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.dates import iso_text, parse_iso_only, parse_mixed_date
from tallyspark.operators.daytable import day_table
from tallyspark.session import checkpoint_dir

PDATE = "pdate"


def staged_dates(staged: DataFrame, date_col: str) -> DataFrame:
    """Distinct parsed dates of the staged rows (``SELECT DISTINCT PARSE_DATE(...)``)."""
    return (staged.select(parse_iso_only(F.substring(date_col, 1, 10)).alias("_sd"))
            .where(F.col("_sd").isNotNull()).distinct())


def align_to_target(staged: DataFrame, target_columns: list[str]) -> DataFrame:
    """P3 for the upsert: keep staged columns the target has; the rest of the target is NULL."""
    keep = [c for c in staged.columns if c in target_columns]
    if not keep:
        raise ValueError("staged rows share no column with the target")
    return staged.select(*[F.col(c).cast("string").alias(c) if c in keep
                           else F.lit(None).cast("string").alias(c) for c in target_columns])


def replace_by_date(target: DataFrame, staged: DataFrame, date_col: str = "日付"):
    """(new target, rejected staged rows).

    Target rows whose parsed date is among the staged dates are replaced; rows
    with an unparseable date are kept (a NULL never matches).
    """
    ok = staged.where(parse_iso_only(F.substring(date_col, 1, 10)).isNotNull())
    rejected = staged.where(parse_iso_only(F.substring(date_col, 1, 10)).isNull())
    dates = staged_dates(ok, date_col)
    table = day_table(dates.select(iso_text("_sd").alias("t")), "t")
    kept = (target.join(dates, parse_mixed_date(target[date_col]) == dates["_sd"], "left_anti") if table is None
            else table.rows(target, iso_text(parse_mixed_date(date_col)), lambda v: v.isNull()))
    new = kept.unionByName(align_to_target(ok, target.columns))
    return new, rejected


def upsert_plan(staged: DataFrame, date_col: str = "日付") -> DataFrame:
    """K4 dry run: what would be replaced (dates, first, last, rows) -- writes nothing."""
    d = parse_iso_only(F.substring(date_col, 1, 10))
    return staged.agg(F.count_distinct(d).alias("n_dates"),
                      iso_text(F.min(d)).alias("first_date"), iso_text(F.max(d)).alias("last_date"),
                      F.count(F.lit(1)).alias("rows"))


def with_partition_date(df: DataFrame, date_col: str = "日付") -> DataFrame:
    """Add ``pdate`` = the parsed date (both spellings) for partitioned storage."""
    return df.withColumn(PDATE, parse_mixed_date(date_col))


def write_replace_by_date(spark: SparkSession, staged: DataFrame, path: str, date_col: str = "日付",
                          target_columns: list[str] | None = None) -> dict:
    """K2 + K3 on files: materialize the staging, refuse an empty one, overwrite its partitions.

    The staging is checkpointed to the shared checkpoint folder first, so the
    write never reads the partitions it is replacing and a lost executor
    recomputes from the checkpoint, not from the source files.
    """
    ok = staged.where(parse_iso_only(F.substring(date_col, 1, 10)).isNotNull())
    if target_columns is not None:
        ok = align_to_target(ok, target_columns)
    checkpoint_dir(spark)
    ok = with_partition_date(ok, date_col).checkpoint(eager=True)
    if ok.isEmpty():
        return {"written": False, "reason": "empty staging"}
    (ok.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(PDATE).parquet(path))
    return {"written": True}
