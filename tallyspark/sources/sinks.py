"""Raw-table sinks (K1, K8; P1-P4).

Raw tables are parquet folders of all-string columns partitioned by ``pdate``
(the parsed business date), so later checks prune partitions and the
replace-by-date upsert overwrites whole partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.dates import parse_mixed_date
from tallyspark.functions.text import sanitize_columns
from tallyspark.sources.catalog import table_columns

PDATE = "pdate"
META = ("source_file", "source_mtime", "source_line", "file_rank")


def stringify(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every column as text, NULL and the texts ``nan``/``None`` as ''."""
    cols = list(columns or df.columns)
    return df.select(*[F.when(F.col(c).isNull() | F.col(c).cast("string").isin("nan", "None"), F.lit(""))
                       .otherwise(F.col(c).cast("string")).alias(c) for c in cols])


def prepare_for_target(df: DataFrame, target_cols: Sequence[str] | None, *, fix_spellings: bool = False,
                       empty_keeps_all: bool = True) -> DataFrame | None:
    """P1 -> P2 -> P3 -> P4.

    P3 keeps the columns the target already has; if none of them is known the
    append path keeps all (``empty_keeps_all``) and the upsert path skips
    (returns None).
    """
    df = df.drop(*[c for c in META if c in df.columns])
    df = sanitize_columns(df, fix_spellings=fix_spellings)
    if target_cols:
        keep = [c for c in df.columns if c in set(target_cols)]
        if keep:
            df = df.select(*keep)
        elif not empty_keeps_all:
            return None
    return stringify(df)


def append_raw(spark: SparkSession, df: DataFrame, path: str, date_col: str | None = None, *,
               fix_spellings: bool = False) -> dict:
    """K1: append new rows to a raw table; a no-op when there are none."""
    target_cols = table_columns(spark, path)
    out = prepare_for_target(df, [c for c in (target_cols or []) if c != PDATE], fix_spellings=fix_spellings)
    if out.isEmpty():
        return {"written": 0}
    if date_col and date_col in out.columns:
        out = out.withColumn(PDATE, parse_mixed_date(date_col))
        out.write.mode("append").partitionBy(PDATE).parquet(path)
    else:
        out.write.mode("append").parquet(path)
    return {"written": None}


def write_clean(df: DataFrame, path: str, partition_by: str | None = None, fmt: str = "parquet") -> None:
    """K8: cleaned report rows out (parquet by default; no CSV round trip needed)."""
    w = df.write.mode("append").format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("encoding", "UTF-8")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.save(path)
