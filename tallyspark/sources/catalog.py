"""Catalog helpers.

Tolerant key scans, schema evolution and views, written as a Spark user
would: the catalog for names and schemas, DataFrames for the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException


def _missing(e: AnalysisException) -> bool:
    """Whether the error says that the table or path does not exist (and nothing else)."""
    return (e.getCondition() or "").split(".")[0] in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def table_columns(spark: SparkSession, path_or_table: str) -> list[str] | None:
    """Column names of a table/path, or None when it does not exist; any other error surfaces."""
    try:
        if "/" in path_or_table:
            return spark.read.parquet(path_or_table).columns
        return spark.table(path_or_table).columns
    except AnalysisException as e:
        if _missing(e):
            return None
        raise


def table_or_none(spark: SparkSession, path_or_table: str) -> DataFrame | None:
    """The table, or None when it does not exist; any other error surfaces."""
    return None if table_columns(spark, path_or_table) is None else spark.read.parquet(path_or_table) if "/" in path_or_table else spark.table(path_or_table)


def table_or_empty(spark: SparkSession, path_or_table: str, schema: T.StructType | str) -> DataFrame:
    """The table, or an empty frame with ``schema`` when it does not exist.

    Only "does not exist" is tolerated; any other error surfaces.
    """
    try:
        if "/" in path_or_table:
            return spark.read.parquet(path_or_table)
        return spark.table(path_or_table)
    except AnalysisException as e:
        if _missing(e):
            return spark.createDataFrame([], schema)
        raise


def distinct_keys(df: DataFrame, *cols: str) -> DataFrame:
    """The distinct key values (one column or a composite), never collected."""
    return df.select(*[F.col(c) for c in cols]).distinct()


def add_column_if_missing(spark: SparkSession, table: str, column: str, dtype: str = "STRING") -> bool:
    """K6: add a column when it is not there yet; returns whether it was added.

    Spark's ``ALTER TABLE … ADD COLUMNS`` has no ``IF NOT EXISTS``, so the
    schema is checked first.
    """
    if column in spark.table(table).columns:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{column}` {dtype})")
    return True


def add_columns_if_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """K6 on a DataFrame / view: add each missing column as NULL of its type; present ones are kept."""
    out = df
    for name, dtype in columns.items():
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(dtype))
    return out


def create_or_replace_view(spark: SparkSession, view: str, source: str, temporary: bool = False) -> None:
    """K7: ``SELECT *`` view over a table; replaced when it exists."""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {view} AS SELECT * FROM {source}")
