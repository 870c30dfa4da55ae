"""Column profile of a table.

``column_sketch`` is the profile of one scan: every measure is a mergeable partial
aggregate, whatever the table's size.  ``column_profile`` adds exact distinct counts.

Counts and extremes are one global aggregate.  The exact distinct counts
unpivot the table to (column, value) pairs, with map-side combine per pair, so
no column's values are funnelled into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.numbers import safe_double


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, type, rows, non_blank, distinct_values, numeric, min_value, max_value) per column."""
    cols = list(columns or df.columns)
    types = dict(df.dtypes)
    def stats(i: int, c: str):
        v = F.col(c).cast("string")
        full = v.isNotNull() & (F.trim(v) != "")
        return F.struct(F.lit(i).alias("pos"), F.count(F.lit(1)).alias("rows"), F.count_if(full).alias("non_blank"),
                        F.count_if(safe_double(v).isNotNull()).alias("numeric"), F.min(v).alias("min_value"), F.max(v).alias("max_value"))

    # one global aggregate: every task gives one row, whatever the cells
    whole = df.agg(F.array(*[stats(i, c) for i, c in enumerate(cols)]).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    # exact distinct values: (position, value) is the shuffle key, so a hot value collapses map-side
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)]))
        .alias("p")).select("p.*")
    distinct = pairs.where(F.col("value").isNotNull()).distinct().groupBy("pos").agg(F.count(F.lit(1)).alias("distinct_values"))
    agg = whole.where("rows > 0").join(distinct, "pos", "left").withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)).cast("bigint"))
    names = F.array(*[F.lit(c) for c in cols])
    tps = F.array(*[F.lit(types[c]) for c in cols])
    return agg.select(F.element_at(names, F.col("pos") + 1).alias("column"),
                      F.element_at(tps, F.col("pos") + 1).alias("type"),
                      "rows", "non_blank", "distinct_values", "numeric", "min_value", "max_value",
                      "pos").orderBy("pos").drop("pos")


#: a value's sample class: the first digit of its md5, by twos
SAMPLE_CLASSES = ("01", "23", "45", "67", "89", "ab", "cd", "ef")


def column_sketch(df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.02) -> DataFrame:
    """(column, type, rows, non_blank, numeric, approx_distinct, min_value, max_value, samples) per column, in one scan.

    ``approx_distinct`` is HyperLogLog++ with relative error ``rsd``.  ``samples`` are up to 8 distinct values: of
    each class of values the one of least md5, so the sample is even over the distinct values, the same in
    every run and merges as minima do.  No cell leaves its row: nothing is exploded or shuffled but one row a task.
    An empty table gives no rows.
    """
    cols = list(columns or df.columns)
    types = dict(df.dtypes)
    cells = df.select(*[F.struct(F.col(c).cast("string").alias("v"), F.md5(F.col(c).cast("string").cast("binary")).alias("h")).alias(f"c{i}") for i, c in enumerate(cols)])

    def stats(i: int, c: str):
        v, h = F.col(f"c{i}.v"), F.col(f"c{i}.h")
        least = [F.min(F.when(F.substring(h, 1, 1).isin(*k), F.struct(h.alias("h"), v.alias("v")))) for k in SAMPLE_CLASSES]
        picked = F.transform(F.filter(F.array(*least), lambda x: x.isNotNull()), lambda x: x["v"])
        return F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.count(F.lit(1)).alias("rows"),
                        F.count_if(v.isNotNull() & (F.trim(v) != "")).alias("non_blank"), F.count_if(safe_double(v).isNotNull()).alias("numeric"),
                        F.approx_count_distinct(v, rsd).alias("approx_distinct"), F.min(v).alias("min_value"), F.max(v).alias("max_value"), picked.alias("samples"))

    whole = cells.agg(F.array(*[stats(i, c) for i, c in enumerate(cols)]).alias("s"))
    return whole.select(F.explode("s").alias("s")).select("s.*").where("rows > 0")
