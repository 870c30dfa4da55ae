"""A third of all rows on one key: results stay whole and plans pre-aggregate."""

from pyspark.sql import functions as F

from tallyspark.operators import dedup as DD
from tallyspark.operators import guard as G

N = 30000


def _rows(spark):
    # a third of the rows share one date / one (sku, kw); the rest spread over 30 days / 300 keys
    r = spark.range(N).select(
        F.col("id").alias("row_no"),
        F.when(F.col("id") % 3 == 0, F.lit("2026-07-01"))
         .otherwise(F.date_format(F.date_add(F.to_date(F.lit("2026-06-01")), (F.col("id") % 30).cast("int")),
                                  "yyyy-MM-dd")).alias("日付"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 300).cast("string")))
         .alias("商品管理番号"),
        F.lit("kw").alias("キーワード"),
        (F.col("id") % 97 + 40).cast("string").alias("目安CPC"),
        (F.col("id") % 5).cast("int").alias("file_rank"))
    return r


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_writer_wins_hot_date(spark):
    rows = _rows(spark)
    out = DD.first_writer_wins(rows, None, "日付", "file_rank")
    plan = _plan(out)
    assert "Window" not in plan                      # no window over all rows of a date
    assert "Join" not in plan and "Exchange" not in plan.split("Subquer")[0]   # nor rows exchanged by date
    winners = _plan(DD.day_winners(DD.normalize_rows(rows, "日付", DD.new_rows_order("rpp_range")), "file_rank"))
    assert "Window" not in winners and "partial_min" in winners                # winners pre-aggregated map-side
    # brute force: per date the rows of the lowest rank
    want = rows.groupBy("日付").agg(F.min("file_rank").alias("w")).join(rows, "日付") \
        .where(F.col("w") == F.col("file_rank")).count()
    assert out.count() == want and want > 0


def test_baseline_hot_key(spark):
    rows = _rows(spark)
    b = G.guideline_baseline(rows, "2026-07-15", tiebreak=["row_no"])
    plan = _plan(b)
    assert "Window" not in plan and "partial_max_by" in plan
    hot = b.where(F.col("商品管理番号") == "hot").first()
    # brute force: the latest date, then the largest row number among rows of that date
    last = rows.where((F.col("商品管理番号") == "hot")).orderBy(F.desc("日付"), F.desc("row_no")).first()
    assert hot.prior == float(last["目安CPC"])


def test_composite_hot_key(spark):
    rows = _rows(spark).withColumnRenamed("キーワード", "item")
    out = DD.dedup_by_composite(rows, None, "日付", "商品管理番号", file_rank="file_rank")
    assert "partial_min" in _plan(out)
    want = (rows.groupBy("日付", "商品管理番号").agg(F.min("file_rank").alias("w"))
            .join(rows, ["日付", "商品管理番号"]).where(F.col("w") == F.col("file_rank")).count())
    assert out.count() == want

