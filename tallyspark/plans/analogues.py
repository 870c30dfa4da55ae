"""Stand-ins for the shop's report tables, derived from the driver tables.

The shop's own tables (orders, product master, P&L view, ad reports) are not
in the test data, so every registered query first derives an analogue from the
TPC-H-ish tables.  The DuckDB oracle derives the same analogues independently
(``tallyspark.plans.oracle``).  Money stays DECIMAL so sums are exact and do
not depend on partitioning (float sums differ with the order of addition, and
the order differs from run to run on a cluster).

Mapping (all raw columns are text, as in the source tables):
  orders_a  <- lineitem x orders x part : one order line
  master_a  <- part (PROMO parts are not registered; large parts have a
               second cost version from 1998-01-01)
  pl_a      <- orders_a x master_a (as-of cost) by date x sku : the P&L view
  kw_a      <- events : keyword ad report rows (two date spellings)
  shohin_a  <- events (view/click) : item ad report rows
  rppexp_a  <- events (purchase, none on Saturdays) : expansion ad rows
  item_a    <- events (no errors, none on Sundays) : page analysis rows
  affi_a    <- orders : affiliate order lines
  daily_a   <- events by day x type : one daily-total report file each
  vrd_a     <- events by day x user : impressions / keyword clicks view
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.functions.dates import iso_text, jp_range_text
from tallyspark.functions.numbers import safe_decimal

MONEY = "decimal(18,2)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sku_from_name(c: str) -> Column:
    # 'red widget' -> 'Red-widget'
    return F.concat(F.upper(F.substring(c, 1, 1)), F.replace(F.expr(f"substr({c}, 2)"), F.lit(" "), F.lit("-")))


def orders_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).drop("order_day")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines plus the typed order day (filters on it reach the orders scan)."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"),
        _sku_from_name("p_name").alias("sku"),
        F.when(F.col("l_quantity") == 1, F.lit(None).cast("string"))
         .when(F.col("l_quantity") == 2, F.lit(""))
         .otherwise(F.concat(F.lit("Sys-"), F.col("l_partkey").cast("string"))).alias("sku_system"),
        F.col("p_name").alias("product_name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.when(F.round(F.col("l_discount") * 100).cast("int") == 10, F.lit("abc"))
         .otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string")).alias("amount"),
        F.col("l_quantity").cast("bigint").cast("string").alias("qty"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"),
        F.col("l_returnflag").alias("returnflag"),
        F.col("o_orderpriority").alias("priority"),
        F.to_date("o_orderdate").alias("order_day"),
    )


def master_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").where(F.col("p_type") != "PROMO")
    price = F.col("p_retailprice").cast(MONEY)
    base = p.select(
        _sku_from_name("p_name").alias("sku"),
        F.concat(F.lit("SYS-"), F.col("p_partkey").cast("string")).alias("sku_system"),
        F.to_date(F.lit("1995-01-01")).alias("valid_from"),
        (price * F.lit(0.4).cast("decimal(4,2)")).cast(MONEY).alias("cost"),
        F.col("p_size").cast(MONEY).alias("supplies"),
        F.when(F.col("p_type") == "LARGE", 500).otherwise(300).cast(MONEY).alias("shipping"),
    )
    v2 = p.where(F.col("p_size") > 40).select(
        _sku_from_name("p_name").alias("sku"),
        F.concat(F.lit("SYS-"), F.col("p_partkey").cast("string")).alias("sku_system"),
        F.to_date(F.lit("1998-01-01")).alias("valid_from"),
        (price * F.lit(0.44).cast("decimal(4,2)")).cast(MONEY).alias("cost"),
        F.col("p_size").cast(MONEY).alias("supplies"),
        F.when(F.col("p_type") == "LARGE", 500).otherwise(300).cast(MONEY).alias("shipping"),
    )
    return base.unionByName(v2)


def pl_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P&L by report_date x sku with the cost version valid on the order date.

    The as-of lookup is an equi-join on the SKU key plus a range predicate on
    [valid_from, valid_to); ``valid_to`` comes from ``lead`` over the master,
    so no line fans out to more than one version.
    """
    lines = order_lines(spark, sf_dir).select(
        F.lower("sku_system").alias("k"), "sku", "product_name",
        F.col("order_day").alias("report_date"),
        safe_decimal("amount").alias("amt"), safe_decimal("qty").alias("q"),
        "discount", "tax", "returnflag", "priority")
    w = Window.partitionBy("mk").orderBy("valid_from")
    m = (master_a(spark, sf_dir)
         .select(F.lower("sku_system").alias("mk"), "valid_from", "cost", "supplies", "shipping")
         .withColumn("valid_to", F.lead("valid_from").over(w)))
    cond = ((lines.k == m.mk) & (lines.report_date >= m.valid_from)
            & (m.valid_to.isNull() | (lines.report_date < m.valid_to)))
    j = lines.join(m, cond, "left")
    zero = F.lit(0).cast(MONEY)
    amt = F.col("amt")
    measures = {
        "sales": amt,
        "qty": F.col("q"),
        "cogs": F.coalesce("cost", zero) * F.col("q"),
        "supplies_cost": F.coalesce("supplies", zero) * F.col("q"),
        "shipping_cost": F.coalesce("shipping", zero),
        "fee_cost": amt * F.lit(0.10).cast("decimal(3,2)"),
        "rpp_cost": amt * F.col("discount"),
        "rppex_cost": amt * F.col("tax"),
        "review_cost": F.when(F.col("returnflag") == "R", 100).otherwise(0).cast(MONEY),
        "point_add_cost": amt * F.lit(0.01).cast("decimal(3,2)"),
        "affi_cost": F.when(F.col("priority") == "1-URGENT", amt * F.lit(0.05).cast("decimal(3,2)"))
                      .otherwise(zero),
    }
    agg = j.groupBy("report_date", "sku", "product_name").agg(
        *[F.sum(e).cast("decimal(20,4)").alias(n) for n, e in measures.items()])
    costs = ["cogs", "supplies_cost", "shipping_cost", "fee_cost", "rpp_cost", "rppex_cost",
             "review_cost", "point_add_cost", "affi_cost"]
    gp = F.coalesce("sales", F.lit(0)) - sum((F.coalesce(c, F.lit(0)) for c in costs), F.lit(0))
    return agg.withColumn("gross_profit", gp.cast("decimal(20,4)"))


def _event_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))


def _two_spellings(id_col: str = "event_id") -> Column:
    return F.when(F.col(id_col) % 2 == 0, jp_range_text("d")).otherwise(iso_text("d"))


def kw_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _event_day(spark, sf_dir)
    return e.select(
        F.col("event_id").alias("row_no"),
        _two_spellings().alias("date_text"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("sku"),
        F.col("event_type").alias("kw"),
        F.when(F.col("event_type") == "error", F.lit(""))
         .otherwise((F.col("value") * 10).cast("decimal(12,1)").cast("string")).alias("guide"),
        F.floor("value").cast("bigint").cast("string").alias("clicks"),
        F.when(F.col("event_type") == "view", F.lit("0.00%"))
         .otherwise(F.concat(F.col("value").cast("decimal(10,2)").cast("string"), F.lit("%"))).alias("ctr"),
        "d",
    )


def shohin_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw_a(spark, sf_dir).where(F.col("kw").isin("view", "click")).drop("guide")


def rppexp_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _event_day(spark, sf_dir).where((F.col("event_type") == "purchase") & (F.dayofweek("d") != 7))
    return e.select(F.col("event_id").alias("row_no"), iso_text("d").alias("date_text"),
                    F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("sku"))


def item_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _event_day(spark, sf_dir).where((F.col("event_type") != "error") & (F.dayofweek("d") != 1))
    return e.select(
        F.col("event_id").alias("row_no"),
        F.when(F.col("event_id") % 2 == 0, iso_text("d"))
         .otherwise(F.date_format("d", "yyyy/MM/dd")).alias("date_text"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("sku"))


def affi_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_no"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "),
                 (F.col("o_custkey") % 24).cast("string"), F.lit(":05:00")).alias("occurred"),
        F.col("o_orderstatus").alias("status"))


def daily_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily-total report file per (day, event type).

    The path carries the target date and a generation stamp
    (``<type>/RPP日次12h_<target>_<yyyymmdd>_<hhmm>.csv``); ``n_cols`` is 41 for
    the error type (a non-daily report shape the scan must skip); the signup
    type writes clicks as ``n.0`` (not an integer: the file is skipped).
    """
    e = _event_day(spark, sf_dir)
    g = e.groupBy("d", "event_type").agg(
        F.max("ts").alias("last_ts"),
        F.count_if(F.col("value") < 2).alias("n_low"),
        F.sum(F.when(F.col("value") < 2, F.floor(F.col("value") * 10))).cast("bigint").alias("cost_low"))
    return g.select(
        F.concat(F.col("event_type"), F.lit("/RPP日次12h_"), F.date_format("d", "yyyyMMdd"), F.lit("_"),
                 F.date_format("last_ts", "yyyyMMdd_HHmm"), F.lit(".csv")).alias("path"),
        F.when(F.col("event_type") == "error", 41).otherwise(42).alias("n_cols"),
        F.when(F.col("event_type") == "signup", F.concat(F.col("n_low").cast("string"), F.lit(".0")))
         .otherwise(F.col("n_low").cast("string")).alias("clicks_text"),
        F.when(F.coalesce("cost_low", F.lit(0)) == 0, F.lit(""))
         .otherwise(F.col("cost_low").cast("string")).alias("cost_text"))


def li_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw report rows for the dedup rules.

    Even line numbers spell the date as a jp range, odd ones as ISO; line 1
    pads its order number with blanks; ``flag`` R rows play the target table.
    """
    li = read(spark, sf_dir, "lineitem").withColumn("d", F.to_date("l_shipdate"))
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_no"),
        F.when(F.col("l_linenumber") % 2 == 0, jp_range_text("d")).otherwise(iso_text("d")).alias("date_text"),
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit(" "), F.col("l_orderkey").cast("string"), F.lit(" ")))
         .otherwise(F.col("l_orderkey").cast("string")).alias("order_no"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("item"),
        F.col("l_returnflag").alias("flag"))


def report_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report-folder listing: one file per event (its time is the file's mtime).

    Error events stand for files without a date in the name.
    """
    e = _event_day(spark, sf_dir)
    name = F.when(F.col("event_type") == "error",
                  F.concat(F.lit("rpp_reports/RPP商品別12h_summary_"), F.col("event_id").cast("string"), F.lit(".csv"))
                  ).otherwise(F.concat(F.lit("rpp_reports/RPP商品別12h_"), F.date_format("d", "yyyyMMdd"), F.lit("_"),
                                       F.date_format("ts", "HHmmss"), F.lit("_"), F.col("event_id").cast("string"),
                                       F.lit(".csv")))
    return e.select(name.alias("path"), F.col("ts").alias("mtime"))


def vrd_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _event_day(spark, sf_dir)
    return e.groupBy(F.col("d").alias("report_date"),
                     F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("sku")).agg(
        F.count_if(F.col("event_type") == "view").alias("impressions"),
        F.count_if(F.col("event_type") == "click").alias("kw_clicks"))
