"""Profit and master-match analytics (the diagnostic queries).

Each function takes DataFrames plus column names (defaults are the shop's own
column names) and returns a lazily planned DataFrame.  Patterns used:
aggregate before the join (the join sees one row per SKU, not per order line),
``left_anti`` instead of ``LEFT JOIN … IS NULL``, DISTINCT before a lookup so
duplicate master versions cannot fan rows out.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.numbers import safe_decimal, safe_divide, safe_double, strip_pct_bom
from tallyspark.functions.text import non_blank

MONEY = "decimal(18,2)"

# Match-status labels (code-point order puts マッチ済 before
# ★未マッチ★ in a descending sort).
MATCHED = "マッチ済"
UNMATCHED = "★未マッチ★"

COST_COLUMNS = ("cogs", "supplies_cost", "shipping_cost", "fee_cost", "rpp_cost",
                "rppex_cost", "review_cost", "point_add_cost", "affi_cost")
# P&L output names for the summed measures, in report order.
PNL_NAMES = {"sales": "sales", "cogs": "cogs", "supplies_cost": "supplies",
             "shipping_cost": "shipping", "fee_cost": "fee", "rpp_cost": "rpp",
             "rppex_cost": "rppex", "review_cost": "review", "point_add_cost": "point_add",
             "affi_cost": "affi", "gross_profit": "gross_profit"}


def _money(c, as_decimal: bool) -> Column:
    return safe_decimal(c) if as_decimal else safe_double(c)


def registered_systems(master: DataFrame, sku_system: str = "sku_system") -> DataFrame:
    """Distinct lower-cased, non-blank system SKUs of the product master."""
    return (master.where(non_blank(sku_system))
            .select(F.lower(sku_system).alias("_pm_sku_system")).distinct())


def unmatched_skus(orders: DataFrame, master: DataFrame, date_from: str, *,
                   sku: str = "商品管理番号", sku_system: str = "システム連携用SKU",
                   order_date: str = "注文日", amount: str = "商品合計", qty: str = "数量",
                   master_sku_system: str = "sku_system", exact_money: bool = True) -> DataFrame:
    """Order SKUs since ``date_from`` whose system SKU is not in the master.

    Two-level aggregation: order lines -> (sku, day) with a hash aggregate,
    then (sku) with min/max of the day.  min/max over date *text* can only be
    sort-aggregated; this way the sort sees one row per SKU and day instead
    of one per order line.
    """
    daily = (orders.where((F.col(order_date) >= F.lit(date_from)) & non_blank(sku) & non_blank(sku_system))
             .groupBy(F.lower(sku).alias("sku"), F.lower(sku_system).alias("sku_system"),
                      F.col(order_date).alias("_day"))
             .agg(F.sum(_money(amount, exact_money)).alias("_sales"), F.sum(safe_double(qty)).alias("_qty")))
    o = (daily.groupBy("sku", "sku_system")
         .agg(F.min("_day").alias("first_order_date"),
              F.max("_day").alias("last_order_date"),
              F.sum("_sales").alias("total_sales"),
              F.sum("_qty").alias("total_qty")))
    pm = registered_systems(master, master_sku_system)
    out = o.join(pm, o.sku_system == pm._pm_sku_system, "left_anti")
    return out.select(
        "sku", "sku_system",
        F.col("first_order_date").cast("string").alias("first_order_date"),
        F.col("last_order_date").cast("string").alias("last_order_date"),
        F.round("total_sales", 0).cast("double").alias("total_sales"),
        F.col("total_qty").cast("double").alias("total_qty"),
    ).orderBy(F.desc("total_sales"), "sku", "sku_system")


def match_status(orders: DataFrame, master: DataFrame, day: str, *,
                 sku: str = "商品管理番号", sku_system: str = "システム連携用SKU",
                 order_date: str = "注文日", amount: str = "商品合計", qty: str = "数量",
                 master_sku_system: str = "sku_system", exact_money: bool = True) -> DataFrame:
    """Every order SKU of one day, matched or not (a NULL system SKU forms its own group)."""
    o = (orders.where((F.col(order_date) == F.lit(day)) & F.col(sku).isNotNull())
         .groupBy(F.lower(sku).alias("sku"), F.lower(sku_system).alias("sku_system"))
         .agg(F.sum(_money(amount, exact_money)).alias("sales"),
              F.sum(safe_double(qty)).alias("qty")))
    pm = registered_systems(master, master_sku_system)
    j = o.join(pm, o.sku_system == pm._pm_sku_system, "left")
    return j.select(
        "sku", "sku_system",
        F.round("sales", 0).cast("double").alias("sales"),
        F.col("qty").cast("double").alias("qty"),
        F.when(F.col("_pm_sku_system").isNotNull(), F.lit(MATCHED)).otherwise(F.lit(UNMATCHED)).alias("status"),
    ).orderBy(F.desc("status"), F.desc("sales"), "sku", "sku_system")


def master_listing(master: DataFrame, columns: Sequence[str] = ("sku", "cost", "supplies", "shipping", "valid_from"),
                   sku_system: str = "sku_system", order: Sequence[str] = ("sku", "valid_from", "sku_system"),
                   lower_key: str = "sku_system") -> DataFrame:
    """Master rows with a lower-cased key, sorted."""
    cols = [F.lower(lower_key).alias(lower_key) if c == lower_key else F.col(c) for c in [sku_system, *columns]]
    return master.select(*cols).orderBy(*order)


def unit_cost(pl: DataFrame, sku_value: str, date_from: str, *, sku: str = "sku",
              report_date: str = "report_date") -> DataFrame:
    """R2: per day sales, qty, cogs and the unit cost actually used (cogs / qty)."""
    return (pl.where((F.col(sku) == F.lit(sku_value)) & (F.col(report_date) >= F.to_date(F.lit(date_from))))
            .select(F.date_format(report_date, "yyyy-MM-dd").alias("report_date"),
                    F.col(sku).alias("sku"),
                    F.round("sales", 0).cast("double").alias("sales"),
                    F.col("qty").cast("double").alias("qty"),
                    F.round("cogs", 0).cast("double").alias("cogs"),
                    F.round(safe_divide(F.col("cogs").cast("double"), F.col("qty").cast("double")), 0)
                     .alias("unit_cost_used"))
            .orderBy("report_date"))


def total_cost(prefix: str = "") -> Column:
    """Sum of the nine cost measures; a NULL measure counts as 0."""
    names = [PNL_NAMES[c] for c in COST_COLUMNS]
    return sum((F.coalesce(F.col(prefix + n), F.lit(0)) for n in names), F.lit(0))


def daily_pnl(pl: DataFrame, date_from: str, date_to: str | None = None, *,
              report_date: str = "report_date", scale: int = 2) -> DataFrame:
    """P&L by report date over a range (``date_to=None``: one day)."""
    d = F.col(report_date)
    lo = F.to_date(F.lit(date_from))
    hi = F.to_date(F.lit(date_to or date_from))
    sums = [F.sum(src).alias(dst) for src, dst in PNL_NAMES.items()]
    g = (pl.where((d >= lo) & (d <= hi)).groupBy(report_date)
         .agg(*sums, F.count_if((F.col("cogs") == 0) & (F.col("sales") > 0)).alias("sku_no_cost_count")))
    out = g.select(
        F.date_format(report_date, "yyyy-MM-dd").alias("report_date"),
        *[F.round(dst, scale).cast("double").alias(dst) for dst in PNL_NAMES.values()],
        F.round(total_cost(), scale).cast("double").alias("total_cost"),
        F.col("sku_no_cost_count").cast("bigint").alias("sku_no_cost_count"))
    return out.orderBy("report_date")


def sku_pnl(pl: DataFrame, day: str, *, report_date: str = "report_date") -> DataFrame:
    """One day's P&L per SKU, rounded to whole yen, largest sales first."""
    r = lambda c, n=None: F.round(c, 0).cast("double").alias(n or c)
    return (pl.where(F.col(report_date) == F.to_date(F.lit(day)))
            .select("sku", "product_name", r("sales"), F.col("qty").cast("double").alias("qty"),
                    r("cogs"), r("supplies_cost", "supplies"), r("shipping_cost", "shipping"),
                    r("fee_cost", "fee"), r("rpp_cost", "rpp"), r("rppex_cost", "rppex"),
                    r("gross_profit"))
            .orderBy(F.desc("sales"), "sku"))


def raw_daily_profile(raw: DataFrame, date_from: str, *, date_col: str = "日付",
                      clicks: str = "クリック数合計", ctr: str = "CTR") -> DataFrame:
    """Rows, clicks and rows with CTR > 0 per first-10-characters of the date text.

    The cut-off is a *string* comparison on the first 10 characters, as in
    the source query; a jp-spelt 2024 date sorts after any ISO date.
    """
    dt = F.left(F.col(date_col).cast("string"), F.lit(10))
    return (raw.where(F.col(date_col).isNotNull() & (dt >= F.lit(date_from)))
            .groupBy(dt.alias("dt"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum(safe_double(clicks)).alias("clicks"),
                 F.count_if(safe_double(strip_pct_bom(ctr)) > 0).alias("ctr_non_zero"))
            .select("dt", F.col("rows").cast("bigint").alias("rows"),
                    F.col("clicks").cast("double").alias("clicks"),
                    F.col("ctr_non_zero").cast("bigint").alias("ctr_non_zero"))
            .orderBy("dt"))


def daily_impressions(view: DataFrame, date_from: str, *, report_date: str = "report_date") -> DataFrame:
    """Impressions and keyword clicks per report date."""
    return (view.where(F.col(report_date) >= F.to_date(F.lit(date_from)))
            .groupBy(report_date)
            .agg(F.sum("impressions").cast("bigint").alias("impressions"),
                 F.sum("kw_clicks").cast("bigint").alias("kw_clicks"))
            .select(F.date_format(report_date, "yyyy-MM-dd").alias("report_date"), "impressions", "kw_clicks")
            .orderBy("report_date"))


def distinct_topk(df: DataFrame, column: str, k: int, descending: bool = True,
                  alias: str | None = None) -> DataFrame:
    """DISTINCT values, ordered, first ``k`` (a probe: the limit is the feature).

    Planned as a partial aggregate + TakeOrderedAndProject: each task keeps
    its own top ``k``, so no task ever holds more than ``k`` rows per partition.
    """
    c = F.col(column)
    return (df.select(c.alias(alias or column)).distinct()
            .orderBy(F.col(alias or column).desc() if descending else F.col(alias or column).asc())
            .limit(k))


def project_by_name(df: DataFrame, pattern: str = r"SKU|システム|sku", n: int = 5,
                    rows: int = 5, order: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` columns whose name matches, first ``rows`` rows (ordered to be testable)."""
    cols = [c for c in df.columns if re.search(pattern, c)][:n]
    out = df.select(*cols)
    return out.orderBy(*(order or cols)).limit(rows)
