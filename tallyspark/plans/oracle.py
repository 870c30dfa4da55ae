"""Independent DuckDB SQL for every registered query.

The analogue tables are re-derived here in plain SQL (not generated from the
Spark code), so a wrong derivation on either side shows up as a mismatch.
"""

from __future__ import annotations

from tallyspark.plans import queries as Q

SAFE_DEC = ("CASE WHEN regexp_matches({x}, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)\\s*$') "
            "THEN TRY_CAST(trim({x}) AS DECIMAL(18,2)) END")
SAFE_DBL = ("CASE WHEN regexp_matches({x}, '(?i)^\\s*[+-]?((\\d+\\.?\\d*|\\.\\d+)(e[+-]?\\d+)?|nan|inf|infinity)\\s*$') "
            "THEN TRY_CAST(trim({x}) AS DOUBLE) END")


def sdec(x: str) -> str:
    return SAFE_DEC.format(x=x)


def sdbl(x: str) -> str:
    return SAFE_DBL.format(x=x)


JP = "strftime(d, '%Y年%m月%d日')"

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "orders_a": ((), """
SELECT l_orderkey * 10 + l_linenumber AS line_id,
       upper(substr(p_name, 1, 1)) || replace(substr(p_name, 2), ' ', '-') AS sku,
       CASE WHEN l_quantity = 1 THEN NULL WHEN l_quantity = 2 THEN ''
            ELSE 'Sys-' || CAST(l_partkey AS VARCHAR) END AS sku_system,
       p_name AS product_name,
       strftime(o_orderdate, '%Y-%m-%d') AS order_date,
       CASE WHEN CAST(round(l_discount * 100) AS INTEGER) = 10 THEN 'abc'
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS qty,
       CAST(l_discount AS DECIMAL(4,2)) AS discount,
       CAST(l_tax AS DECIMAL(4,2)) AS tax,
       l_returnflag AS returnflag, o_orderpriority AS priority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""),
    "master_a": ((), """
SELECT upper(substr(p_name, 1, 1)) || replace(substr(p_name, 2), ' ', '-') AS sku,
       'SYS-' || CAST(p_partkey AS VARCHAR) AS sku_system,
       DATE '1995-01-01' AS valid_from,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.4 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS cost,
       CAST(p_size AS DECIMAL(18,2)) AS supplies,
       CAST(CASE WHEN p_type = 'LARGE' THEN 500 ELSE 300 END AS DECIMAL(18,2)) AS shipping
FROM part WHERE p_type <> 'PROMO'
UNION ALL
SELECT upper(substr(p_name, 1, 1)) || replace(substr(p_name, 2), ' ', '-'),
       'SYS-' || CAST(p_partkey AS VARCHAR), DATE '1998-01-01',
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.44 AS DECIMAL(4,2)) AS DECIMAL(18,2)),
       CAST(p_size AS DECIMAL(18,2)),
       CAST(CASE WHEN p_type = 'LARGE' THEN 500 ELSE 300 END AS DECIMAL(18,2))
FROM part WHERE p_type <> 'PROMO' AND p_size > 40"""),
    "pl_lines": (("orders_a",), f"""
SELECT lower(sku_system) AS k, sku, product_name, CAST(order_date AS DATE) AS report_date,
       {sdec('amount')} AS amt, {sdec('qty')} AS q, discount, tax, returnflag, priority
FROM orders_a"""),
    "pl_master": (("master_a",), """
SELECT lower(sku_system) AS mk, valid_from, cost, supplies, shipping,
       lead(valid_from) OVER (PARTITION BY lower(sku_system) ORDER BY valid_from) AS valid_to
FROM master_a"""),
    "pl_sum": (("pl_lines", "pl_master"), """
SELECT report_date, sku, product_name,
       CAST(SUM(amt) AS DECIMAL(20,4)) AS sales,
       CAST(SUM(q) AS DECIMAL(20,4)) AS qty,
       CAST(SUM(COALESCE(cost, 0) * q) AS DECIMAL(20,4)) AS cogs,
       CAST(SUM(COALESCE(supplies, 0) * q) AS DECIMAL(20,4)) AS supplies_cost,
       CAST(SUM(COALESCE(shipping, 0)) AS DECIMAL(20,4)) AS shipping_cost,
       CAST(SUM(amt * 0.10) AS DECIMAL(20,4)) AS fee_cost,
       CAST(SUM(amt * discount) AS DECIMAL(20,4)) AS rpp_cost,
       CAST(SUM(amt * tax) AS DECIMAL(20,4)) AS rppex_cost,
       CAST(SUM(CASE WHEN returnflag = 'R' THEN 100 ELSE 0 END) AS DECIMAL(20,4)) AS review_cost,
       CAST(SUM(amt * 0.01) AS DECIMAL(20,4)) AS point_add_cost,
       CAST(SUM(CASE WHEN priority = '1-URGENT' THEN amt * 0.05 ELSE 0 END) AS DECIMAL(20,4)) AS affi_cost
FROM pl_lines LEFT JOIN pl_master
  ON k = mk AND report_date >= valid_from AND (valid_to IS NULL OR report_date < valid_to)
GROUP BY report_date, sku, product_name"""),
    "pl_a": (("pl_sum",), """
SELECT *, CAST(COALESCE(sales, 0) - (COALESCE(cogs, 0) + COALESCE(supplies_cost, 0) + COALESCE(shipping_cost, 0)
       + COALESCE(fee_cost, 0) + COALESCE(rpp_cost, 0) + COALESCE(rppex_cost, 0) + COALESCE(review_cost, 0)
       + COALESCE(point_add_cost, 0) + COALESCE(affi_cost, 0)) AS DECIMAL(20,4)) AS gross_profit
FROM pl_sum"""),
    "ev": ((), "SELECT *, CAST(ts AS DATE) AS d FROM events"),
    "kw_a": (("ev",), f"""
SELECT event_id AS row_no,
       CASE WHEN event_id % 2 = 0 THEN {JP} || '～' || {JP} ELSE strftime(d, '%Y-%m-%d') END AS date_text,
       'u' || CAST(user_id AS VARCHAR) AS sku, event_type AS kw,
       CASE WHEN event_type = 'error' THEN '' ELSE CAST(CAST(value * 10 AS DECIMAL(12,1)) AS VARCHAR) END AS guide,
       CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS clicks,
       CASE WHEN event_type = 'view' THEN '0.00%'
            ELSE CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || '%' END AS ctr,
       d
FROM ev"""),
    "shohin_a": (("kw_a",), "SELECT row_no, date_text, sku, kw, clicks, ctr, d FROM kw_a WHERE kw IN ('view', 'click')"),
    "rppexp_a": (("ev",), """
SELECT event_id AS row_no, strftime(d, '%Y-%m-%d') AS date_text, 'u' || CAST(user_id AS VARCHAR) AS sku
FROM ev WHERE event_type = 'purchase' AND dayofweek(d) <> 6"""),
    "item_a": (("ev",), """
SELECT event_id AS row_no,
       CASE WHEN event_id % 2 = 0 THEN strftime(d, '%Y-%m-%d') ELSE strftime(d, '%Y/%m/%d') END AS date_text,
       'u' || CAST(user_id AS VARCHAR) AS sku
FROM ev WHERE event_type <> 'error' AND dayofweek(d) <> 0"""),
    "affi_a": ((), """
SELECT CAST(o_orderkey AS VARCHAR) AS order_no,
       strftime(o_orderdate, '%Y-%m-%d') || ' ' || CAST(o_custkey % 24 AS VARCHAR) || ':05:00' AS occurred,
       o_orderstatus AS status
FROM orders"""),
    "daily_g": (("ev",), """
SELECT d, event_type, max(ts) AS last_ts,
       count(*) FILTER (WHERE value < 2) AS n_low,
       CAST(sum(CASE WHEN value < 2 THEN floor(value * 10) END) AS BIGINT) AS cost_low
FROM ev GROUP BY d, event_type"""),
    "daily_a": (("daily_g",), """
SELECT event_type || '/RPP日次12h_' || strftime(d, '%Y%m%d') || '_' || strftime(last_ts, '%Y%m%d_%H%M') || '.csv' AS path,
       CASE WHEN event_type = 'error' THEN 41 ELSE 42 END AS n_cols,
       CASE WHEN event_type = 'signup' THEN CAST(n_low AS VARCHAR) || '.0' ELSE CAST(n_low AS VARCHAR) END AS clicks_text,
       CASE WHEN COALESCE(cost_low, 0) = 0 THEN '' ELSE CAST(cost_low AS VARCHAR) END AS cost_text
FROM daily_g"""),
    "vrd_a": (("ev",), """
SELECT d AS report_date, 'u' || CAST(user_id AS VARCHAR) AS sku,
       count(*) FILTER (WHERE event_type = 'view') AS impressions,
       count(*) FILTER (WHERE event_type = 'click') AS kw_clicks
FROM ev GROUP BY 1, 2"""),
}


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{body}"


PNL_SUMS = """CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS sales, CAST(ROUND(SUM(cogs), 2) AS DOUBLE) AS cogs,
  CAST(ROUND(SUM(supplies_cost), 2) AS DOUBLE) AS supplies, CAST(ROUND(SUM(shipping_cost), 2) AS DOUBLE) AS shipping,
  CAST(ROUND(SUM(fee_cost), 2) AS DOUBLE) AS fee, CAST(ROUND(SUM(rpp_cost), 2) AS DOUBLE) AS rpp,
  CAST(ROUND(SUM(rppex_cost), 2) AS DOUBLE) AS rppex, CAST(ROUND(SUM(review_cost), 2) AS DOUBLE) AS review,
  CAST(ROUND(SUM(point_add_cost), 2) AS DOUBLE) AS point_add, CAST(ROUND(SUM(affi_cost), 2) AS DOUBLE) AS affi,
  CAST(ROUND(SUM(gross_profit), 2) AS DOUBLE) AS gross_profit,
  CAST(ROUND(COALESCE(SUM(cogs), 0) + COALESCE(SUM(supplies_cost), 0) + COALESCE(SUM(shipping_cost), 0)
     + COALESCE(SUM(fee_cost), 0) + COALESCE(SUM(rpp_cost), 0) + COALESCE(SUM(rppex_cost), 0)
     + COALESCE(SUM(review_cost), 0) + COALESCE(SUM(point_add_cost), 0) + COALESCE(SUM(affi_cost), 0), 2) AS DOUBLE) AS total_cost,
  CAST(count(*) FILTER (WHERE cogs = 0 AND sales > 0) AS BIGINT) AS sku_no_cost_count"""

PM_SYSTEMS = "SELECT DISTINCT lower(sku_system) AS sku_system FROM master_a WHERE sku_system IS NOT NULL AND sku_system <> ''"

SQL: dict[str, str] = {
    "unmatched_sku_all": with_ctes(f"""
, pm AS ({PM_SYSTEMS}),
o AS (SELECT lower(sku) AS sku, lower(sku_system) AS sku_system,
             min(order_date) AS first_order_date, max(order_date) AS last_order_date,
             SUM({sdec('amount')}) AS total_sales, SUM({sdbl('qty')}) AS total_qty
      FROM orders_a
      WHERE order_date >= '{Q.SINCE}' AND sku IS NOT NULL AND sku <> '' AND sku_system IS NOT NULL AND sku_system <> ''
      GROUP BY 1, 2)
SELECT o.sku, o.sku_system, first_order_date, last_order_date,
       CAST(ROUND(total_sales, 0) AS DOUBLE) AS total_sales, CAST(total_qty AS DOUBLE) AS total_qty
FROM o LEFT JOIN pm ON o.sku_system = pm.sku_system WHERE pm.sku_system IS NULL
ORDER BY total_sales DESC NULLS LAST""", "orders_a", "master_a").replace("\n, pm AS", ",\npm AS"),
    "match_status_day": with_ctes(f"""
, pm AS ({PM_SYSTEMS}),
o AS (SELECT lower(sku) AS sku, lower(sku_system) AS sku_system,
             SUM({sdec('amount')}) AS sales, SUM({sdbl('qty')}) AS qty
      FROM orders_a WHERE order_date = '{Q.MATCH_DAY}' AND sku IS NOT NULL GROUP BY 1, 2)
SELECT o.sku, o.sku_system, CAST(ROUND(sales, 0) AS DOUBLE) AS sales, CAST(qty AS DOUBLE) AS qty,
       CASE WHEN pm.sku_system IS NOT NULL THEN 'マッチ済' ELSE '★未マッチ★' END AS status
FROM o LEFT JOIN pm ON o.sku_system = pm.sku_system
ORDER BY status DESC, sales DESC NULLS LAST""", "orders_a", "master_a").replace("\n, pm AS", ",\npm AS"),
    "master_listing": with_ctes("""
SELECT lower(sku_system) AS sku_system, sku, CAST(cost AS DOUBLE) AS cost, CAST(supplies AS DOUBLE) AS supplies,
       CAST(shipping AS DOUBLE) AS shipping, CAST(valid_from AS VARCHAR) AS valid_from
FROM master_a ORDER BY sku, valid_from, sku_system""", "master_a"),
    "unit_cost": with_ctes(f"""
SELECT strftime(report_date, '%Y-%m-%d') AS report_date, sku,
       CAST(ROUND(sales, 0) AS DOUBLE) AS sales, CAST(qty AS DOUBLE) AS qty, CAST(ROUND(cogs, 0) AS DOUBLE) AS cogs,
       ROUND(CAST(cogs AS DOUBLE) / NULLIF(CAST(qty AS DOUBLE), 0), 0) AS unit_cost_used
FROM pl_a WHERE sku = '{Q.UNIT_SKU}' AND report_date >= DATE '{Q.UNIT_FROM}' ORDER BY report_date""", "pl_a"),
    "daily_pnl": with_ctes(f"""
SELECT strftime(report_date, '%Y-%m-%d') AS report_date, {PNL_SUMS}
FROM pl_a WHERE report_date >= DATE '{Q.PNL_FROM}' AND report_date <= DATE '{Q.PNL_TO}'
GROUP BY report_date ORDER BY report_date""", "pl_a"),
    "day_pnl": with_ctes(f"""
SELECT strftime(report_date, '%Y-%m-%d') AS report_date, {PNL_SUMS}
FROM pl_a WHERE report_date = DATE '{Q.PNL_DAY}' GROUP BY report_date""", "pl_a"),
    "sku_pnl_day": with_ctes(f"""
SELECT sku, product_name, CAST(ROUND(sales, 0) AS DOUBLE) AS sales, CAST(qty AS DOUBLE) AS qty,
       CAST(ROUND(cogs, 0) AS DOUBLE) AS cogs, CAST(ROUND(supplies_cost, 0) AS DOUBLE) AS supplies,
       CAST(ROUND(shipping_cost, 0) AS DOUBLE) AS shipping, CAST(ROUND(fee_cost, 0) AS DOUBLE) AS fee,
       CAST(ROUND(rpp_cost, 0) AS DOUBLE) AS rpp, CAST(ROUND(rppex_cost, 0) AS DOUBLE) AS rppex,
       CAST(ROUND(gross_profit, 0) AS DOUBLE) AS gross_profit
FROM pl_a WHERE report_date = DATE '{Q.PNL_DAY}' ORDER BY sales DESC NULLS LAST""", "pl_a"),
    "raw_daily_profile": with_ctes(f"""
SELECT left(date_text, 10) AS dt, CAST(count(*) AS BIGINT) AS rows,
       CAST(SUM({sdbl('clicks')}) AS DOUBLE) AS clicks,
       CAST(count(*) FILTER (WHERE {sdbl("replace(replace(ctr, '%', ''), chr(65279), '')")} > 0) AS BIGINT) AS ctr_non_zero
FROM shohin_a WHERE date_text IS NOT NULL AND left(date_text, 10) >= '{Q.RAW_FROM}'
GROUP BY 1 ORDER BY 1""", "shohin_a"),
    "daily_impressions": with_ctes(f"""
SELECT strftime(report_date, '%Y-%m-%d') AS report_date, CAST(SUM(impressions) AS BIGINT) AS impressions,
       CAST(SUM(kw_clicks) AS BIGINT) AS kw_clicks
FROM vrd_a WHERE report_date >= DATE '{Q.RAW_FROM}' GROUP BY report_date ORDER BY 1""", "vrd_a"),
    "distinct_dates_topk": with_ctes("""
SELECT DISTINCT date_text FROM item_a ORDER BY date_text DESC LIMIT 20""", "item_a"),
    "distinct_report_dates": with_ctes("""
SELECT DISTINCT strftime(report_date, '%Y-%m-%d') AS report_date FROM pl_a ORDER BY report_date DESC LIMIT 10""", "pl_a"),
    "distinct_skus_ordered": with_ctes("""
SELECT DISTINCT sku FROM item_a ORDER BY sku LIMIT 10""", "item_a"),
}


# ---- second batch: dates, casts, guard, quality, loads, upsert, alerts ---------

PAT = {
    "rpp_range": r"(\d{4})年(\d{2})月(\d{2})日",
    "jp_range": r"(\d{4})年(\d{1,2})月(\d{1,2})日",
    "datetime_jp": r"(\d{4})/(\d{1,2})/(\d{1,2})",
    "simple": r"^(\d{4})-(\d{2})-(\d{2})$",
}


def nd(x: str, fmt: str) -> str:
    p = PAT[fmt]
    return (f"CASE WHEN {x} IS NOT NULL AND trim({x}) <> '' AND regexp_matches({x}, '{p}') THEN "
            f"regexp_extract({x}, '{p}', 1) || '-' || lpad(regexp_extract({x}, '{p}', 2), 2, '0') || '-' || "
            f"lpad(regexp_extract({x}, '{p}', 3), 2, '0') END")


def nchain(x: str, order) -> str:
    return "COALESCE(" + ", ".join(nd(x, f) for f in order) + ")"


EXISTING = ("rpp_range", "datetime_jp", "simple")
NEW_RPP = ("rpp_range", "datetime_jp", "simple")
EXPANSION = ("jp_range", "rpp_range", "datetime_jp", "simple")
REFRESH = ("rpp_range", "simple")


def mixed(x: str) -> str:
    return (f"COALESCE(CAST(try_strptime(NULLIF(regexp_extract({x}, '^(\\d{{4}}年\\d{{2}}月\\d{{2}}日)', 1), ''), "
            f"'%Y年%m月%d日') AS DATE), CAST(try_strptime(substr({x}, 1, 10), '%Y-%m-%d') AS DATE))")


def iso_first(x: str) -> str:
    return (f"COALESCE(CAST(try_strptime(substr({x}, 1, 10), '%Y-%m-%d') AS DATE), "
            f"CAST(try_strptime(NULLIF(regexp_extract({x}, '(\\d{{4}}年\\d{{2}}月\\d{{2}}日)', 1), ''), "
            f"'%Y年%m月%d日') AS DATE))")


def iso_or_slash(x: str) -> str:
    return (f"COALESCE(CAST(try_strptime({x}, '%Y-%m-%d') AS DATE), "
            f"CAST(try_strptime({x}, '%Y/%m/%d') AS DATE))")


def iso_only(x: str) -> str:
    return f"CAST(try_strptime({x}, '%Y-%m-%d') AS DATE)"


def sint(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '^\\s*[+-]?\\d+\\s*$') THEN TRY_CAST(trim({x}) AS BIGINT) END"


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


CTES.update({
    "spell": (("ev",), f"""
SELECT event_id AS row_no,
  CASE event_id % 6
    WHEN 0 THEN {JP} || '～' || {JP}
    WHEN 1 THEN strftime(d, '%Y-%m-%d')
    WHEN 2 THEN CAST(year(d) AS VARCHAR) || '/' || CAST(month(d) AS VARCHAR) || '/' || CAST(day(d) AS VARCHAR)
                || ' ' || CAST(hour(ts) AS VARCHAR) || ':' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0')
    WHEN 3 THEN CAST(year(d) AS VARCHAR) || '年' || CAST(month(d) AS VARCHAR) || '月' || CAST(day(d) AS VARCHAR) || '日'
    WHEN 4 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    ELSE CASE WHEN event_type = 'error' THEN '合計' ELSE strftime(d, '%Y/%m/%d') END
  END AS text
FROM ev"""),
    "casts": ((), """
SELECT event_id AS row_no,
  CASE event_id % 5
    WHEN 0 THEN CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR)
    WHEN 1 THEN format('{:,.2f}', value * 100)
    WHEN 2 THEN chr(65279) || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || '%'
    WHEN 3 THEN CASE WHEN event_type = 'error' THEN 'abc' ELSE CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || 'd' END
    ELSE ' ' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || ' '
  END AS text
FROM events"""),
    "kw_hist": (("kw_a",), "SELECT * FROM kw_a WHERE d < DATE '2024-01-25'"),
    "kw_new": (("kw_a",), "SELECT * FROM kw_a WHERE d >= DATE '2024-01-25'"),
    "base_rows": (("kw_hist",), f"""
SELECT sku, kw, {sdbl('guide')} AS g, {iso_first('date_text')} AS bd, row_no
FROM kw_hist
WHERE guide IS NOT NULL AND guide <> '' AND {sdbl('guide')} IS NOT NULL
  AND {iso_first('date_text')} >= DATE '2024-01-31' - 30"""),
    "base": (("base_rows",), """
SELECT sku, kw, g AS prior, bd AS prior_date FROM (
  SELECT *, row_number() OVER (PARTITION BY sku, kw ORDER BY bd DESC, row_no DESC) AS rn FROM base_rows)
WHERE rn = 1"""),
    "flagged": (("kw_new", "base"), f"""
SELECT n.*, b.prior, {sdbl("replace(n.guide, ',', '')")} AS nv
FROM kw_new n LEFT JOIN base b ON trim(n.sku) = b.sku AND trim(n.kw) = b.kw"""),
    "spk": (("flagged",), """
SELECT *, COALESCE(nv IS NOT NULL AND NOT isnan(nv) AND prior IS NOT NULL AND NOT isnan(prior)
                   AND prior >= 40 AND nv > prior * 3.0 AND nv - prior > 150, false) AS spike
FROM flagged"""),
    "present": (("shohin_a", "kw_a", "rppexp_a", "item_a"), f"""
SELECT DISTINCT 'raw_shohin_betsu' AS tbl, {mixed('date_text')} AS d FROM shohin_a
UNION SELECT DISTINCT 'raw_keyword', {mixed('date_text')} FROM kw_a
UNION SELECT DISTINCT 'raw_rppexp', CAST(try_strptime(substr(date_text, 1, 10), '%Y-%m-%d') AS DATE) FROM rppexp_a
UNION SELECT DISTINCT 'raw_item', {iso_or_slash('date_text')} FROM item_a"""),
    "status": (("present",), """
SELECT strftime(g.d, '%Y-%m-%d') AS d, g.tbl, p.tbl IS NOT NULL AS present
FROM (SELECT CAST(x AS DATE) AS d, t.tbl
      FROM generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) s(x),
           (VALUES ('raw_shohin_betsu'), ('raw_keyword'), ('raw_rppexp'), ('raw_item')) t(tbl)) g
LEFT JOIN present p ON g.d = p.d AND g.tbl = p.tbl"""),
    "dtot_v": (("daily_a",), f"""
SELECT regexp_extract(base, '_(\\d{{8}})_(\\d{{8}})_(\\d{{4}})\\.csv$', 1) AS ymd,
       regexp_extract(base, '_(\\d{{8}})_(\\d{{8}})_(\\d{{4}})\\.csv$', 2)
         || regexp_extract(base, '_(\\d{{8}})_(\\d{{8}})_(\\d{{4}})\\.csv$', 3) AS stamp,
       path, {sint("COALESCE(NULLIF(clicks_text, ''), '0')")} AS clicks,
       {sint("COALESCE(NULLIF(cost_text, ''), '0')")} AS cost
FROM (SELECT *, regexp_extract(path, '[^/]*$', 0) AS base FROM daily_a)
WHERE regexp_matches(base, '_(\\d{{8}})_(\\d{{8}})_(\\d{{4}})\\.csv$') AND n_cols = 42"""),
    "dtot": (("dtot_v",), """
SELECT ymd, clicks, cost FROM (
  SELECT *, row_number() OVER (PARTITION BY ymd ORDER BY stamp DESC, path DESC) AS rn
  FROM dtot_v WHERE clicks IS NOT NULL AND cost IS NOT NULL) WHERE rn = 1"""),
    "zero": (("dtot",), """
SELECT strftime(CAST(x AS DATE), '%Y-%m-%d') AS d, CAST(b.clicks AS DOUBLE) AS clicks, CAST(b.cost AS DOUBLE) AS cost,
       COALESCE(b.clicks = 0 AND b.cost = 0, false) AS is_zero, b.clicks IS NOT NULL AS known
FROM generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) s(x)
LEFT JOIN dtot b ON strftime(CAST(x AS DATE), '%Y%m%d') = b.ymd"""),
    "li": ((), f"""
SELECT l_orderkey * 10 + l_linenumber AS row_no,
       CASE WHEN l_linenumber % 2 = 0 THEN {JP} || '～' || {JP} ELSE strftime(d, '%Y-%m-%d') END AS date_text,
       CASE WHEN l_linenumber = 1 THEN ' ' || CAST(l_orderkey AS VARCHAR) || ' ' ELSE CAST(l_orderkey AS VARCHAR) END AS order_no,
       'p' || CAST(l_partkey AS VARCHAR) AS item, l_returnflag AS flag
FROM (SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem)"""),
    "li_t": (("li",), "SELECT * FROM li WHERE flag = 'R'"),
    "li_r": (("li",), "SELECT * FROM li WHERE flag <> 'R'"),
    "fb_rows": (("kw_a",), """
SELECT k.*, e.ts, k.kw || '_w' || CAST(weekofyear(k.d) AS VARCHAR) AS file
FROM kw_a k JOIN events e ON e.event_id = k.row_no WHERE k.kw <> 'error'"""),
    "fb_ranked": (("fb_rows",), """
SELECT file, row_number() OVER (ORDER BY mtime, file) AS file_rank
FROM (SELECT file, max(ts) AS mtime FROM fb_rows GROUP BY file)"""),
    "up_target": (("kw_a",), "SELECT CAST(row_no AS VARCHAR) AS row_no, date_text, sku, kw, guide, clicks FROM kw_a"),
    "up_staged": (("kw_a",), """
SELECT CAST(k.row_no + 1000000 AS VARCHAR) AS row_no, strftime(k.d, '%Y-%m-%d') AS date_text, k.sku, k.kw,
       CAST(CAST(e.value AS DECIMAL(10,2)) * 11 AS VARCHAR) AS guide
FROM kw_a k JOIN events e ON e.event_id = k.row_no
WHERE k.d >= DATE '2024-01-17' AND k.d <= DATE '2024-01-30'"""),
    "listing": (("ev",), """
SELECT CASE WHEN event_type = 'error'
            THEN 'rpp_reports/RPP商品別12h_summary_' || CAST(event_id AS VARCHAR) || '.csv'
            ELSE 'rpp_reports/RPP商品別12h_' || strftime(d, '%Y%m%d') || '_' || strftime(ts, '%H%M%S') || '_'
                 || CAST(event_id AS VARCHAR) || '.csv' END AS path,
       ts AS mtime
FROM ev"""),
    "latest": (("listing",), """
SELECT d8, path, strftime(mtime, '%Y-%m-%d %H:%M:%S.%f') AS mtime FROM (
  SELECT *, row_number() OVER (PARTITION BY d8 ORDER BY mtime DESC, path DESC) AS rn FROM (
    SELECT *, NULLIF(regexp_extract(regexp_extract(path, '[^/\\\\]*$', 0), '_(\\d{8})_', 1), '') AS d8 FROM listing)
  WHERE d8 IS NOT NULL) WHERE rn = 1"""),
    "alert_sets": (("status",), """
SELECT d, list_sort(list_distinct(list(label))) AS labels,
       list_sort(list_distinct(list(regexp_extract(label, '^[^(\\s]*', 0)))) AS names
FROM (SELECT d, tbl AS label FROM status WHERE NOT present) GROUP BY d"""),
    "alert_sets2": (("alert_sets",), "SELECT *, substr(md5(array_to_string(names, '|')), 1, 8) AS digest FROM alert_sets"),
    "alert_led": (("alert_sets2",), """
SELECT DISTINCT target, digest FROM (
  SELECT d AS target, digest, CAST(d AS TIMESTAMP) + INTERVAL 1 DAY + INTERVAL 15 HOUR + INTERVAL 30 MINUTE AS sent_at
  FROM alert_sets2 WHERE d >= '2024-01-25')
WHERE sent_at >= TIMESTAMP '{now}' - INTERVAL 7 DAY"""),
})


def _alert_sql(now: str, order: str) -> str:
    exempt = ("len(s.names) > 0 AND list_has_all(['raw_shohin_betsu', 'raw_keyword'], s.names) "
              "AND COALESCE(z.is_zero, false)")
    early = f"hour(TIMESTAMP '{now}') < 15"
    if order == "hour_first":
        case = (f"CASE WHEN len(s.names) = 0 THEN 'complete' WHEN {early} THEN 'hold' "
                f"WHEN {exempt} THEN 'exempt_zero_delivery' WHEN l.target IS NOT NULL THEN 'already_sent' ELSE 'send' END")
    else:
        case = (f"CASE WHEN len(s.names) = 0 THEN 'complete' WHEN {exempt} THEN 'exempt_zero_delivery' "
                f"WHEN {early} THEN 'hold' WHEN l.target IS NOT NULL THEN 'already_sent' ELSE 'send' END")
    body = f"""
SELECT s.d, array_to_string(s.labels, ',') AS missing, s.digest, {case} AS decision
FROM alert_sets2 s LEFT JOIN zero z ON s.d = z.d LEFT JOIN alert_led l ON s.d = l.target AND s.digest = l.digest"""
    return with_ctes(body, "alert_sets2", "zero", "alert_led").replace("{now}", now)


def _missing_sql(not_in: bool) -> str:
    parts, names = [], []
    specs = [("raw_item", "item_a", iso_or_slash), ("raw_shohin_betsu", "shohin_a", mixed),
             ("raw_keyword", "kw_a", mixed)]
    for tbl, src, parse in specs:
        names.append(src)
        if not_in:
            present = (f"SELECT DISTINCT {iso_only('date_text')} AS pd FROM {src} "
                       f"WHERE date_text IS NOT NULL AND date_text <> ''")
        else:
            present = f"SELECT DISTINCT {parse('date_text')} AS pd FROM {src} WHERE {parse('date_text')} IS NOT NULL"
        m = (f"SELECT '{tbl}' AS tbl, strftime(md, '%Y-%m-%d') AS missing_date, 'missing' AS state FROM spine "
             f"WHERE md NOT IN ({present})")
        parts.append(f"m_{tbl} AS ({m})")
    body_parts = []
    for tbl, _, _ in specs:
        body_parts.append(f"SELECT * FROM m_{tbl}")
        body_parts.append(f"SELECT '{tbl}', NULL, 'none' WHERE NOT EXISTS (SELECT 1 FROM m_{tbl})")
    spine = ("spine AS (SELECT CAST(x AS DATE) AS md FROM "
             "generate_series(DATE '2024-01-24', DATE '2024-01-30', INTERVAL 1 DAY) s(x))")
    head = with_ctes("", *names)
    return head + ",\n" + spine + ",\n" + ",\n".join(parts) + "\n" + "\nUNION ALL ".join(body_parts)


PROFILE_COLS = [("line_id", "bigint"), ("sku", "string"), ("sku_system", "string"), ("product_name", "string"),
                ("order_date", "string"), ("amount", "string"), ("qty", "string"), ("discount", "decimal(4,2)"),
                ("tax", "decimal(4,2)"), ("returnflag", "string"), ("priority", "string")]


def _profile_sql() -> str:
    parts = []
    for c, t in PROFILE_COLS:
        parts.append(f"""SELECT '{c}' AS "column", '{t}' AS type, CAST(count(*) AS BIGINT) AS rows,
  CAST(count(*) FILTER (WHERE v IS NOT NULL AND trim(v) <> '') AS BIGINT) AS non_blank,
  CAST(count(DISTINCT v) AS BIGINT) AS distinct_values,
  CAST(count(*) FILTER (WHERE {sdbl('v')} IS NOT NULL) AS BIGINT) AS numeric,
  min(v) AS min_value, max(v) AS max_value
FROM (SELECT CAST({c} AS VARCHAR) AS v FROM orders_a)""")
    return with_ctes("\n" + "\nUNION ALL\n".join(parts), "orders_a")


SQL.update({
    "parse_dates": with_ctes(f"""
SELECT row_no, text,
  {nchain('text', NEW_RPP)} AS norm_new,
  {nchain('text', EXISTING)} AS norm_existing,
  {nchain('text', EXPANSION)} AS norm_expansion,
  {nchain('text', REFRESH)} AS norm_refresh,
  {iso(mixed('text'))} AS mixed,
  {iso(iso_first('text'))} AS mixed_iso_first,
  {iso(iso_or_slash('text'))} AS iso_or_slash
FROM spell""", "spell"),
    "safe_casts": with_ctes(f"""
SELECT row_no, text, {sdbl('text')} AS as_double,
  {sdbl("replace(text, ',', '')")} AS comma_float,
  {sdbl("replace(replace(text, '%', ''), chr(65279), '')")} AS pct_value,
  CAST({sint("regexp_replace(text, '\\.\\d*$', '')")} AS DOUBLE) AS as_int
FROM casts""", "casts"),
    "baseline_latest": with_ctes("SELECT sku, kw, prior, strftime(prior_date, '%Y-%m-%d') AS prior_date FROM base", "base"),
    "spike_guard": with_ctes("""
SELECT row_no, date_text, sku, kw, CASE WHEN spike THEN '' ELSE guide END AS guide FROM spk""", "spk"),
    "spike_report": with_ctes("""
SELECT row_no, sku, kw, prior, nv AS new_value, nv / prior AS ratio FROM spk WHERE spike
ORDER BY nv / prior DESC, row_no LIMIT 10""", "spk"),
    "spike_log": with_ctes("""
SELECT row_no, sku, kw, round(nv / prior, 1) AS ratio_1dp FROM spk WHERE spike
ORDER BY nv / prior DESC, row_no LIMIT 10""", "spk"),
    "spike_summary": with_ctes("""
SELECT count(*) AS new_rows, count(prior) AS with_baseline, count(*) FILTER (WHERE spike) AS spikes,
       count(DISTINCT CASE WHEN spike THEN trim(sku) || chr(1) || trim(kw) END) AS spike_keys
FROM spk""", "spk"),
    "missing_dates": _missing_sql(False),
    "missing_dates_not_in": _missing_sql(True),
    "completeness_status": with_ctes("SELECT * FROM status", "status"),
    "completeness_verdict": with_ctes("""
SELECT d, CAST(count(*) FILTER (WHERE NOT present) AS BIGINT) AS n_missing,
       COALESCE(string_agg(tbl, ',' ORDER BY tbl) FILTER (WHERE NOT present), '') AS missing_list,
       count(*) FILTER (WHERE NOT present) = 0 AS complete
FROM status GROUP BY d""", "status"),
    "data_age": with_ctes("\n" + "\nUNION ALL\n".join(f"""
SELECT '{tbl}' AS tbl, newest, CAST(DATE '2024-01-31' - nd AS BIGINT) AS age_days,
  CASE WHEN n = 0 THEN 'no_data' WHEN nd IS NULL THEN 'data_check_failed'
       WHEN DATE '2024-01-31' - nd >= 2 THEN 'data_stale' ELSE 'ok' END AS state
FROM (SELECT newest, n, CAST(try_strptime(newest, '%Y-%m-%d') AS DATE) AS nd FROM (
  SELECT max(CASE WHEN regexp_matches(substr({col}, 1, 10), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN substr({col}, 1, 10) END) AS newest, count(*) AS n
  FROM {src}))""" for tbl, src, col in [("raw_affi", "affi_a", "occurred"), ("raw_rppexp", "rppexp_a", "date_text"),
                                        ("raw_item", "item_a", "date_text")]), "affi_a", "rppexp_a", "item_a"),
    "freshness": """
SELECT tbl, strftime(m, '%Y-%m-%d %H:%M:%S') AS modified,
       CAST((epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(m)) // 60000000 AS BIGINT) AS age_minutes,
       CASE WHEN epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(m) > CAST(129600000000 AS BIGINT) THEN 'stale' ELSE 'fresh' END AS state
FROM (SELECT 'raw_' || event_type AS tbl,
             max(CASE WHEN event_type = 'error' THEN ts - INTERVAL 2 DAY ELSE ts END) AS m
      FROM events GROUP BY 1)""",
    "zero_delivery": with_ctes("SELECT * FROM zero", "zero"),
    "maturation_uplift": """
WITH p AS (SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS d, hour(ts) AS h FROM events WHERE event_type = 'purchase'),
f AS (SELECT d, count(*) AS frozen FROM p WHERE h < 12 GROUP BY d),
m AS (SELECT d, count(*) AS matured FROM p GROUP BY d),
j AS (SELECT COALESCE(f.d, m.d) AS d, COALESCE(frozen, 0) AS fz, COALESCE(matured, 0) AS mt FROM f FULL JOIN m ON f.d = m.d)
SELECT d, CAST(fz AS BIGINT) AS frozen, CAST(mt AS BIGINT) AS matured, CAST(mt - fz AS BIGINT) AS diff,
       CAST(mt - fz AS DOUBLE) / NULLIF(CAST(fz AS DOUBLE), 0) * 100 AS uplift_pct,
       CAST(mt - fz AS DOUBLE) / NULLIF(CAST(mt AS DOUBLE), 0) * 100 AS short_pct
FROM j""",
    "dedup_by_date": with_ctes(f"""
SELECT row_no, nd AS date_text FROM (SELECT row_no, {nchain('date_text', NEW_RPP)} AS nd FROM li_r)
WHERE nd IS NOT NULL AND nd NOT IN (
  SELECT DISTINCT {nchain('date_text', EXISTING)} FROM li_t WHERE {nchain('date_text', EXISTING)} IS NOT NULL)""",
                               "li_r", "li_t"),
    "dedup_by_key": with_ctes("""
SELECT row_no, trim(order_no) AS order_no FROM li_r
WHERE trim(order_no) NOT IN (SELECT DISTINCT order_no FROM li_t)""", "li_r", "li_t"),
    "dedup_by_composite": with_ctes(f"""
SELECT row_no, nd AS date_text, item FROM (
  SELECT row_no, {nchain('date_text', EXPANSION)} AS nd, trim(item) AS item FROM li_r) r
WHERE nd IS NOT NULL AND NOT EXISTS (SELECT 1 FROM li_t t WHERE t.date_text = r.nd AND t.item = r.item)""",
                                    "li_r", "li_t"),
    "first_writer_wins": with_ctes(f"""
, r AS (SELECT fb_rows.row_no, fb_rows.file, fb_ranked.file_rank, {nchain('fb_rows.date_text', NEW_RPP)} AS nd
        FROM fb_rows JOIN fb_ranked USING (file)),
ex AS (SELECT DISTINCT {nchain('date_text', EXISTING)} AS nd FROM kw_a WHERE kw = 'error' AND d <= DATE '2024-01-07'),
r3 AS (SELECT * FROM r WHERE nd IS NOT NULL AND nd NOT IN (SELECT nd FROM ex WHERE nd IS NOT NULL)),
w AS (SELECT nd, min(file_rank) AS win FROM r3 GROUP BY nd)
SELECT r3.row_no, r3.file, r3.nd AS date_text FROM r3 JOIN w ON r3.nd = w.nd AND r3.file_rank = w.win""",
                                   "fb_rows", "fb_ranked", "kw_a").replace("\n, r AS", ",\nr AS"),
    "replace_by_date": with_ctes(f"""
, sd AS (SELECT DISTINCT {iso_only('substr(date_text, 1, 10)')} AS sd FROM up_staged)
SELECT * FROM up_target t WHERE NOT EXISTS (SELECT 1 FROM sd WHERE sd.sd = {mixed('t.date_text')})
UNION ALL
SELECT row_no, date_text, sku, kw, guide, NULL AS clicks FROM up_staged""", "up_target", "up_staged")
        .replace("\n, sd AS", ",\nsd AS"),
    "attribution_refresh": with_ctes(f"""
, st AS (SELECT row_no, CASE WHEN CAST(row_no AS BIGINT) % 97 = 0 THEN '合計' ELSE date_text END AS date_text, sku, kw, guide FROM up_staged),
sd AS (SELECT DISTINCT {iso_only('substr(date_text, 1, 10)')} AS sd FROM st)
SELECT 'table' AS part, row_no, date_text, sku, kw, guide, clicks, strftime({mixed('t.date_text')}, '%Y-%m-%d') AS pdate
FROM up_target t WHERE NOT EXISTS (SELECT 1 FROM sd WHERE sd.sd = {mixed('t.date_text')})
UNION ALL
SELECT CASE WHEN date_text = '合計' THEN 'rejected' ELSE 'table' END, row_no, date_text, sku, kw, guide, NULL AS clicks,
       CASE WHEN date_text <> '合計' THEN date_text END
FROM st""", "up_target", "up_staged").replace("\n, st AS", ",\nst AS"),
    "upsert_plan": with_ctes(f"""
SELECT count(DISTINCT sd) AS n_dates, strftime(min(sd), '%Y-%m-%d') AS first_date,
       strftime(max(sd), '%Y-%m-%d') AS last_date, count(*) AS rows
FROM (SELECT {iso_only('substr(date_text, 1, 10)')} AS sd FROM up_staged)""", "up_staged"),
    "latest_per_date": with_ctes("SELECT * FROM latest", "latest"),
    "refresh_window_files": with_ctes("""
SELECT * FROM latest WHERE d8 IN (
  SELECT strftime(DATE '2024-01-31' - CAST(i AS INTEGER), '%Y%m%d') FROM range(1, 15) t(i))""", "latest"),
    "backfill_range": with_ctes("""
SELECT path, target_date FROM (
  SELECT path, split_part(replace(replace(regexp_extract(path, '[^/\\\\]*$', 0), 'RPP日次12h_', ''), '.csv', ''), '_', 1)
         AS target_date FROM daily_a)
WHERE target_date >= strftime(DATE '2024-01-31' - 7, '%Y%m%d')""", "daily_a"),
    "file_presence": """
WITH l AS (
  SELECT CASE WHEN event_type = 'click' THEN 'RPPキーワード別12h_'
              WHEN event_type = 'view' THEN 'RPP商品別12h_'
              WHEN event_type = 'purchase' THEN 'RPPEXP商品別_'
              WHEN event_type = 'signup' AND dayofweek(ts) <> 0 THEN '店舗カルテ_商品ページ分析_'
              ELSE 'other_' END || strftime(ts, '%Y%m%d_%H%M') || '.csv' AS name,
         CAST(ts AS DATE) AS d
  FROM events),
k AS (SELECT * FROM (VALUES ('KW実績', '^RPPキーワード別12h_.*\\.csv$'), ('商品別RPP', '^RPP商品別12h_.*\\.csv$'),
                            ('RPP費用', '^RPPEXP商品別_.*\\.csv$'), ('カルテ', '^店舗カルテ_商品ページ分析_.*\\.csv$')) t(label, pat)),
hits AS (SELECT DISTINCT l.d, k.label FROM l JOIN k ON regexp_matches(l.name, k.pat)
         WHERE l.d BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'),
grid AS (SELECT CAST(x AS DATE) AS d, k.label FROM generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) s(x), k)
SELECT strftime(grid.d, '%Y-%m-%d') AS d, grid.label, hits.label IS NOT NULL AS present
FROM grid LEFT JOIN hits ON grid.d = hits.d AND grid.label = hits.label""",
    "orders_view": with_ctes("""
SELECT line_id, sku, sku_system, product_name, order_date, amount, qty, CAST(discount AS DOUBLE) AS discount,
       CAST(tax AS DOUBLE) AS tax, returnflag, priority
FROM orders_a""", "orders_a"),
    "schema_evolve": with_ctes("""
SELECT line_id, sku, order_date, CAST(NULL AS VARCHAR) AS "注文時間" FROM orders_a""", "orders_a"),
    "target_month": """
SELECT strftime(od, '%Y-%m-%d') AS order_date,
       strftime(CASE WHEN day(od) = 1 THEN od - 1 ELSE od END, '%Y-%m') AS target_month
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS od FROM orders)""",
    "trailing_window": """
WITH a AS (SELECT max(CAST(o_orderdate AS DATE)) + 1 AS as_of FROM orders)
SELECT strftime(as_of - CAST(i AS INTEGER), '%Y-%m-%d') AS d FROM a, range(1, 15) t(i)""",
    "column_profile": _profile_sql(),
    "column_probe": with_ctes("""
SELECT sku, sku_system FROM orders_a ORDER BY sku NULLS FIRST, sku_system NULLS FIRST LIMIT 5""", "orders_a"),
    "alert_policy": _alert_sql("2024-01-31 16:00:00", "hour_first"),
    "alert_policy_files": _alert_sql("2024-01-31 10:00:00", "exempt_first"),
})


# Q10 over files: one pair of CTEs per day-file, each flagged against the state its predecessor left
_SPIKE = ("COALESCE(nv IS NOT NULL AND NOT isnan(nv) AND prior IS NOT NULL AND NOT isnan(prior) "
          "AND prior >= 40 AND nv > prior * 3.0 AND nv - prior > 150, false)")
CTES["state_0"] = (("base_rows",), """
SELECT sku, kw, g, bd, row_no FROM (
  SELECT *, row_number() OVER (PARTITION BY sku, kw ORDER BY bd DESC, row_no DESC) AS rn FROM base_rows) WHERE rn = 1""")
_FILES = range(1, 7)          # the days 2024-01-25 .. 2024-01-30
for _k in _FILES:
    CTES[f"file_{_k}"] = (("kw_new", f"state_{_k - 1}"), f"""
SELECT *, {_SPIKE} AS spike FROM (
  SELECT n.*, b.g AS prior, {sdbl("replace(n.guide, ',', '')")} AS nv
  FROM kw_new n LEFT JOIN state_{_k - 1} b ON trim(n.sku) = b.sku AND trim(n.kw) = b.kw
  WHERE n.d = DATE '2024-01-24' + {_k})""")
    CTES[f"state_{_k}"] = ((f"file_{_k}", f"state_{_k - 1}"), f"""
SELECT sku, kw, g, bd, row_no FROM (
  SELECT *, row_number() OVER (PARTITION BY sku, kw ORDER BY bd DESC, row_no DESC) AS rn FROM (
    SELECT * FROM state_{_k - 1} UNION ALL
    SELECT sku, kw, {sdbl('guide')} AS g, {iso_first('date_text')} AS bd, row_no FROM file_{_k}
    WHERE NOT spike AND guide IS NOT NULL AND guide <> '' AND {sdbl('guide')} IS NOT NULL
      AND {iso_first('date_text')} >= DATE '2024-01-31' - 30)) WHERE rn = 1""")
SQL["spike_guard_multi_file"] = with_ctes("\nUNION ALL\n".join(
    f"SELECT row_no, date_text, sku, kw, CASE WHEN spike THEN '' ELSE guide END AS guide, {_k} AS file_rank FROM file_{_k}"
    for _k in _FILES), *[f"file_{_k}" for _k in _FILES])


# readers on in-memory report files: the parsed cells are the cells the files were made of
_NA = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
       "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")


def _cell(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} IN ({_NA}) THEN '' ELSE {c} END"


SQL["report_ingest"] = with_ctes(f"""
SELECT row_no, strftime(d, '%Y-%m-%d') AS date_text, {_cell('sku')} AS sku, kw || ' "a", \\' AS kw, {_cell('guide')} AS guide
FROM kw_a WHERE d <> DATE '2024-01-05'""", "kw_a")
SQL["report_records"] = with_ctes(f"""
SELECT row_no, {_cell('date_text')} AS date_text, {_cell('sku')} AS sku,
       kw || CASE WHEN row_no % 7 = 0 THEN ' "a",' || chr(13) || chr(10) || ' b'
                  WHEN row_no % 5 = 0 THEN chr(10) || 'line, ' || chr(10) || chr(10) || ' end' ELSE '' END AS kw,
       {_cell('guide')} AS guide
FROM kw_a""", "kw_a")
SQL["affiliate_ingest"] = with_ctes("""
SELECT order_no, occurred, 'n, "x"' AS name, CAST(length(occurred) AS VARCHAR) AS amount, '' AS reward, status, 'pending_6.csv' AS path
FROM affi_a WHERE CAST(order_no AS BIGINT) % 10 = 6 AND CAST(order_no AS BIGINT) % 3 <> 0""", "affi_a")
SQL["affiliate_status"] = with_ctes("""
SELECT 'pending_' || k || '.csv' AS path, CASE WHEN k IN ('0', '6') THEN 'ok' ELSE 'rejected' END AS state,
       CASE k WHEN '7' THEN 'columns 12 < 13' WHEN '8' THEN 'quoted line break' WHEN '9' THEN 'no data lines' END AS reason
FROM (SELECT DISTINCT CASE WHEN CAST(order_no AS BIGINT) % 10 < 6 THEN '0' ELSE CAST(CAST(order_no AS BIGINT) % 10 AS VARCHAR) END AS k FROM affi_a)""", "affi_a")
_EXPANSION = """
WITH e AS (SELECT event_id, CAST(ts AS DATE) AS day, 'u' || CAST(user_id % 50 AS VARCHAR) AS item, user_id % 50 AS u,
                  CASE WHEN event_id % 3 = 0 THEN '1000' ELSE '0900' END AS gen
           FROM events WHERE event_type = 'purchase'),
f AS (SELECT *, 'RPPEXP商品別_' || strftime(day, '%Y%m%d') || '_' || gen || '.csv' AS path FROM e)"""
SQL["expansion_ingest"] = _EXPANSION + """,
t AS (SELECT DISTINCT day, item FROM e WHERE day <= DATE '2024-01-07' AND u % 2 = 0),
new AS (SELECT * FROM f WHERE day <> DATE '2024-01-05' AND NOT EXISTS (SELECT 1 FROM t WHERE t.day = f.day AND t.item = f.item)),
won AS (SELECT day, item, min(gen) AS gen FROM new GROUP BY 1, 2)
SELECT strftime(new.day, '%Y-%m-%d') AS date_text, new.item, CAST(event_id AS VARCHAR) AS amount, path
FROM new JOIN won ON won.day = new.day AND won.item = new.item AND won.gen = new.gen"""
SQL["expansion_status"] = _EXPANSION + """
SELECT DISTINCT path, CASE WHEN day = DATE '2024-01-05' THEN 'rejected' ELSE 'ok' END AS state,
       CASE WHEN day = DATE '2024-01-05' THEN 'columns 3 < 18' END AS reason FROM f"""
SQL["report_status"] = with_ctes("""
SELECT 'RPPキーワード別12h_' || strftime(d, '%Y%m%d') || '_0900.csv' AS path,
       CASE WHEN d = DATE '2024-01-05' THEN 'rejected' ELSE 'ok' END AS state,
       CASE WHEN d = DATE '2024-01-05' THEN 'fields 6 > 5' END AS reason, CAST(0 AS BIGINT) AS replaced_chars
FROM (SELECT DISTINCT d FROM kw_a)""", "kw_a")
SQL["new_files"] = """
SELECT path, size FROM (
  SELECT event_type || '_' || strftime(ts, '%Y%m%d') || '.csv' AS path, max(ts) AS mtime,
         CAST(count(*) FILTER (WHERE hour(ts) < 20) AS BIGINT) AS size
  FROM events GROUP BY 1)
WHERE mtime >= TIMESTAMP '2024-01-20 00:00:00' AND size > 0 AND NOT starts_with(path, 'view')"""

# Q11: raw_item has rows but no readable date (failed), raw_review is empty, raw_affi is old in both ways
CTES["affi_fresh"] = ((), """
SELECT (epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(max(ts) - INTERVAL 2 DAY)) AS us FROM events WHERE event_type = 'error'""")
CTES["affi_newest"] = (("affi_a",), """
SELECT max(CASE WHEN regexp_matches(substr(occurred, 1, 10), '^\\d{4}-\\d{2}-\\d{2}$') THEN substr(occurred, 1, 10) END) AS newest FROM affi_a""")
CTES["wrong"] = (("status", "affi_fresh", "affi_newest"), """
SELECT d, tbl AS label FROM status WHERE NOT present
UNION ALL SELECT s.d, 'raw_affi(stale ' || printf('%.1f', (us // 60000000) / 60.0) || 'h)'
  FROM (SELECT DISTINCT d FROM status) s, affi_fresh WHERE us > 36 * CAST(3600000000 AS BIGINT)
UNION ALL SELECT s.d, 'raw_affi(data_stale ' || CAST(DATE '2024-01-31' - CAST(newest AS DATE) AS VARCHAR) || 'd, newest=' || newest || ')'
  FROM (SELECT DISTINCT d FROM status) s, affi_newest WHERE DATE '2024-01-31' - CAST(newest AS DATE) >= 2
UNION ALL SELECT DISTINCT d, 'raw_review(no_data)' FROM status
UNION ALL SELECT d, 'raw_item(data_check_failed)' FROM status WHERE tbl = 'raw_item' AND present""")
SQL["day_verdict"] = with_ctes("""
SELECT d.d, COALESCE(string_agg(w.label, ',' ORDER BY w.label), '') AS labels, count(w.label) AS n_wrong, count(w.label) = 0 AS complete
FROM (SELECT DISTINCT d FROM status) d LEFT JOIN wrong w ON w.d = d.d GROUP BY d.d""", "status", "wrong")


# Q7-Q9 replayed: one recursion step per run of a (target, digest)
def _replay_cte(kind: str, kinds: str, hours: int, runs: str, first: int, days: int, missing: str, names: str, zero_day: str, exempt: str, order: str) -> str:
    exempted = f"WHEN list_has_all([{exempt}], names) AND COALESCE(is_zero, false) THEN 'exempt_zero_delivery'"
    early = "WHEN hour < 15 THEN 'hold'"
    return f"""
{kind}_a AS (
  SELECT CAST(ts AS DATE) AS day, CASE event_type {kinds} END AS label, sum(event_id) % CASE WHEN event_type = 'error' THEN 1000 ELSE {hours} END AS h
  FROM events GROUP BY 1, 2, event_type HAVING label IS NOT NULL),
{kind}_r AS (
  SELECT day, k, hour, (k + {first} - 1) * 24 + hour AS after, (k * 7 + hour) % 5 <> 0 AS ok
  FROM (SELECT DISTINCT day FROM {kind}_a), range({days}) t(k), (SELECT unnest([{runs}]) AS hour)),
{kind}_m AS (
  SELECT r.day, r.hour, r.after, r.ok, list_sort(COALESCE(list({missing}) FILTER (WHERE a.h > r.after + {24 if first == 0 else 0}), [])) AS labels
  FROM {kind}_r r JOIN {kind}_a a ON a.day = r.day GROUP BY r.day, r.k, r.hour, r.after, r.ok),
{kind}_n AS (SELECT m.*, {names} AS names FROM {kind}_m m),
{kind}_k AS (
  SELECT n.day, n.after, n.ok, array_to_string(labels, ',') AS missing, substr(md5(array_to_string(names, '|')), 1, 8) AS digest,
         CASE WHEN len(names) = 0 THEN 'complete' {early if order == 'hour_first' else exempted} {exempted if order == 'hour_first' else early} END AS known
  FROM {kind}_n n LEFT JOIN zero_days z ON z.day = n.day - {zero_day}),
{kind}_o AS (SELECT *, row_number() OVER (PARTITION BY day, digest ORDER BY after) AS i FROM {kind}_k),
{kind}_f AS (
  SELECT day, digest, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS last, CAST(NULL AS VARCHAR) AS decision, false AS expired,
         CAST(NULL AS VARCHAR) AS missing, CAST(NULL AS BIGINT) AS after
  FROM (SELECT DISTINCT day, digest FROM {kind}_o)
  UNION ALL
  SELECT o.day, o.digest, o.i, CASE WHEN d.decision = 'send' AND o.ok THEN o.after ELSE f.last END,
         d.decision, d.decision = 'send' AND f.last IS NOT NULL, o.missing, o.after
  FROM {kind}_f f JOIN {kind}_o o ON o.day = f.day AND o.digest = f.digest AND o.i = f.i + 1,
       LATERAL (SELECT CASE WHEN o.known IS NOT NULL THEN o.known WHEN f.last >= o.after - 168 THEN 'already_sent' ELSE 'send' END AS decision) d)"""


def _replay_sql() -> str:
    at = "strftime(CAST(day AS TIMESTAMP) + INTERVAL 1 HOUR * ({x} + 24), '%Y-%m-%d %H:%M:%S')"
    tables = _replay_cte(
        "t", "WHEN 'view' THEN 'raw_shohin_betsu' WHEN 'click' THEN 'raw_keyword' WHEN 'purchase' THEN 'raw_rppexp' WHEN 'signup' THEN 'raw_item' WHEN 'error' THEN 'raw_affi'",
        60, "9, 15, 18", 1, 10, "CASE WHEN a.label = 'raw_affi' THEN 'raw_affi(stale ' || CAST(r.after + 24 AS VARCHAR) || '.0h)' ELSE a.label END",
        "list_sort([split_part(x, '(', 1) for x in m.labels])", "0", "'raw_shohin_betsu', 'raw_keyword'", "hour_first")
    files = _replay_cte(
        "f", "WHEN 'view' THEN '商品別RPP' WHEN 'click' THEN 'KW実績' WHEN 'purchase' THEN 'RPP費用' WHEN 'signup' THEN 'カルテ'",
        20, "9, 15, 17, 20", 0, 1, "a.label", "m.labels", "1", "'商品別RPP', 'KW実績'", "exempt_first")
    parts = [f"SELECT '{kind}' AS kind, {at.format(x='after')} AS run_at, strftime(day, '%Y-%m-%d') AS target, missing, digest, decision, expired, "
             f"{at.format(x='last')} AS last_sent FROM {name}_f WHERE i > 0" for kind, name in (("tables", "t"), ("files", "f"))]
    zero = "zero_days AS (SELECT CAST(ts AS DATE) AS day, count(*) % 3 = 0 AS is_zero FROM events WHERE event_type = 'purchase' GROUP BY 1)"
    return f"WITH RECURSIVE {zero},{tables},{files}\n" + "\nUNION ALL\n".join(parts)


SQL["alert_replay"] = _replay_sql()

_DAYS = "WITH e AS (SELECT *, CAST(ts AS DATE) AS day, strftime(ts, '%Y%m%d') AS d8 FROM events)"
SQL["ad_report"] = _DAYS + """
SELECT 'RPP商品別_' || d8 || '.csv' AS path, CAST(event_id AS VARCHAR) AS no,
       strftime(day, '%Y年%m月%d日') || '～' || strftime(day, '%Y年%m月%d日') AS date_text,
       CASE WHEN day(day) % 2 = 0 THEN '1.5' ELSE '' END AS ctr,
       CASE WHEN day(day) % 2 = 0 THEN '' ELSE '鳩, ' || CAST(user_id AS VARCHAR) END AS item
FROM e WHERE day(day) <> 9 AND day <> DATE '2024-01-05'"""
SQL["ad_report_status"] = _DAYS + """
SELECT DISTINCT 'RPP商品別_' || d8 || '.csv' AS path,
       CASE WHEN day = DATE '2024-01-05' THEN 'rejected' WHEN day(day) = 9 THEN 'header_not_found' ELSE 'ok' END AS state,
       CASE WHEN day = DATE '2024-01-05' THEN 'fields 5 > 4' END AS reason FROM e"""
SQL["page_analysis"] = _DAYS + """
SELECT strftime(day, '%Y-%m-%d') AS d, 'u' || CAST(user_id AS VARCHAR) AS sku, CAST(event_id AS VARCHAR) AS pv,
       '店舗カルテ_商品ページ分析_' || d8 || '.csv' AS path
FROM e WHERE day <> DATE '2024-01-05'"""
SQL["page_analysis_status"] = _DAYS + """
SELECT DISTINCT '店舗カルテ_商品ページ分析_' || d8 || '.csv' AS path, CASE WHEN day = DATE '2024-01-05' THEN 'rejected' ELSE 'ok' END AS state,
       CASE WHEN day = DATE '2024-01-05' THEN 'no date in line 3' END AS reason FROM e"""
SQL["action_list"] = _DAYS + """
SELECT strftime(day, '%Y-%m-%d') AS d, '鳩よけ' AS kw, CAST(event_id AS VARCHAR) AS n, '店舗カルテ_自然検索_' || d8 || '.csv' AS path FROM e"""
SQL["newest_of_day"] = with_ctes("""
SELECT path, strftime(mtime, '%Y-%m-%d %H:%M:%S.%f') AS mtime FROM (
  SELECT *, row_number() OVER (PARTITION BY contains(path, '_summary_') ORDER BY mtime DESC, path DESC) AS rn
  FROM listing WHERE CAST(mtime + INTERVAL 9 HOUR AS DATE) = DATE '2024-01-20') WHERE rn = 1""", "listing")
SQL["daily_totals"] = with_ctes("SELECT path, n_cols, clicks_text, cost_text FROM daily_a", "daily_a")
SQL["schema_history"] = with_ctes("""
SELECT 'newest' AS version, line_id, sku, order_date,
       CASE WHEN order_date >= '1997-01-01' THEN CAST(line_id % 24 AS VARCHAR) || ':05' END AS "注文時間" FROM orders_a
UNION ALL
SELECT 'first', line_id, sku, order_date, 'not there' FROM orders_a WHERE order_date < '1997-01-01'""", "orders_a")


def _missing_states_sql() -> str:
    spine = ("spine AS (SELECT CAST(x AS DATE) AS md FROM "
             "generate_series(DATE '2024-01-24', DATE '2024-01-30', INTERVAL 1 DAY) s(x))")
    parts, selects = [], []
    for tbl, src, parse in (("raw_item", "item_a", iso_or_slash), ("raw_keyword", "kw_a", mixed)):
        parts.append(f"m_{tbl} AS (SELECT strftime(md, '%Y-%m-%d') AS d FROM spine WHERE md NOT IN "
                     f"(SELECT {parse('date_text')} FROM {src} WHERE {parse('date_text')} IS NOT NULL))")
        selects += [f"SELECT '{tbl}' AS tbl, d AS missing_date, 'missing' AS state, CAST(NULL AS VARCHAR) AS message FROM m_{tbl}",
                    f"SELECT '{tbl}', NULL, 'none', NULL WHERE NOT EXISTS (SELECT 1 FROM m_{tbl})"]
    selects += ["SELECT 'raw_affi', NULL, 'no_table', NULL", "SELECT 'raw_rppexp', NULL, 'error', 'FAILED_READ_FILE'",
                "SELECT 'raw_review', NULL, 'error', 'UNRESOLVED_COLUMN'"]
    return with_ctes("", "item_a", "kw_a") + ",\n" + spine + ",\n" + ",\n".join(parts) + "\n" + "\nUNION ALL ".join(selects)


SQL["missing_dates_states"] = _missing_states_sql()


def _sketch_sql() -> str:
    parts = []
    for c, t in PROFILE_COLS:
        v = f"CAST({c} AS VARCHAR)"
        parts.append(f"""SELECT '{c}' AS "column", '{t}' AS type, CAST(count(*) AS BIGINT) AS rows,
  CAST(count(*) FILTER (WHERE {v} IS NOT NULL AND trim({v}) <> '') AS BIGINT) AS non_blank, min({v}) AS min_value, max({v}) AS max_value,
  (SELECT string_agg(v, '|' ORDER BY k) FROM (
     SELECT (position(substr(md5(v), 1, 1) IN '0123456789abcdef') - 1) // 2 AS k, arg_min(v, md5(v)) AS v FROM (SELECT {v} AS v FROM orders_a) WHERE v IS NOT NULL GROUP BY 1)) AS samples
FROM orders_a""")
    return with_ctes("\nUNION ALL\n".join(parts), "orders_a")


SQL["column_sketch"] = _sketch_sql()
