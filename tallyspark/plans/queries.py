"""Registered queries: one per operator family, run on the driver tables.

Every query derives its inputs from the given tables (``analogues``) and runs
over them whole; parameters (dates, SKU) are the same the oracle SQL uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tallyspark.functions import dates as D
from tallyspark.functions import numbers as N
from tallyspark.operators import alerts as AL
from tallyspark.operators import dedup as DD
from tallyspark.operators import guard as G
from tallyspark.operators import quality as QL
from tallyspark.operators import reports as R
from tallyspark.operators import upsert as U
from tallyspark.operators.profile import column_profile as _column_profile
from tallyspark.operators.profile import column_sketch as _column_sketch
from tallyspark.plans import analogues as A

# Fixed parameters shared with the oracle SQL.
SINCE = "1997-01-01"
MATCH_DAY = "1998-08-02"
PNL_FROM, PNL_TO = "1998-03-10", "1998-03-18"
PNL_DAY = "1998-03-05"
UNIT_SKU, UNIT_FROM = "Red-plate", "1998-01-01"
RAW_FROM = "2024-01-14"
AS_OF = "2024-01-31"
NEW_FROM = "2024-01-25"          # keyword rows from this day on are the new batch
WINDOW_FROM, WINDOW_TO = "2024-01-17", "2024-01-30"   # re-fetched (matured) days
LOADED_UNTIL = "2024-01-07"      # days already loaded before the file batch
NOW = "2024-01-31 16:00:00"
NOW_EARLY = "2024-01-31 10:00:00"
FRESH_NOW = "2024-01-31 12:00:00"
LEDGER_FROM = "2024-01-25"

Query = Callable[[SparkSession, str], DataFrame]


def unmatched_sku_all(spark, d):
    lines = A.order_lines(spark, d).where(F.col("order_day") >= F.to_date(F.lit(SINCE)))     # reaches the orders scan
    return R.unmatched_skus(lines, A.master_a(spark, d), SINCE,
                            sku="sku", sku_system="sku_system", order_date="order_date",
                            amount="amount", qty="qty")


def match_status_day(spark, d):
    lines = A.order_lines(spark, d).where(F.col("order_day") == F.to_date(F.lit(MATCH_DAY)))
    return R.match_status(lines, A.master_a(spark, d), MATCH_DAY,
                          sku="sku", sku_system="sku_system", order_date="order_date",
                          amount="amount", qty="qty")


def master_listing(spark, d):
    m = R.master_listing(A.master_a(spark, d))
    return m.select("sku_system", "sku", m.cost.cast("double").alias("cost"),
                    m.supplies.cast("double").alias("supplies"),
                    m.shipping.cast("double").alias("shipping"),
                    m.valid_from.cast("string").alias("valid_from"))


def unit_cost(spark, d):
    return R.unit_cost(A.pl_a(spark, d), UNIT_SKU, UNIT_FROM)


def daily_pnl(spark, d):
    return R.daily_pnl(A.pl_a(spark, d), PNL_FROM, PNL_TO)


def day_pnl(spark, d):
    return R.daily_pnl(A.pl_a(spark, d), PNL_DAY)


def sku_pnl_day(spark, d):
    return R.sku_pnl(A.pl_a(spark, d), PNL_DAY)


def raw_daily_profile(spark, d):
    return R.raw_daily_profile(A.shohin_a(spark, d), RAW_FROM, date_col="date_text",
                               clicks="clicks", ctr="ctr")


def daily_impressions(spark, d):
    return R.daily_impressions(A.vrd_a(spark, d), RAW_FROM)


def distinct_dates_topk(spark, d):
    return R.distinct_topk(A.item_a(spark, d), "date_text", 20)


def distinct_report_dates(spark, d):
    pl = A.pl_a(spark, d).selectExpr("date_format(report_date, 'yyyy-MM-dd') AS report_date")
    return R.distinct_topk(pl, "report_date", 10)


def distinct_skus_ordered(spark, d):
    return R.distinct_topk(A.item_a(spark, d), "sku", 10, descending=False)



# ---- dates and numbers (F1-F6) ------------------------------------------------

def _date_spellings(spark, d):
    e = A.read(spark, d, "events").withColumn("d", F.to_date("ts"))
    k = F.col("event_id") % 6
    text = (F.when(k == 0, D.jp_range_text("d"))
            .when(k == 1, D.iso_text("d"))
            .when(k == 2, F.concat(F.concat_ws("/", F.year("d").cast("string"), F.month("d").cast("string"),
                                       F.dayofmonth("d").cast("string")),
                           F.lit(" "), F.hour("ts").cast("string"), F.lit(":"),
                           F.lpad(F.minute("ts").cast("string"), 2, "0")))
            .when(k == 3, F.concat(F.year("d").cast("string"), F.lit("年"), F.month("d").cast("string"),
                                   F.lit("月"), F.dayofmonth("d").cast("string"), F.lit("日")))
            .when(k == 4, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .when(F.col("event_type") == "error", F.lit("合計"))
            .otherwise(F.date_format("d", "yyyy/MM/dd")))
    return e.select(F.col("event_id").alias("row_no"), text.alias("text"))


def parse_dates(spark, d):
    t = _date_spellings(spark, d)
    return t.select(
        "row_no", "text",
        D.normalize_date_chain("text", D.new_rows_order("rpp_range")).alias("norm_new"),
        D.normalize_date_chain("text", D.EXISTING_VALUES_ORDER).alias("norm_existing"),
        D.normalize_date_chain("text", D.EXPANSION_ORDER).alias("norm_expansion"),
        D.normalize_date_chain("text", D.REFRESH_ORDER).alias("norm_refresh"),
        D.iso_text(D.parse_mixed_date("text")).alias("mixed"),
        D.iso_text(D.parse_mixed_date_iso_first("text")).alias("mixed_iso_first"),
        D.iso_text(D.parse_iso_or_slash("text")).alias("iso_or_slash"))


def safe_casts(spark, d):
    e = A.read(spark, d, "events")
    k = F.col("event_id") % 5
    plain = F.col("value").cast("decimal(10,2)").cast("string")
    text = (F.when(k == 0, plain)
            .when(k == 1, F.format_number(F.col("value") * 100, 2))
            .when(k == 2, F.concat(F.lit("\ufeff"), plain, F.lit("%")))
            .when(k == 3, F.when(F.col("event_type") == "error", F.lit("abc")).otherwise(F.concat(plain, F.lit("d"))))
            .otherwise(F.concat(F.lit(" "), plain, F.lit(" "))))
    t = e.select(F.col("event_id").alias("row_no"), text.alias("text"))
    return t.select("row_no", "text", N.safe_double("text").alias("as_double"),
                    N.comma_float("text").alias("comma_float"),
                    N.safe_double(N.strip_pct_bom("text")).alias("pct_value"),
                    N.safe_bigint(F.regexp_replace("text", r"\.\d*$", "")).cast("double").alias("as_int"))


# ---- spike guard (W1, F7, Q10, A12) --------------------------------------------

def _kw_split(spark, d):
    kw = A.kw_a(spark, d)
    new_from = F.to_date(F.lit(NEW_FROM))
    return kw.where(F.col("d") < new_from).drop("d"), kw.where(F.col("d") >= new_from).drop("d")


def _guard(spark, d):
    hist, new = _kw_split(spark, d)
    return G.spike_guard(new, hist, AS_OF, sku="sku", kw="kw", guide="guide", date_col="date_text",
                         tiebreak=["row_no"])


def baseline_latest(spark, d):
    hist, _ = _kw_split(spark, d)
    b = G.guideline_baseline(hist, AS_OF, sku="sku", kw="kw", guide="guide", date_col="date_text",
                             tiebreak=["row_no"])
    return b.select("sku", "kw", "prior", D.iso_text("prior_date").alias("prior_date"))


def spike_guard(spark, d):
    guarded, _ = _guard(spark, d)
    return guarded.select("row_no", "date_text", "sku", "kw", "guide")


def spike_report(spark, d):
    _, spikes = _guard(spark, d)
    top = G.spike_sample(spikes, 10, [F.desc("ratio"), F.asc("row_no")])
    return top.select("row_no", "sku", "kw", "prior", "new_value", "ratio")


def spike_log(spark, d):
    """The log lines of the greatest spikes, ratio to one decimal."""
    _, spikes = _guard(spark, d)
    return G.spike_sample(spikes, 10, [F.desc("ratio"), F.asc("row_no")]).select("row_no", "sku", "kw", "ratio_1dp")


def spike_guard_multi_file(spark, d):
    """Q10 across files: each day of the new batch is one file, loaded in date order.

    The oracle chains one CTE per file; the pytest checks it against a plain-Python fold.
    """
    hist, _ = _kw_split(spark, d)
    kw = A.kw_a(spark, d)
    rows = (kw.where(F.col("d") >= F.to_date(F.lit(NEW_FROM)))
            .withColumn("file_rank", F.datediff("d", F.date_sub(F.to_date(F.lit(NEW_FROM)), 1))).drop("d"))
    out = G.spike_guard_many(rows, hist, AS_OF, sku="sku", kw="kw", guide="guide",
                             date_col="date_text", tiebreak=["row_no"])
    return out.select("row_no", "date_text", "sku", "kw", "guide", "file_rank")


def spike_summary(spark, d):
    hist, new = _kw_split(spark, d)
    return G.guard_summary(new, hist, AS_OF, sku="sku", kw="kw", guide="guide", date_col="date_text",
                           tiebreak=["row_no"])


# ---- completeness, age, freshness (Q1-Q4, Q11) ----------------------------------

def _report_tables(spark, d):
    return {
        "raw_shohin_betsu": (A.shohin_a(spark, d), "date_text", D.parse_mixed_date),
        "raw_keyword": (A.kw_a(spark, d), "date_text", D.parse_mixed_date),
        "raw_rppexp": (A.rppexp_a(spark, d), "date_text", lambda c: D.parse_iso_only(F.substring(c, 1, 10))),
        "raw_item": (A.item_a(spark, d), "date_text", D.parse_iso_or_slash),
    }


def missing_dates(spark, d):
    t = _report_tables(spark, d)
    return QL.missing_dates(spark, {k: t[k] for k in ("raw_item", "raw_shohin_betsu", "raw_keyword")}, AS_OF, 7)


def missing_dates_not_in(spark, d):
    t = _report_tables(spark, d)
    return QL.missing_dates(spark, {k: t[k] for k in ("raw_item", "raw_shohin_betsu", "raw_keyword")}, AS_OF, 7,
                            null_semantics="not_in")


def missing_dates_states(spark, d):
    """Q1 / I6 with every state: missing, none, no_table, and error (a stored table whose file is no Parquet)."""
    import uuid

    from tallyspark.session import work_dir
    from tallyspark.sources.catalog import table_or_none
    t = _report_tables(spark, d)
    broken = f"{work_dir(spark)}/broken-{uuid.uuid4().hex}"
    A.item_a(spark, d).select("date_text").write.text(broken)

    def opened(name, change=lambda df: df):
        df, col, parse = t[name]
        return lambda: change(df), col, parse

    return QL.checked_missing_dates(spark, {
        "raw_item": opened("raw_item"), "raw_keyword": opened("raw_keyword"),
        "raw_rppexp": (lambda: spark.read.schema("date_text string").parquet(broken), "date_text", D.parse_mixed_date),
        "raw_affi": (lambda: table_or_none(spark, f"{broken}/none"), "date_text", D.parse_mixed_date),
        "raw_review": (lambda: t["raw_item"][0], "no_such_column", D.parse_mixed_date)}, AS_OF, 7)


def _status(spark, d):
    return QL.completeness(spark, _report_tables(spark, d), "2024-01-01", AS_OF)


def completeness_status(spark, d):
    return _status(spark, d)


def completeness_verdict(spark, d):
    return QL.completeness_verdict(_status(spark, d))


def data_age(spark, d):
    return QL.data_age({"raw_affi": (A.affi_a(spark, d), "occurred"),
                        "raw_rppexp": (A.rppexp_a(spark, d), "date_text"),
                        "raw_item": (A.item_a(spark, d), "date_text")}, AS_OF, 2)


def freshness(spark, d):
    e = A.read(spark, d, "events")
    lag = F.when(F.col("event_type") == "error", F.col("ts") - F.expr("INTERVAL 2 DAYS")).otherwise(F.col("ts"))
    listing = e.select(F.concat(F.lit("raw_"), F.col("event_type")).alias("tbl"), lag.alias("modified"))
    return QL.freshness(listing, FRESH_NOW, 36)


def day_verdict(spark, d):
    """Q11 over the four report tables (Q2), the affiliate table's last change (Q3) and newest dates (Q4)."""
    listing = A.read(spark, d, "events").where(F.col("event_type") == "error").select(
        F.lit("raw_affi").alias("tbl"), (F.col("ts") - F.expr("INTERVAL 2 DAYS")).alias("modified"))
    empty = A.affi_a(spark, d).where(F.col("occurred") == "never")
    age = QL.data_age({"raw_affi": (A.affi_a(spark, d), "occurred"), "raw_review": (empty, "occurred"),
                       "raw_item": (A.item_a(spark, d).withColumn("date_text", F.lit("合計")), "date_text")}, AS_OF, 2)
    return QL.day_verdict(_status(spark, d), QL.freshness(listing, FRESH_NOW, 36), age, "2024-01-01", AS_OF)


def _daily_totals(spark, d):
    return QL.daily_totals_latest(A.daily_a(spark, d))


def daily_totals(spark, d):
    """S7 from contents: the files' first two lines out of thousands, then the newest valid file of a day.

    A file has a header, its row and a line for every event of its day and type; some headers are longer than
    the bytes read first.
    """
    from tallyspark.sources import csv_reports as C
    listed = A.daily_a(spark, d)
    n = A.read(spark, d, "events").groupBy(F.date_format("ts", "yyyyMMdd").alias("_day"), F.col("event_type").alias("_kind")).count()
    day, kind = F.regexp_extract("path", r"12h_(\d{8})_", 1), F.split_part("path", F.lit("/"), F.lit(1))
    listed = listed.withColumn("_day", day).withColumn("_kind", kind).join(n, ["_day", "_kind"])
    column = F.concat(F.lit('"c, '), F.repeat(F.lit("x"), F.when(kind == "click", 100).otherwise(0)), F.lit('"'))
    header = F.array_join(F.array_repeat(column, F.col("n_cols")), ",")
    row = F.concat_ws(",", F.lit('"day, one"'), F.lit("a"), F.lit("b"), "clicks_text", "cost_text", F.array_join(F.array_repeat(F.lit("0"), F.col("n_cols") - 5), ","))
    # lines that nobody needs, 1,000 at most: a content cell stays bounded
    rest = F.repeat(F.lit("\r\nmore,lines,1,2,3"), F.least("count", F.lit(1000)).cast("int"))
    content = listed.select("path", F.encode(F.concat(header, F.lit("\r\n"), row, rest), "UTF-8").alias("content"))
    return C.daily_totals_from_heads(content, "UTF-8", head_bytes=2048)


def zero_delivery(spark, d):
    dates = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit("2024-01-01")),
                                                       F.to_date(F.lit(AS_OF)))).alias("d"))
    z = QL.zero_delivery(_daily_totals(spark, d), dates)
    return z.select("d", F.col("clicks").cast("double").alias("clicks"),
                    F.col("cost").cast("double").alias("cost"), "is_zero", "known")


def maturation_uplift(spark, d):
    e = A.read(spark, d, "events").where(F.col("event_type") == "purchase")
    e = e.select(D.iso_text(F.to_date("ts")).alias("d"), F.lit(1).alias("orders"), F.hour("ts").alias("h"))
    return QL.maturation_uplift(e.where(F.col("h") < 12), e, ["d"], "orders")


# ---- incremental loads (J1-J3, J10) ---------------------------------------------

def _li_split(spark, d):
    r = A.li_rows(spark, d)
    return r.where(F.col("flag") == "R"), r.where(F.col("flag") != "R")


def dedup_by_date(spark, d):
    target, rows = _li_split(spark, d)
    return DD.dedup_by_date(rows, target, "date_text", "rpp_range").select("row_no", "date_text")


def dedup_by_key(spark, d):
    target, rows = _li_split(spark, d)
    return DD.dedup_by_key(rows, target, "order_no").select("row_no", "order_no")


def dedup_by_composite(spark, d):
    target, rows = _li_split(spark, d)
    return DD.dedup_by_composite(rows, target, "date_text", "item").select("row_no", "date_text", "item")


def _file_batch(spark, d):
    kw = A.kw_a(spark, d)
    e = A.read(spark, d, "events").select(F.col("event_id").alias("row_no"), "ts")
    rows = (kw.where(F.col("kw") != "error").join(e, "row_no")
            .withColumn("file", F.concat(F.col("kw"), F.lit("_w"), F.weekofyear("d").cast("string"))))
    files = rows.groupBy("file").agg(F.max("ts").alias("mtime"))
    from tallyspark.sources.files import with_file_rank
    ranked = with_file_rank(files, "mtime", "file")
    rows = rows.join(ranked.select("file", "file_rank"), "file")
    target = kw.where((F.col("kw") == "error") & (F.col("d") <= F.to_date(F.lit(LOADED_UNTIL))))
    return rows, target


def first_writer_wins(spark, d):
    rows, target = _file_batch(spark, d)
    out = DD.first_writer_wins(rows, target, "date_text", "file_rank")
    return out.select("row_no", "file", "date_text")


# ---- readers and dated ingest on in-memory report files (S1, U2, J10, I1, P13) ----

REPORT_HEADER = ("row_no", "日付", "商品管理番号", "キーワード", "目安CPC")
BROKEN_DAY = "2024-01-05"          # this day's file has a line with a field too many


PART_LINES = 50000                 # lines of a report file that one content cell holds, about


def _report_files(spark, d, part_lines=PART_LINES):
    """Report files, one per day of the keyword analogue, as (path, part, modificationTime, length, content).

    Keywords carry quotes, a comma and a backslash, so cells depend on the quoting rules.  A file comes in
    parts: part 0 is the header line, each other part about ``part_lines`` of its lines, so no cell grows with the day.
    """
    kw = A.kw_a(spark, d).withColumn("kw", F.concat("kw", F.lit(' "a", \\')))
    days = kw.groupBy("d").agg(F.ceil(F.count("*") / part_lines).alias("parts"), F.max("row_no").alias("last"))
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("row_no", "date_text", "sku", "kw", "guide")]
    line = F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in cells])
    broken = (F.col("d") == F.to_date(F.lit(BROKEN_DAY))) & F.col("row_no").eqNullSafe(F.col("last"))
    line = F.when(broken, F.concat(line, F.lit(',"EXTRA"'))).otherwise(line)
    head = ",".join(f'"{c}"' for c in REPORT_HEADER)
    kw = kw.join(days.withColumnRenamed("d", "_d"), F.col("d") == F.col("_d"))
    part = (F.pmod(F.xxhash64("row_no"), F.col("parts")) + 1).alias("part")
    text = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("row_no", line.alias("line")))), lambda x: x["line"]))
    files = (kw.groupBy("d", part).agg(text.alias("t"))
             .unionByName(days.select("d", F.lit(0).cast("bigint").alias("part"), F.lit(head).alias("t"))))
    return files.select(F.concat(F.lit("RPPキーワード別12h_"), F.date_format("d", "yyyyMMdd"), F.lit("_0900.csv")).alias("path"), "part",
                        F.to_timestamp("d").alias("modificationTime"), F.length("t").cast("bigint").alias("length"),
                        F.encode("t", "UTF-8").alias("content"))


def _report_lines(files, charset="UTF-8"):
    """Numbered lines of report files in parts: the lines of a part come after those of the parts before it."""
    from tallyspark.sources import csv_reports as C
    lines = C.lines_from_binary(files.withColumn("path", F.concat_ws("#", "part", "path")), charset)
    part, path = F.substring_index("path", "#", 1).cast("bigint"), F.expr("substr(path, instr(path, '#') + 1)")
    return lines.select(path.alias("path"), "mtime", "size", (F.col("pos") + F.shiftleft(part, 32)).alias("pos"), "line")


def _report_load(spark, d):
    from tallyspark.plans import ingest as I
    from tallyspark.sources.files import with_file_rank
    files = _report_files(spark, d)
    ranked = with_file_rank(files.where("part = 0"), "modificationTime").select("path", "file_rank")
    return I.accept_dated(_report_lines(files), ranked, I.FAMILIES["raw_shohin_betsu"], None)


def report_ingest(spark, d):
    rows, _ = _report_load(spark, d)
    return rows.select(F.col("row_no").cast("bigint").alias("row_no"), F.col("日付").alias("date_text"),
                       F.col("商品管理番号").alias("sku"), F.col("キーワード").alias("kw"), F.col("目安CPC").alias("guide"))


def report_status(spark, d):
    from tallyspark.sources import csv_reports as C
    return C.screen_files(_report_lines(_report_files(spark, d)), ["日付"])


def _content(df, file_cols, order, head, part_lines=PART_LINES, charset="UTF-8"):
    """Report files as content cells: (path, part, modificationTime, length, content); part 0 is ``head`` (text per file).

    ``df`` has path, mtime, ``order`` and line; other parts hold about ``part_lines`` lines each.
    """
    files = df.groupBy("path").agg(F.max("mtime").alias("mtime"), F.ceil(F.count("*") / part_lines).alias("parts"), *file_cols)
    lines = df.join(files.select(F.col("path").alias("_p"), "parts", F.col("mtime").alias("_m")), F.col("path") == F.col("_p"))
    part = (F.pmod(F.xxhash64(order), F.col("parts")) + 1).alias("part")
    text = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct(order, "line"))), lambda x: x["line"]))
    body = lines.groupBy("path", part).agg(F.max("_m").alias("mtime"), text.alias("t"))
    every = body.unionByName(files.select("path", F.lit(0).cast("bigint").alias("part"), "mtime", head.alias("t")))
    return every.select("path", "part", F.col("mtime").alias("modificationTime"), F.length("t").cast("bigint").alias("length"), F.encode("t", charset).alias("content"))


def _affiliate_files(spark, d):
    """Affiliate files by the last digit of the order: 0-5 and 6 whole (6 is the newest), 7 a column short, 8 a cell with a line break, 9 preamble only."""
    from tallyspark.sources.csv_reports import AFFILIATE_SKIPROWS
    k = F.col("order_no").cast("bigint") % 10
    a = A.affi_a(spark, d).withColumn("kind", F.when(k < 6, F.lit(0)).otherwise(k))
    text = [F.col("occurred"), F.lit("a"), F.lit('"n, ""x"""'), F.lit("g"), F.concat(F.lit(" "), F.col("order_no"), F.lit(" ")), F.lit(""),
            F.length("occurred").cast("string"), F.lit("1%"), F.lit("N/A"), F.col("status"), F.lit("pc"), F.lit("sp")]
    line = F.concat_ws(",", *text, F.when(F.col("kind") != 7, F.lit("item")))
    line = F.when(F.col("kind") == 8, F.concat(line, F.lit('"open'))).otherwise(line)
    rows = a.select(F.concat(F.lit("pending_"), F.col("kind").cast("string"), F.lit(".csv")).alias("path"),
                    F.timestamp_seconds(F.lit(1_700_000_000) + F.when(F.col("kind") == 6, 60).otherwise(F.col("kind"))).alias("mtime"),
                    "kind", "order_no", F.when(F.col("kind") != 9, line).alias("line"))
    head = F.lit("\n".join(f"preamble {i}" for i in range(AFFILIATE_SKIPROWS)))
    return _report_lines(_content(rows, [], "order_no", head))


def affiliate_ingest(spark, d):
    """The newest affiliate file that can be read; order numbers not loaded yet (every third one is)."""
    from tallyspark.sources import csv_reports as C
    from tallyspark.sources.files import latest_file
    lines = _affiliate_files(spark, d)
    newest = latest_file(lines.groupBy("path").agg(F.max("mtime").alias("mtime"))).select("path")
    rows, _ = C.affiliate_from_lines(lines.join(newest, "path", "left_semi"))
    target = A.affi_a(spark, d).where(F.col("order_no").cast("bigint") % 3 == 0).select(F.col("order_no").alias("受注番号"))
    new = DD.dedup_by_key(rows, target, "受注番号")
    return new.select(F.col("受注番号").alias("order_no"), F.col("成果発生日時").alias("occurred"), F.col("商品名").alias("name"),
                      F.col("売上金額").alias("amount"), F.col("成果報酬").alias("reward"), F.col("ステータス").alias("status"), F.col("source_file").alias("path"))


def affiliate_status(spark, d):
    """One row for every affiliate file, also for those without a data line."""
    from tallyspark.sources import csv_reports as C
    return C.affiliate_from_lines(_affiliate_files(spark, d))[1]


def _expansion_files(spark, d):
    """Expansion files: two generations a day, dates in four spellings, a header that is replaced; one day's files have short rows."""
    from tallyspark.sources.csv_reports import EXPANSION_COLUMNS, EXPANSION_SKIPROWS
    e = A.read(spark, d, "events").where("event_type = 'purchase'").withColumn("day", F.to_date("ts"))
    k = F.col("event_id") % 4
    date = (F.when(k == 0, F.date_format("day", "yyyy年M月d日")).when(k == 1, D.jp_range_text("day"))
            .when(k == 2, F.date_format("day", "yyyy/M/d 9:05")).otherwise(D.iso_text("day")))
    gen = F.when(F.col("event_id") % 3 == 0, F.lit("1000")).otherwise(F.lit("0900"))
    cells = [date, F.lit("url"), F.concat(F.lit(" u"), (F.col("user_id") % 50).cast("string")), F.col("event_id").cast("string")]
    line = F.concat_ws(",", *cells, *[F.lit(str(i)) for i in range(len(EXPANSION_COLUMNS) - len(cells) - 1)],
                       F.when(F.col("day") != F.to_date(F.lit(BROKEN_DAY)), F.lit("end")))
    rows = e.select(F.concat(F.lit("RPPEXP商品別_"), F.date_format("day", "yyyyMMdd"), F.lit("_"), gen, F.lit(".csv")).alias("path"),
                    F.to_timestamp(F.concat(D.iso_text("day"), F.lit(" "), gen), "yyyy-MM-dd HHmm").alias("mtime"), "event_id", line.alias("line"), "day")
    # the header line comes right after the preamble
    head = F.concat(F.lit("\n".join(f"p{i}" for i in range(EXPANSION_SKIPROWS))), F.lit("\n"),
                    F.concat_ws(",", *[F.lit(f"h{i}") for i in range(len(EXPANSION_COLUMNS))]))
    short = F.concat(F.lit("\n".join(f"p{i}" for i in range(EXPANSION_SKIPROWS))), F.lit("\nh0,h1,h2"))
    return _report_lines(_content(rows, [F.max("day").alias("day")], "event_id", F.when(F.col("day") == F.to_date(F.lit(BROKEN_DAY)), short).otherwise(head)))


def expansion_ingest(spark, d):
    """Expansion files of all days; (date, item) pairs not loaded yet, each to the first file that has it."""
    from tallyspark.sources import csv_reports as C
    from tallyspark.sources.files import with_file_rank
    lines = _expansion_files(spark, d)
    rows, _ = C.expansion_from_lines(lines)
    ranked = with_file_rank(lines.groupBy("path").agg(F.max("mtime").alias("mtime"))).select(F.col("path").alias("source_file"), "file_rank")
    target = (A.read(spark, d, "events").where("event_type = 'purchase'").where(F.to_date("ts") <= F.to_date(F.lit(LOADED_UNTIL)))
              .select(D.iso_text(F.to_date("ts")).alias("日付"), F.concat(F.lit("u"), (F.col("user_id") % 50).cast("string")).alias("商品管理番号")))
    target = target.where(F.expr("substr(`商品管理番号`, 2) % 2 = 0"))
    new = DD.dedup_by_composite(rows.join(ranked, "source_file"), target, "日付", "商品管理番号", file_rank="file_rank")
    return new.select(F.col("日付").alias("date_text"), F.col("商品管理番号").alias("item"), F.col("実績額").alias("amount"), F.col("source_file").alias("path"))


def expansion_status(spark, d):
    """One row for every expansion file."""
    from tallyspark.sources import csv_reports as C
    return C.expansion_from_lines(_expansion_files(spark, d))[1]


def _day_files(spark, d, prefix, line, head, charset="UTF-8"):
    """Numbered lines of one file a day of ``events``: ``head`` (by day), then ``line`` of every event."""
    if charset != "UTF-8":
        for k in ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction"):      # as the library's sessions have it
            spark.conf.set(k, "true")
    e = A.read(spark, d, "events").withColumn("day", F.to_date("ts"))
    rows = e.select(F.concat(F.lit(prefix), F.date_format("day", "yyyyMMdd"), F.lit(".csv")).alias("path"), F.to_timestamp("day").alias("mtime"), "event_id", line.alias("line"), "day")
    return _report_lines(_content(rows, [F.max("day").alias("day")], "event_id", head, charset=charset), charset)


def _broken():
    return F.col("day") == F.to_date(F.lit(BROKEN_DAY))


def _ad_lines(spark, d):
    """cp932 ad reports in two layouts by even and odd days; one day without the header marker, one with a line too wide."""
    even = F.dayofmonth("day") % 2 == 0
    n, sku = F.col("event_id").cast("string"), F.concat(F.lit('"鳩, '), F.col("user_id").cast("string"), F.lit('"'))
    line = F.when(even, F.concat_ws(",", D.jp_range_text("day"), n, F.lit("1.5"))).otherwise(F.concat_ws(",", n, D.jp_range_text("day"), F.lit("NA"), sku))
    line = F.when(_broken() & (F.col("event_id") % 50 == 0), F.concat(line, F.lit(",EXTRA"))).otherwise(line)
    header = F.when(F.dayofmonth("day") == 9, F.lit("日付,番号,CTR")).when(even, F.lit('"日付","番号","CTR(%)"')).otherwise(F.lit('"番号","日付","CTR(%)","商品"'))
    return _day_files(spark, d, "RPP商品別_", line, F.concat(F.lit("レポート,商品別\n期間,2024\n\n"), header), "MS932")


def ad_report(spark, d):
    """S4 + U2: cleaned cp932 ad reports of two layouts as one table (rows of the file without a header marker hold no number)."""
    from tallyspark.sources import csv_reports as C
    rows, _ = C.ad_report_from_lines(_ad_lines(spark, d))
    return rows.where(F.col("番号") != "").select(F.col("source_file").alias("path"), F.col("番号").alias("no"), F.col("日付").alias("date_text"),
                                                F.col("CTR(%)").alias("ctr"), F.col("商品").alias("item"))


def ad_report_status(spark, d):
    from tallyspark.sources import csv_reports as C
    return C.ad_report_from_lines(_ad_lines(spark, d))[1]


def _page_lines(spark, d):
    date = F.when(_broken(), F.lit("?")).otherwise(F.date_format("day", "yyyy'年'MM'月'dd'日'"))
    head = F.concat(F.lit("t\nx\n期間,"), date, F.lit("\n\n\n商品管理番号,PV"))
    return _day_files(spark, d, "店舗カルテ_商品ページ分析_", F.concat_ws(",", F.concat(F.lit("u"), F.col("user_id").cast("string")), F.col("event_id").cast("string")), head)


def page_analysis(spark, d):
    """Page reports with their day from the preamble; the file whose preamble has none is rejected."""
    from tallyspark.sources import csv_reports as C
    rows, _ = C.page_analysis_from_lines(_page_lines(spark, d))
    return rows.select(F.col("対象日").alias("d"), F.col("商品管理番号").alias("sku"), F.col("PV").alias("pv"), F.col("source_file").alias("path"))


def page_analysis_status(spark, d):
    from tallyspark.sources import csv_reports as C
    return C.page_analysis_from_lines(_page_lines(spark, d))[1]


def action_list(spark, d):
    """cp932 action lists with their day from the file name."""
    from tallyspark.sources import csv_reports as C
    line = F.concat_ws(",", F.lit("鳩よけ"), F.col("event_id").cast("string"))
    rows, _ = C.action_list_from_lines(_day_files(spark, d, "店舗カルテ_自然検索_", line, F.lit("t\nx\nkw,n"), "MS932"))
    return rows.select(F.col("対象日").alias("d"), "kw", "n", F.col("source_file").alias("path"))


def newest_of_day(spark, d):
    """S8 + S9: the newest summary and the newest dated report of the files modified on a Tokyo day."""
    from tallyspark.sources.files import latest_file, modified_on
    day = modified_on(A.report_listing(spark, d), "2024-01-20", "Asia/Tokyo")
    summary = F.col("path").contains("_summary_")
    return latest_file(day.where(summary)).unionByName(latest_file(day.where(~summary))).select(
        "path", F.date_format("mtime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mtime"))


def report_records(spark, d):
    """S1 on written files whose cells hold line breaks, quotes and commas: one file a day and part, read by byte blocks."""
    import uuid

    from tallyspark.session import work_dir
    from tallyspark.sources import records as RC
    kw = A.kw_a(spark, d)
    n = F.col("row_no")
    kw = kw.withColumn("kw", F.concat("kw", F.when(n % 7 == 0, F.lit(' "a",\r\n b')).when(n % 5 == 0, F.lit("\nline, \n\n end")).otherwise(F.lit(""))))
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("row_no", "date_text", "sku", "kw", "guide")]
    line = F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in cells])
    parts = kw.groupBy("d").agg(F.ceil(F.count("*") / PART_LINES).alias("parts")).withColumnRenamed("d", "_d")
    kw = kw.join(parts, F.col("d") == F.col("_d")).withColumn("part", F.pmod(F.xxhash64("row_no"), F.col("parts")))
    head = ",".join(f'"{c}"' for c in REPORT_HEADER)
    lines = kw.select("d", "part", F.lit(1).alias("o"), n, line.alias("value")).unionByName(
        kw.select("d", "part").distinct().select("d", "part", F.lit(0).alias("o"), F.lit(0).cast("bigint").alias("row_no"), F.lit(head).alias("value")))
    path = f"{work_dir(spark)}/reports-{uuid.uuid4().hex}"
    (lines.repartition("d", "part").sortWithinPartitions("d", "part", "o", "row_no").select("d", "part", "value")
     .write.partitionBy("d", "part").text(path))
    rows, _ = RC.read_report_records(spark, f"{path}/*/*", required=["日付"])
    return rows.select(F.col("row_no").cast("bigint").alias("row_no"), F.col("日付").alias("date_text"),
                       F.col("商品管理番号").alias("sku"), F.col("キーワード").alias("kw"), F.col("目安CPC").alias("guide"))


def new_files(spark, d):
    """Event files (type x day) modified since a day and not in the ledger of the days before."""
    from tallyspark.sources.files import new_since
    e = A.read(spark, d, "events").select("ts", F.concat("event_type", F.lit("_"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv")).alias("path"))
    listing = e.groupBy("path").agg(F.max("ts").alias("mtime"), F.count_if(F.hour("ts") < 20).alias("size"))
    ledger = listing.where(F.col("path").startswith("view")).select("path")
    return new_since(listing, ledger, "2024-01-20 00:00:00").select("path", "size")


# ---- replace-by-date upsert (K3, K4, J7) -----------------------------------------

def _upsert_inputs(spark, d):
    kw = A.kw_a(spark, d)
    target = kw.select("row_no", "date_text", "sku", "kw", "guide", "clicks")
    lo, hi = F.to_date(F.lit(WINDOW_FROM)), F.to_date(F.lit(WINDOW_TO))
    e = A.read(spark, d, "events").select(F.col("event_id").alias("row_no"), "value")
    staged = (kw.where((F.col("d") >= lo) & (F.col("d") <= hi)).join(e, "row_no")
              .select((F.col("row_no") + 1000000).alias("row_no"), D.iso_text("d").alias("date_text"),
                      "sku", "kw", (F.col("value").cast("decimal(10,2)") * 11).cast("string").alias("guide")))
    return target, staged


def replace_by_date(spark, d):
    target, staged = _upsert_inputs(spark, d)
    new, _ = U.replace_by_date(target.withColumn("row_no", F.col("row_no").cast("string")),
                               staged.withColumn("row_no", F.col("row_no").cast("string")), "date_text")
    return new


def upsert_plan(spark, d):
    _, staged = _upsert_inputs(spark, d)
    return U.upsert_plan(staged, "date_text")


def attribution_refresh(spark, d):
    """The matured days staged, checked, swapped in by one manifest and read back, with the rejected rows.

    Every 97th staged row has no real date.
    """
    import uuid

    from tallyspark.session import work_dir
    from tallyspark.sources import snapshots as S
    target, staged = _upsert_inputs(spark, d)
    staged = staged.withColumn("date_text", F.when(F.col("row_no") % 97 == 0, F.lit("合計")).otherwise(F.col("date_text")))
    table = f"{work_dir(spark)}/raw_keyword-{uuid.uuid4().hex}"
    S.append(spark, table, target, "date_text")
    done = S.replace_days(spark, table, staged, "date_text")
    back = S.read(spark, table).withColumn("part", F.lit("table"))
    rejected = done.rejected.withColumn("part", F.lit("rejected"))
    return back.unionByName(rejected, allowMissingColumns=True).select(
        "part", F.col("row_no").cast("string").alias("row_no"), "date_text", "sku", "kw", "guide", "clicks", F.date_format("pdate", "yyyy-MM-dd").alias("pdate"))


# ---- file listings (S10, S18, F17, F19) ------------------------------------------

def latest_per_date(spark, d):
    from tallyspark.sources.files import latest_file_per_date
    return latest_file_per_date(A.report_listing(spark, d)).select(
        "d8", "path", F.date_format("mtime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mtime"))


def refresh_window_files(spark, d):
    from tallyspark.sources.files import window_files
    wanted = D.trailing_window(spark, AS_OF, 14)
    return window_files(A.report_listing(spark, d), wanted, today=None).select(
        "d8", "path", F.date_format("mtime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mtime"))


def backfill_range(spark, d):
    from tallyspark.sources.files import backfill_files
    sel = backfill_files(A.daily_a(spark, d), "RPP日次12h_", AS_OF, 7)
    return sel.select("path", "target_date")


# The four report kinds that must be downloaded every day.
REQUIRED_KINDS = {
    "KW実績": r"^RPPキーワード別12h_.*\.csv$",
    "商品別RPP": r"^RPP商品別12h_.*\.csv$",
    "RPP費用": r"^RPPEXP商品別_.*\.csv$",
    "カルテ": r"^店舗カルテ_商品ページ分析_.*\.csv$",
}


def file_presence(spark, d):
    from tallyspark.sources.files import required_files
    e = A.read(spark, d, "events")
    prefix = (F.when(F.col("event_type") == "click", "RPPキーワード別12h_")
              .when(F.col("event_type") == "view", "RPP商品別12h_")
              .when(F.col("event_type") == "purchase", "RPPEXP商品別_")
              .when((F.col("event_type") == "signup") & (F.dayofweek("ts") != 1), "店舗カルテ_商品ページ分析_")
              .otherwise("other_"))
    listing = e.select(F.concat(prefix, F.date_format("ts", "yyyyMMdd_HHmm"), F.lit(".csv")).alias("name"),
                       F.col("ts").alias("mtime"))
    return required_files(spark, listing, REQUIRED_KINDS, "2024-01-01", AS_OF)


def orders_view(spark, d):
    """K7: a SELECT * view over the order lines, created twice (the second call replaces it)."""
    from tallyspark.sources.catalog import create_or_replace_view
    A.orders_a(spark, d).createOrReplaceTempView("orders_lines_src")
    create_or_replace_view(spark, "orders_lines_v", "orders_lines_src", temporary=True)
    create_or_replace_view(spark, "orders_lines_v", "orders_lines_src", temporary=True)
    v = spark.table("orders_lines_v")
    return v.select(*[F.col(c).cast("double").alias(c) if c in ("discount", "tax") else F.col(c) for c in v.columns])


def schema_evolve(spark, d):
    """K6: add the order-time column when it is missing; a column already there is left alone."""
    from tallyspark.sources.catalog import add_columns_if_missing
    base = A.orders_a(spark, d).select("line_id", "sku", "order_date")
    return add_columns_if_missing(base, {"注文時間": "string", "sku": "string"})


def schema_history(spark, d):
    """K6 on stored partitions: rows loaded before and after the order-time column was added, read as one table.

    Two versions are read: the newest one and the one before the column.
    """
    import uuid

    from tallyspark.session import work_dir
    from tallyspark.sources import snapshots as S
    o = A.order_lines(spark, d).select("line_id", "sku", "order_date", "order_day", F.concat((F.col("line_id") % 24).cast("string"), F.lit(":05")).alias("注文時間"))
    cut = F.to_date(F.lit(SINCE))
    table = f"{work_dir(spark)}/orders-{uuid.uuid4().hex}"
    year = F.concat(F.substring("order_date", 1, 4), F.lit("-01-01")).alias("year")       # one partition a year
    S.append(spark, table, o.where(F.col("order_day") < cut).select("line_id", "sku", "order_date", year), "year")
    S.add_column(spark, table, "注文時間", "string")
    S.append(spark, table, o.where(F.col("order_day") >= cut).select("line_id", "sku", "order_date", year, "注文時間"), "year")
    before = S.read(spark, table, 1).withColumn("注文時間", F.lit("not there")).withColumn("version", F.lit("first"))
    return S.read(spark, table).withColumn("version", F.lit("newest")).unionByName(before).select("version", "line_id", "sku", "order_date", "注文時間")


def target_month(spark, d):
    o = A.read(spark, d, "orders").select(F.to_date("o_orderdate").alias("od")).distinct()
    return o.select(D.iso_text("od").alias("order_date"), D.target_month("od").alias("target_month"))


def trailing_window(spark, d):
    o = A.read(spark, d, "orders").agg(F.date_add(F.max(F.to_date("o_orderdate")), 1).alias("as_of"))
    return o.select(F.explode(F.sequence(F.date_sub("as_of", 14), F.date_sub("as_of", 1))).alias("d")) \
            .select(D.iso_text("d").alias("d"))


# ---- profile (S17, R9, P12) -----------------------------------------------------

def column_profile(spark, d):
    return _column_profile(A.orders_a(spark, d))


def column_sketch(spark, d):
    """The one-scan profile with sample values (the approximate distinct counts are tested, not compared)."""
    p = _column_sketch(A.orders_a(spark, d))
    return p.select("column", "type", "rows", "non_blank", "min_value", "max_value", F.array_join("samples", "|").alias("samples"))


def column_probe(spark, d):
    return R.project_by_name(A.orders_a(spark, d))


# ---- alert policy (Q7-Q9) ---------------------------------------------------------

def _alert_inputs(spark, d):
    status = _status(spark, d)
    missing = status.where(~F.col("present")).select("d", F.col("tbl").alias("label"))
    sets = AL.missing_sets(missing)
    zero = zero_delivery(spark, d).select("d", "is_zero")
    ledger = (sets.where(F.col("d") >= LEDGER_FROM)
              .select(F.col("d").alias("target"), "digest",
                      (F.to_timestamp(F.col("d")) + F.expr("INTERVAL 1 DAYS 15 HOURS 30 MINUTES")).alias("sent_at")))
    return sets, zero, ledger


def alert_policy(spark, d):
    sets, zero, ledger = _alert_inputs(spark, d)
    return AL.alerts_due(sets, zero, ledger, NOW)


def alert_policy_files(spark, d):
    sets, zero, ledger = _alert_inputs(spark, d)
    return AL.alerts_due(sets, zero, ledger, NOW_EARLY, order="exempt_first")


REPLAY_TABLES = ("raw_shohin_betsu", "raw_keyword", "raw_rppexp", "raw_item", "raw_affi")
REPLAY_FILES = ("商品別RPP", "KW実績", "RPP費用", "カルテ")


def _arrivals(spark, d, labels, hours):
    """(target, arrived): per day the hour, counted from the day's end, at which each label's rows are there.

    The n-th event type stands for the n-th label; its hour comes from the day's event ids (the last one's may
    lie weeks ahead).
    """
    kinds = ("view", "click", "purchase", "signup", "error")
    e = A.read(spark, d, "events").where(F.col("event_type").isin(*kinds[:len(labels)]))
    per = e.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.pmod(F.sum("event_id"), F.when(F.col("event_type") == "error", 1000).otherwise(hours)).alias("h"))
    label = F.create_map(*[x for k, n in zip(kinds, labels) for x in (F.lit(k), F.lit(n))])[F.col("event_type")]
    return per.groupBy("day").agg(F.collect_list(F.struct(label.alias("label"), "h")).alias("arrived"))


def _run_rows(days, run_days, hours, first_day):
    """One row per day and run: ``hours`` o'clock on each of ``run_days`` days from ``first_day`` days after the day."""
    run = F.explode(F.sequence(F.lit(0), F.lit(run_days - 1)))
    runs = days.select("*", run.alias("k")).select("*", F.explode(F.array(*[F.lit(h) for h in hours])).alias("hour"))
    after = (F.col("k") + first_day - 1) * 24 + F.col("hour")           # hours since the day's end
    at = F.timestamp_seconds(F.unix_seconds(F.to_timestamp("day")) + (after + 24) * 3600)
    return runs.select(at.alias("run_at"), F.date_format("day", "yyyy-MM-dd").alias("target"), "arrived", after.alias("after"),
                       ((F.col("k") * 7 + F.col("hour")) % 5 != 0).alias("send_ok"))


def alert_replay(spark, d):
    """Q7-Q9 replayed: three runs a day for ten days after each day (tables), four runs on the day itself (files).

    The affiliate table's label carries a changing suffix (``raw_affi(stale 40.0h)``).
    """
    zero = (A.read(spark, d, "events").where(F.col("event_type") == "purchase").groupBy(F.to_date("ts").alias("day"))
            .agg((F.count("*") % 3 == 0).alias("is_zero")))
    tables = _run_rows(_arrivals(spark, d, REPLAY_TABLES, 60), 10, (9, 15, 18), 1)
    named = F.transform(F.filter("arrived", lambda x: x["h"] > F.col("after")), lambda x: F.when(
        x["label"] == "raw_affi", F.concat(F.lit("raw_affi(stale "), (F.col("after") + 24).cast("string"), F.lit(".0h)"))).otherwise(x["label"]))
    files = _run_rows(_arrivals(spark, d, REPLAY_FILES, 20), 1, (9, 15, 17, 20), 0)
    late = F.transform(F.filter("arrived", lambda x: x["h"] > F.col("after") + 24), lambda x: x["label"])
    by_day = zero.select(F.date_format("day", "yyyy-MM-dd").alias("target"), "is_zero")
    by_next = zero.select(F.date_format(F.date_add("day", 1), "yyyy-MM-dd").alias("target"), "is_zero")
    t = AL.replay(tables.select("run_at", "target", named.alias("labels"), "send_ok"), by_day)
    f = AL.replay(files.select("run_at", "target", late.alias("labels"), "send_ok"), by_next, order="exempt_first", normalize=False,
                  exemptible=("商品別RPP", "KW実績"))
    out = t.withColumn("kind", F.lit("tables")).unionByName(f.withColumn("kind", F.lit("files")))
    text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("run_at", "last_sent")]
    return out.select("kind", text[0], "target", "missing", "digest", "decision", "expired", text[1])


QUERIES: dict[str, Query] = {
    "unmatched_sku_all": unmatched_sku_all,
    "match_status_day": match_status_day,
    "master_listing": master_listing,
    "unit_cost": unit_cost,
    "daily_pnl": daily_pnl,
    "day_pnl": day_pnl,
    "sku_pnl_day": sku_pnl_day,
    "raw_daily_profile": raw_daily_profile,
    "daily_impressions": daily_impressions,
    "distinct_dates_topk": distinct_dates_topk,
    "distinct_report_dates": distinct_report_dates,
    "distinct_skus_ordered": distinct_skus_ordered,
    "parse_dates": parse_dates,
    "safe_casts": safe_casts,
    "baseline_latest": baseline_latest,
    "spike_guard": spike_guard,
    "spike_report": spike_report,
    "spike_log": spike_log,
    "spike_summary": spike_summary,
    "spike_guard_multi_file": spike_guard_multi_file,
    "missing_dates": missing_dates,
    "missing_dates_not_in": missing_dates_not_in,
    "missing_dates_states": missing_dates_states,
    "completeness_status": completeness_status,
    "completeness_verdict": completeness_verdict,
    "data_age": data_age,
    "day_verdict": day_verdict,
    "freshness": freshness,
    "daily_totals": daily_totals,
    "zero_delivery": zero_delivery,
    "maturation_uplift": maturation_uplift,
    "dedup_by_date": dedup_by_date,
    "dedup_by_key": dedup_by_key,
    "dedup_by_composite": dedup_by_composite,
    "first_writer_wins": first_writer_wins,
    "report_ingest": report_ingest,
    "report_status": report_status,
    "ad_report": ad_report,
    "ad_report_status": ad_report_status,
    "page_analysis": page_analysis,
    "page_analysis_status": page_analysis_status,
    "action_list": action_list,
    "newest_of_day": newest_of_day,
    "report_records": report_records,
    "affiliate_ingest": affiliate_ingest,
    "affiliate_status": affiliate_status,
    "expansion_ingest": expansion_ingest,
    "expansion_status": expansion_status,
    "new_files": new_files,
    "replace_by_date": replace_by_date,
    "upsert_plan": upsert_plan,
    "attribution_refresh": attribution_refresh,
    "latest_per_date": latest_per_date,
    "refresh_window_files": refresh_window_files,
    "backfill_range": backfill_range,
    "file_presence": file_presence,
    "orders_view": orders_view,
    "schema_evolve": schema_evolve,
    "schema_history": schema_history,
    "target_month": target_month,
    "trailing_window": trailing_window,
    "column_profile": column_profile,
    "column_sketch": column_sketch,
    "column_probe": column_probe,
    "alert_policy": alert_policy,
    "alert_policy_files": alert_policy_files,
    "alert_replay": alert_replay,
}
