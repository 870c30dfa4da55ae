"""Remaining ingest paths on generated files: affiliate (I2), expansion (I3), backfill (I4/S16),
explicit-date refresh (F18/I5), the splittable CSV reader (S1), file mtimes (S8, Q3) and K8."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import quality as QL
from tallyspark.plans import ingest as I
from tallyspark.sources import csv_reports as C
from tallyspark.sources import files as FL
from tallyspark.sources.sinks import write_clean


def _write(path, lines, mtime=None, encoding="utf-8-sig"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write("\r\n".join(lines) + "\r\n")
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def test_affiliate_and_expansion_daily(spark, tmpdir_path):
    root, wh = f"{tmpdir_path}/csv_out", f"{tmpdir_path}/wh"
    now = time.mktime((2026, 7, 14, 12, 0, 0, 0, 0, -1))     # a fixed day at noon: no midnight race
    day = "2026-07-14"
    pre = [f"pre{i}" for i in range(11)]
    row = lambda no: ",".join(["2026-07-13 9:05:00", "a", "b", "c", no, "", "100", "1", "1", "ok", "pc", "pc", "x"])
    _write(f"{root}/rms_reports/pending_old.csv", pre + [row("1")], now - 100)
    _write(f"{root}/rms_reports/pending_new.csv", pre + [row(" 1 "), row("2"), row("2")], now - 10)
    pre5 = [f"p{i}" for i in range(5)]
    hdr = ",".join(f"h{i}" for i in range(18))
    exp_row = lambda d, sku: ",".join([d, "url", sku] + ["1"] * 15)
    _write(f"{root}/rppexp_reports/RPPEXP商品別_20260713_0900.csv",
           pre5 + [hdr, exp_row("2026年7月13日", "s1"), exp_row("2026年7月13日", "s1")], now - 50)
    _write(f"{root}/rppexp_reports/RPPEXP商品別_20260713_1000.csv",
           pre5 + [hdr, exp_row("2026-07-13", "s1"), exp_row("2026-07-13", "s2")], now - 40)
    st = {r.family: (r.state, r.message) for r in
          I.run_daily(spark, root, wh, day, families=["raw_affi", "raw_rppexp"]).collect()}
    assert st == {"raw_affi": ("loaded", None), "raw_rppexp": ("loaded", None)}
    affi = sorted(r["受注番号"] for r in spark.read.parquet(f"{wh}/raw_affi").collect())
    assert affi == ["1", "2", "2"]                 # newest file only; no in-file dedup
    exp = sorted((r["日付"], r["商品管理番号"]) for r in spark.read.parquet(f"{wh}/raw_rppexp").collect())
    assert exp == [("2026-07-13", "s1"), ("2026-07-13", "s1"), ("2026-07-13", "s2")]
    I.run_daily(spark, root, wh, day, families=["raw_affi", "raw_rppexp"])
    assert spark.read.parquet(f"{wh}/raw_affi").count() == 3          # known order numbers are dropped
    assert spark.read.parquet(f"{wh}/raw_rppexp").count() == 3


def test_backfill_selection_and_load(spark, tmpdir_path):
    d = f"{tmpdir_path}/rpp_reports"
    hdr = ["日付," + ",".join(f"c{i}" for i in range(41))]
    for name, dt, mt in [("RPP日次12h_20260710_20260711_0900.csv", "2026年07月10日～2026年07月10日", 1),
                         ("RPP日次12h_20260701_0900.csv", "2026年07月01日～2026年07月01日", 2),
                         ("RPP日次12h_20260713_20260714_0900.csv", "2026年07月13日～2026年07月13日", 3)]:
        _write(f"{d}/{name}", hdr + [dt + ",0" * 41], 1_700_000_000 + mt)
    listing = FL.list_files(spark, f"{d}/*.csv")
    sel = FL.backfill_files(listing, "RPP日次12h_", "2026-07-14", 7)
    assert sorted(r.target_date for r in sel.collect()) == ["20260710", "20260713"]
    assert FL.backfill_files(listing, "RPP日次12h_", None, None).count() == 3
    fam = I.FAMILIES["raw_rpp_daily"]
    rows, status = I.ingest_dated(spark, tmpdir_path, fam, f"{tmpdir_path}/wh/raw_rpp_daily")
    assert {r.state for r in status.collect()} == {"ok"}
    assert sorted(r["日付"] for r in rows.collect()) == ["2026-07-01", "2026-07-10", "2026-07-13"]


def test_refresh_explicit_dates_dry_run(spark, tmpdir_path):
    root, wh = f"{tmpdir_path}/csv_out", f"{tmpdir_path}/wh"
    fam = I.FAMILIES["raw_shohin_betsu"]
    target = f"{wh}/raw_shohin_betsu"
    spark.createDataFrame([("2026-07-10", "a", "1")], "`日付` string, `商品管理番号` string, orders string") \
        .withColumn("pdate", F.to_date(F.lit("2026-07-10"))).write.partitionBy("pdate").parquet(target)
    hdr = "日付,商品管理番号,orders"
    _write(f"{root}/rpp_reports/RPP商品別12h_20260710_0900.csv", [hdr, "2026年07月10日～2026年07月10日,a,5"])
    _write(f"{root}/rpp_reports/RPP商品別12h_20260711_0900.csv", [hdr, "2026年07月11日～2026年07月11日,a,6"])
    plan = I.refresh_window(spark, root, fam, target, None, dates="2026-07-10 bad", dry_run=True).first()
    assert (plan.n_dates, plan.first_date, plan.rows) == (1, "2026-07-10", 1)
    assert spark.read.parquet(target).first().orders == "1"              # dry run wrote nothing
    I.refresh_window(spark, root, fam, target, None, dates="20260710", today=None)
    assert [r.orders for r in spark.read.parquet(target).collect()] == ["5"]


def test_splittable_reader_and_header_check(spark, tmpdir_path):
    _write(f"{tmpdir_path}/s1/a.csv", ["日付,クリック数合計", "2026-07-13,NA", "2026-07-14,3"])
    _write(f"{tmpdir_path}/s1/b.csv", ["日付,クリック数合計", "2026-07-15,null"])
    df = C.read_report_csv(spark, f"{tmpdir_path}/s1/*.csv")
    assert sorted((r["日付"], r["クリック数合計"]) for r in df.collect()) == [
        ("2026-07-13", ""), ("2026-07-14", "3"), ("2026-07-15", "")]
    assert "source_file" in df.columns
    _write(f"{tmpdir_path}/s1x/a.csv", ["日付,x", "1,2"])
    _write(f"{tmpdir_path}/s1x/b.csv", ["x,日付", "3,4"])
    with pytest.raises(Exception):
        C.read_report_csv(spark, f"{tmpdir_path}/s1x/*.csv").collect()   # headers disagree: fail, not shift


def test_mtimes_freshness_and_clean_writer(spark, tmpdir_path):
    now = time.time()
    _write(f"{tmpdir_path}/t/a/x.csv", ["h", "1"], now - 35 * 3600)
    _write(f"{tmpdir_path}/t/b/x.csv", ["h", "1"], now - 37 * 3600)
    listing = FL.list_files(spark, f"{tmpdir_path}/t/*/*.csv") \
        .select(F.regexp_extract("path", r"/t/([ab])/", 1).alias("tbl"), F.col("mtime").alias("modified"))
    now_s = time.strftime("%Y-%m-%d %H:%M:%S", time.localtime(now))
    spark.conf.set("spark.sql.session.timeZone", time.strftime("%Z") or "UTC")
    got = {r.tbl: r.state for r in QL.freshness(listing, now_s).collect()}
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == {"a": "fresh", "b": "stale"}
    today = time.strftime("%Y-%m-%d", time.localtime(now - 35 * 3600))
    assert FL.modified_on(FL.list_files(spark, f"{tmpdir_path}/t/*/*.csv"), today).count() >= 1
    out = f"{tmpdir_path}/clean"
    write_clean(spark.createDataFrame([("2026-07-13", "a")], "d string, v string"), out, partition_by="d")
    assert spark.read.parquet(out).count() == 1


def test_quoted_line_break_is_refused_not_misparsed(spark, tmpdir_path):
    _write(f"{tmpdir_path}/q/ok.csv", ["a,b", '"x,y",1'])
    _write(f"{tmpdir_path}/q/bad.csv", ["a,b", '"line one', 'line two",2'])
    with pytest.raises(ValueError):
        C.read_header_csvs(spark, f"{tmpdir_path}/q/*.csv")
    rows = C.read_header_csvs(spark, f"{tmpdir_path}/q/*.csv", on_quoted_newline="skip")
    assert [(r.a, r.b) for r in rows.collect()] == [("x,y", "1")]
    ml = C.read_report_csv(spark, f"{tmpdir_path}/q/bad.csv", multi_line=True)
    assert [(r.a.replace("\r", ""), r.b) for r in ml.collect()] == [("line one\nline two", "2")]


def test_two_layouts_one_pass(spark, tmpdir_path):
    _write(f"{tmpdir_path}/v/a.csv", ["日付,x", "2026-07-13,1", "2026-07-14,NA"])
    _write(f"{tmpdir_path}/v/b.csv", ["y,日付", "9,2026-07-15"])
    df = C.read_header_csvs(spark, f"{tmpdir_path}/v/*.csv")
    assert sorted(c for c in df.columns if not c.startswith("source_")) == ["x", "y", "日付"]
    got = sorted((r["日付"], r.x, r.y) for r in df.collect())
    assert got == [("2026-07-13", "1", ""), ("2026-07-14", "", ""), ("2026-07-15", "", "9")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan binaryFile") == 1 or "Scan binaryFile" in plan


def test_refresh_warns_about_ignored_date_tokens(spark, tmpdir_path, caplog):
    import logging
    root, wh = f"{tmpdir_path}/csv_out", f"{tmpdir_path}/wh"
    _write(f"{root}/rpp_reports/RPP商品別12h_20260710_0900.csv", ["日付,商品管理番号", "2026年07月10日～2026年07月10日,a"])
    with caplog.at_level(logging.WARNING, logger="tallyspark.plans.ingest"):
        plan = I.refresh_window(spark, root, I.FAMILIES["raw_shohin_betsu"], f"{wh}/raw_shohin_betsu", None,
                                dates="2026-07-10, 7/10, x", dry_run=True)
    assert plan.first().rows == 1
    assert "7/10" in caplog.text and "x" in caplog.text


def test_backfill_job_loads_the_named_range(spark, tmpdir_path):
    hdr = "日付," + ",".join(f"c{i}" for i in range(41))
    for name, dt in (("RPP日次12h_20260701_0900.csv", "2026年07月01日～2026年07月01日"), ("RPP日次12h_20260713_0900.csv", "2026年07月13日～2026年07月13日")):
        _write(f"{tmpdir_path}/rpp_reports/{name}", [hdr, dt + ",0" * 41])
    fam = I.FAMILIES["raw_rpp_daily"]
    rows, _ = I.backfill(spark, tmpdir_path, fam, f"{tmpdir_path}/wh/x", "2026-07-14")
    assert [r["日付"] for r in rows.collect()] == ["2026-07-13"]
    rows, _ = I.backfill(spark, tmpdir_path, fam, f"{tmpdir_path}/wh/x", "2026-07-14", days=None)
    assert rows.count() == 2


def test_quotes_backslashes_and_extra_fields(spark, tmpdir_path):
    """A doubled quote is a quote, a backslash a character; a bad file is rejected with its reason and hides no other."""
    d = f"{tmpdir_path}/q"
    _write(f"{d}/good.csv", ["日付,名", '2026-07-13,"a ""b"", c"', '2026-07-13,"C:\\"'])
    _write(f"{d}/wide.csv", ["日付,名", "2026-07-13,p,EXTRA"])
    _write(f"{d}/open.csv", ["日付,名", '2026-07-13,"two', 'lines"'])
    _write(f"{d}/other.csv", ["x,y", "1,2"])
    rows, status = C.parse_header_lines(C.read_lines(spark, f"{d}/*.csv"), ["日付"])
    assert sorted(r["名"] for r in rows.collect()) == sorted(['a "b", c', "C:\\"])
    got = {r.path.rsplit("/", 1)[-1]: (r.state, r.reason) for r in status.collect()}
    assert got == {"good.csv": ("ok", None), "wide.csv": ("rejected", "fields 3 > 2"), "open.csv": ("rejected", "quoted line break"), "other.csv": ("rejected", "missing column 日付")}


def test_malformed_bytes_are_replaced_and_counted(spark, tmpdir_path):
    import os
    os.makedirs(f"{tmpdir_path}/m")
    with open(f"{tmpdir_path}/m/a.csv", "wb") as f:
        f.write("日付,名\n2026-07-13,犬".encode("cp932") + b"\xff\n")
    rows, status = C.parse_header_lines(C.read_lines(spark, f"{tmpdir_path}/m/a.csv", "MS932"), ["日付"])
    assert rows.count() == 1 and status.first().replaced_chars >= 1


def test_daily_run_reports_every_file_and_guards_the_first_load(spark, tmpdir_path):
    root = f"{tmpdir_path}/in"
    hdr = "日付,商品管理番号,キーワード,目安CPC"
    for k, (name, line) in enumerate({"RPPキーワード別12h_20260713_0900.csv": "2026-07-13,a,k,66", "RPPキーワード別12h_20260714_0900.csv": "2026-07-14,a,k,1001"}.items()):
        _write(f"{root}/rpp_reports/{name}", [hdr, line], 1_784_000_000 + k)
    _write(f"{root}/rpp_reports/RPPキーワード別12h_bad.csv", ["a,b", "1,2"], 1_784_000_000)
    out = I.run_daily(spark, root, f"{tmpdir_path}/wh", None, as_of="2026-07-15", families=["raw_keyword", "raw_item"]).collect()
    assert sorted((r.family, r.state) for r in out) == [("raw_item", "no_files"), ("raw_keyword", "loaded"), ("raw_keyword", "loaded"), ("raw_keyword", "rejected")]
    t = {r["日付"]: r["目安CPC"] for r in spark.read.parquet(f"{tmpdir_path}/wh/raw_keyword").collect()}
    assert t == {"2026-07-13": "66", "2026-07-14": ""}


def test_report_files_come_in_bounded_cells(spark):
    from tallyspark.plans import queries as Q
    from tallyspark.sources import csv_reports as C
    sf = "/root/testdata/sf0.001"
    whole, dealt = Q._report_files(spark, sf), Q._report_files(spark, sf, 5)
    lines = [(r.path, r.part, r.content.decode().count("\n") + 1) for r in dealt.collect()]
    assert max(n for _, _, n in lines) <= 20 and len(lines) > 2 * whole.count()
    a, b = (sorted((r.path, r.line) for r in Q._report_lines(f).collect()) for f in (whole, dealt))
    assert a == b and len(a) == sum(n for _, _, n in lines)
    a, b = (sorted(map(tuple, C.screen_files(Q._report_lines(f), ["日付"]).collect())) for f in (whole, dealt))
    assert a == b and {r[1] for r in a} == {"ok", "rejected"}
