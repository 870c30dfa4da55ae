"""Report files end to end: readers (S1-S7, S14), daily ingest (I1-I3, I6), refresh (I5), file stream."""

import os
import time
import zipfile

from pyspark.sql import functions as F

from tallyspark.plans import ingest as I
from tallyspark.sources import csv_reports as C
from tallyspark.sources import files as FL
from tallyspark.streaming.report_stream import start_dated_ingest


def _write(path, lines, encoding="utf-8-sig", mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write("\r\n".join(lines) + "\r\n")
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path


def test_ad_report_cp932_header_finder(spark, tmpdir_path):
    p = _write(f"{tmpdir_path}/raw/a.csv", ["レポート,商品別", "期間,2026/07/13", '"日付","商品管理番号","CTR(%)"',
                                           '"2026年07月13日～2026年07月13日","bird-ref","1.5"',
                                           '"2026年07月13日～2026年07月13日","gips,arm","NA"'], encoding="cp932")
    _write(f"{tmpdir_path}/raw/b.csv", ["no header here", "x,y"], encoding="cp932")
    rows, status = C.read_ad_report(spark, f"{tmpdir_path}/raw/*.csv")
    got = sorted((r["日付"][:11], r["商品管理番号"], r["CTR(%)"]) for r in rows.where(F.col("source_file").endswith("a.csv")).collect())
    assert got == [("2026年07月13日", "bird-ref", "1.5"), ("2026年07月13日", "gips,arm", "")]
    st = {os.path.basename(r.path): r.state for r in status.collect()}
    assert st == {"a.csv": "ok", "b.csv": "header_not_found"}


def test_affiliate_and_expansion_preambles(spark, tmpdir_path):
    pre = [f"preamble {i}" for i in range(11)]
    good = ",".join(f"v{i}" for i in range(13)) + ",extra"
    _write(f"{tmpdir_path}/aff/pending_ok.csv", pre + [good, "", "2026-07-13 9:05:00," + ",".join(["x"] * 12)])
    _write(f"{tmpdir_path}/aff/pending_short.csv", pre + ["a,b,c"])
    rows, status = C.read_affiliate(spark, f"{tmpdir_path}/aff/*.csv")
    assert rows.count() == 2 and len(rows.columns) == 13 + 2
    assert {os.path.basename(r.path): r.state for r in status.collect()} == {"pending_ok.csv": "ok",
                                                                            "pending_short.csv": "rejected"}
    pre5 = [f"p{i}" for i in range(5)]
    hdr = ",".join(f"h{i}" for i in range(18))
    _write(f"{tmpdir_path}/exp/RPPEXP商品別_20260713_0900.csv",
           pre5 + [hdr, "2026年7月13日,url,sku1," + ",".join(["1"] * 15)])
    rows, status = C.read_expansion(spark, f"{tmpdir_path}/exp/*.csv")
    r = rows.first()
    assert r["日付"] == "2026年7月13日" and r["商品管理番号"] == "sku1" and rows.count() == 1


def test_page_analysis_action_list_daily_totals(spark, tmpdir_path):
    _write(f"{tmpdir_path}/page/店舗カルテ_商品ページ分析_20260714_0900.csv",
           ["t", "x", "対象期間,2026年07月13日", "", "", "商品管理番号,PV", "sku1,10", "sku2,20"])
    rows, status = C.read_page_analysis(spark, f"{tmpdir_path}/page/*.csv")
    assert sorted((r["対象日"], r["商品管理番号"], r.PV) for r in rows.collect()) == [
        ("2026-07-13", "sku1", "10"), ("2026-07-13", "sku2", "20")]
    _write(f"{tmpdir_path}/act/店舗カルテ_自然検索_20260713.csv", ["t", "x", "kw,n", "鳩よけ,3"], encoding="cp932")
    rows, _ = C.read_action_list(spark, f"{tmpdir_path}/act/*.csv")
    assert [(r["対象日"], r.kw, r.n) for r in rows.collect()] == [("2026-07-13", "鳩よけ", "3")]
    hdr42 = ",".join(f"c{i}" for i in range(42))
    _write(f"{tmpdir_path}/dt/RPP日次12h_20260713_20260714_0900.csv", [hdr42, "日,a,b,0,,x"], encoding="cp932")
    _write(f"{tmpdir_path}/dt/RPP日次12h_20260713_20260714_1000.csv", [",".join(["c"] * 41), "日,a,b,5,5"],
           encoding="cp932")
    t = C.daily_totals_scan(spark, f"{tmpdir_path}/dt/*.csv").collect()
    got = sorted((r.n_cols, r.clicks_text, r.cost_text) for r in t)
    assert got == [(41, "5", "5"), (42, "0", "")]


def test_zip_first_csv_of_newest(spark, tmpdir_path):
    d = f"{tmpdir_path}/zips"
    os.makedirs(d)
    for name, content, mt in [("old.zip", "old", 1000), ("new.zip", "new", 2000)]:
        zp = f"{d}/{name}"
        with zipfile.ZipFile(zp, "w") as z:
            z.writestr("b.csv", f'"CTR(%)",x\r\n1,{content}b'.encode("cp932"))
            z.writestr("a.csv", f'pre\r\n"CTR(%)",x\r\n1,{content}a'.encode("cp932"))
        os.utime(zp, (mt, mt))
    lines = C.zipped_report_lines(spark, f"{d}/*.zip")
    kept, _ = C.clean_report_lines(lines)
    rows = C.parse_with_headers(kept, C.header_at(kept, 0))
    assert [r.x for r in rows.collect()] == ["newa"]


def test_file_listing_helpers(spark, tmpdir_path):
    for name, mt in [("RPP商品別12h_20260713_0900.csv", 100), ("RPP商品別12h_20260713_1000.csv", 200),
                     ("RPP商品別12h_summary.csv", 300)]:
        _write(f"{tmpdir_path}/l/{name}", ["a"], mtime=mt)
    listing = FL.list_files(spark, f"{tmpdir_path}/l/*.csv")
    latest = FL.latest_file_per_date(listing).collect()
    assert [(r.d8, os.path.basename(r.path)) for r in latest] == [("20260713", "RPP商品別12h_20260713_1000.csv")]
    ledger = listing.where(F.col("name").contains("0900")).select("path")
    new = FL.new_since(listing, ledger, "1970-01-01 00:00:00")
    assert new.count() == 2


def _report(root, fam_dir, name, rows, mtime, header=("日付", "商品管理番号", "キーワード", "目安CPC")):
    return _write(f"{root}/{fam_dir}/{name}", [",".join(header)] + [",".join(r) for r in rows], mtime=mtime)


def test_daily_ingest_refresh_and_stream(spark, tmpdir_path):
    root, wh = f"{tmpdir_path}/csv_out", f"{tmpdir_path}/wh"
    now = time.mktime((2026, 7, 14, 12, 0, 0, 0, 0, -1))     # a fixed day at noon: no midnight race
    day = "2026-07-14"
    jp = "2026年07月13日～2026年07月13日"
    _report(root, "rpp_reports", "RPPキーワード別12h_20260713_0900.csv",
            [(jp, "bird-ref", "鳩よけ", "66"), (jp, "bird-ref", "鳩よけ", "66")], now - 60)
    _report(root, "rpp_reports", "RPPキーワード別12h_20260713_1000.csv", [("2026-07-13", "x", "y", "1")], now - 30)
    status = {r.family: r.state for r in I.run_daily(spark, root, wh, day, as_of="2026-07-15",
                                                      families=["raw_keyword", "raw_item"]).collect()}
    assert status == {"raw_keyword": "loaded", "raw_item": "no_files"}
    t = spark.read.parquet(f"{wh}/raw_keyword")
    assert t.count() == 2 and {r["日付"] for r in t.collect()} == {"2026-07-13"}   # first file wins, dups kept
    # the same files again (now with a history for the spike guard): nothing new
    again = I.run_daily(spark, root, wh, day, as_of="2026-07-15", families=["raw_keyword"]).first()
    assert again.state == "loaded", again.message
    assert spark.read.parquet(f"{wh}/raw_keyword").count() == 2
    # a matured re-fetch of 07-13 replaces that day
    _report(root, "rpp_reports", "RPPキーワード別12h_20260713_1500.csv",
            [(jp, "bird-ref", "鳩よけ", "70")], now)
    plan = I.refresh_window(spark, root, I.FAMILIES["raw_keyword"], f"{wh}/raw_keyword", "2026-07-20", days=14, today=day)
    assert plan.first().rows == 1
    after = spark.read.parquet(f"{wh}/raw_keyword").collect()
    assert [(r["日付"], r["目安CPC"]) for r in after] == [("2026-07-13", "70")]
    # file stream: new files only, exactly once across restarts
    src = f"{tmpdir_path}/stream_in"
    _report(src, ".", "RPP商品別12h_20260714_0900.csv", [("2026-07-14", "a", "k", "1")], now)
    ckpt = f"{tmpdir_path}/stream_ckpt"
    q = start_dated_ingest(spark, src, f"{wh}/raw_shohin_betsu", ckpt, "日付")
    q.awaitTermination(120)
    _report(src, ".", "RPP商品別12h_20260715_0900.csv", [("2026-07-15", "a", "k", "2"), ("2026-07-14", "b", "k", "3")],
            now + 1)
    q = start_dated_ingest(spark, src, f"{wh}/raw_shohin_betsu", ckpt, "日付")
    q.awaitTermination(120)
    got = sorted((r["日付"], r["商品管理番号"]) for r in spark.read.parquet(f"{wh}/raw_shohin_betsu").collect())
    assert got == [("2026-07-14", "a"), ("2026-07-15", "a")]
