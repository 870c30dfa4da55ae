"""Every listed file has a status row, and no reader cuts a line silently."""

import os

from tallyspark.plans import ingest as I
from tallyspark.sources import csv_reports as C


def write(path, lines, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write("\n".join(lines) + "\n")


def states(status):
    return {os.path.basename(r.path): (r.state, r.reason) for r in status.collect()}


def test_preamble_files_without_data_and_with_open_cells(spark, tmpdir_path):
    pre, row = [f"p{i}" for i in range(11)], ",".join("v" * 13)
    d = f"{tmpdir_path}/a"
    write(f"{d}/ok.csv", pre + [row])
    write(f"{d}/quotes_in_preamble.csv", ['a "b'] + pre[1:] + [row])
    write(f"{d}/only_preamble.csv", pre)
    write(f"{d}/shorter.csv", pre[:3])
    write(f"{d}/blank_tail.csv", pre + ["", ""])
    write(f"{d}/open.csv", pre + [row, 'v,"two', 'lines",' + ",".join("v" * 11)])
    write(f"{d}/short.csv", pre + ["a,b"])
    rows, status = C.read_affiliate(spark, f"{d}/*.csv")
    none = ("rejected", "no data lines")
    assert states(status) == {"ok.csv": ("ok", None), "quotes_in_preamble.csv": ("ok", None), "only_preamble.csv": none, "shorter.csv": none, "blank_tail.csv": none,
                              "open.csv": ("rejected", "quoted line break"), "short.csv": ("rejected", "columns 2 < 13")}
    assert {os.path.basename(r.source_file) for r in rows.collect()} == {"ok.csv", "quotes_in_preamble.csv"} and rows.count() == 2


def test_wide_lines_are_rejected_not_cut(spark, tmpdir_path):
    d = f"{tmpdir_path}/w"
    write(f"{d}/ad_ok.csv", ["x", '"日付","CTR(%)"', "2026-07-13,1"], "cp932")
    write(f"{d}/ad_wide.csv", ["x", '"日付","CTR(%)"', "2026-07-13,1,EXTRA"], "cp932")
    write(f"{d}/ad_other_layout.csv", ['"商品","日付","CTR(%)"', "s,2026-07-13,2"], "cp932")
    write(f"{d}/ad_none.csv", ["no marker", "1,2,3,4"], "cp932")
    rows, status = C.read_ad_report(spark, f"{d}/ad_*.csv")
    assert states(status) == {"ad_ok.csv": ("ok", None), "ad_wide.csv": ("rejected", "fields 3 > 2"), "ad_other_layout.csv": ("ok", None), "ad_none.csv": ("header_not_found", None)}
    got = {os.path.basename(r.source_file): (r["日付"], r["商品"], r["CTR(%)"]) for r in rows.where("`日付` <> ''").collect()}
    assert got == {"ad_ok.csv": ("2026-07-13", "", "1"), "ad_other_layout.csv": ("2026-07-13", "s", "2")}
    write(f"{d}/page_ok.csv", ["t", "x", "期間,2026年07月13日", "", "", "商品管理番号,PV", "s,1"])
    write(f"{d}/page_wide.csv", ["t", "x", "期間,2026年07月13日", "", "", "商品管理番号,PV", "s,1,2"])
    write(f"{d}/page_open.csv", ["t", "x", "期間,2026年07月13日", "", "", "商品管理番号,PV", 's,"1', '2"'])
    write(f"{d}/page_undated.csv", ["t", "x", "期間,?", "", "", "商品管理番号,PV", "s,1"])
    rows, status = C.read_page_analysis(spark, f"{d}/page_*.csv")
    assert states(status) == {"page_ok.csv": ("ok", None), "page_wide.csv": ("rejected", "fields 4 > 3"), "page_open.csv": ("rejected", "quoted line break"), "page_undated.csv": ("rejected", "no date in line 3")}
    assert [tuple(r)[:3] for r in rows.collect()] == [("2026-07-13", "s", "1")]
    write(f"{d}/act_20260713.csv", ["t", "x", "kw,n", "犬,3"], "cp932")
    write(f"{d}/act_20260714.csv", ["t", "x", "kw,n", "犬,3,4"], "cp932")
    write(f"{d}/act_20260715.csv", ["t", "x", "kw,n"], "cp932")
    rows, status = C.read_action_list(spark, f"{d}/act_*.csv")
    assert states(status) == {"act_20260713.csv": ("ok", None), "act_20260714.csv": ("rejected", "fields 4 > 3"), "act_20260715.csv": ("rejected", "fewer than 4 lines")}
    assert [tuple(r)[:3] for r in rows.collect()] == [("2026-07-13", "犬", "3")]


def test_daily_run_has_a_row_for_every_file(spark, tmpdir_path):
    root = f"{tmpdir_path}/in"
    write(f"{root}/rms_reports/pending_1.csv", [f"p{i}" for i in range(11)])
    write(f"{root}/rppexp_reports/RPPEXP商品別_1.csv", ["p"] * 5)
    write(f"{root}/rppexp_reports/RPPEXP商品別_2.csv", ["p"] * 5 + [",".join("h" * 18), "2026-07-13,u,s," + ",".join("1" * 15)])
    out = I.run_daily(spark, root, f"{tmpdir_path}/wh", None, families=["raw_affi", "raw_rppexp"], versioned=True).collect()
    assert sorted((r.family, r.state, r.message) for r in out) == [
        ("raw_affi", "rejected", "no data lines"), ("raw_rppexp", "loaded", None), ("raw_rppexp", "rejected", "no data lines")]
