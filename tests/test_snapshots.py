"""Versioned tables: all or nothing, conflicts, columns over time, and the jobs on top."""

import os

import pytest
from pyspark.sql import functions as F

from tallyspark.sources import snapshots as S

JP = "2026年07月{:02d}日～2026年07月{:02d}日"


def rows(spark, data, cols="`日付` string, sku string, n string"):
    return spark.createDataFrame(data, cols)


def contents(spark, table, version=None):
    return sorted((r["日付"], r.sku, r.n) for r in S.read(spark, table, version).select("日付", "sku", "n").collect())


@pytest.fixture()
def table(spark, tmpdir_path):
    t = f"{tmpdir_path}/snap"
    S.append(spark, t, rows(spark, [(JP.format(1, 1), "a", "1"), ("2026-07-01", "b", "2"), ("2026-07-02", "c", "3"), ("合計", "z", "9")]), "日付")
    return t


def test_replace_takes_both_spellings_and_returns_rejected(spark, table):
    before = contents(spark, table)
    done = S.replace_days(spark, table, rows(spark, [("2026-07-01", "a", "11"), ("2026-07-03", "d", "4"), ("合計", "x", "8"), ("2026-13-45", "y", "7")]))
    assert (done.version, done.days, done.rows) == (2, 2, 2)
    assert sorted(r.sku for r in done.rejected.collect()) == ["x", "y"]
    assert contents(spark, table) == [("2026-07-01", "a", "11"), ("2026-07-02", "c", "3"), ("2026-07-03", "d", "4"), ("合計", "z", "9")]
    assert contents(spark, table, 1) == before                                     # the old version still reads


@pytest.mark.parametrize("where", ["write", "publish"])
def test_failure_before_the_swap_leaves_the_table(spark, table, monkeypatch, where):
    before = contents(spark, table)

    def broken(*_):
        raise RuntimeError("executor lost")

    if where == "publish":                                                          # the load is written in full, the rename never happens
        monkeypatch.setattr(S, "_publish", broken)
        staged = rows(spark, [("2026-07-01", "new", "0"), ("2026-07-02", "new", "0")])
    else:                                                                           # a task dies in the midst of the write
        staged = rows(spark, [("2026-07-01", "new", "0"), ("2026-07-02", "new", "0")]).withColumn(
            "n", F.when(F.col("日付") == "2026-07-02", F.raise_error(F.lit("boom"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="executor lost|boom"):
        S.replace_days(spark, table, staged)
    monkeypatch.undo()
    assert contents(spark, table) == before and S.versions(spark, table) == [1]
    assert len(S.unreferenced(spark, table)) == 1
    assert S.replace_days(spark, table, rows(spark, [("2026-07-01", "new", "0")])).version == 2
    assert ("2026-07-01", "new", "0") in contents(spark, table)


def test_empty_staging_publishes_nothing(spark, table):
    assert S.replace_days(spark, table, rows(spark, [("合計", "x", "8")])).version is None
    assert S.replace_days(spark, table, rows(spark, [])).version is None
    assert S.versions(spark, table) == [1]


def test_reader_keeps_its_version(spark, table):
    old = S.read(spark, table)
    S.replace_days(spark, table, rows(spark, [("2026-07-02", "c", "30")]))
    assert sorted(r.n for r in old.where("sku = 'c'").collect()) == ["3"]
    assert sorted(r.n for r in S.read(spark, table).where("sku = 'c'").collect()) == ["30"]


def test_two_writers(spark, table, monkeypatch):
    real, raced = S._publish, []

    def race(spark, t, m):
        if not raced:                                                               # another writer is faster, once
            raced.append(1)
            monkeypatch.setattr(S, "_publish", real)
            S.append(spark, t, rows(spark, [("2026-07-09", "other", "1")]), "日付")
        real(spark, t, m)

    monkeypatch.setattr(S, "_publish", race)
    assert S.replace_days(spark, table, rows(spark, [("2026-07-02", "c", "30")])).version == 3
    got = contents(spark, table)
    assert ("2026-07-09", "other", "1") in got and ("2026-07-02", "c", "30") in got and ("2026-07-02", "c", "3") not in got
    with pytest.raises(S.Conflict):                                                 # rows chosen against an older version
        S.append(spark, table, rows(spark, [("2026-07-10", "x", "1")]), "日付", based_on=1)
    assert not any(n.startswith(".") and not n.endswith(".crc") for n in os.listdir(f"{table}/manifest"))


def test_columns_over_time(spark, table):
    assert S.add_column(spark, table, "注文時間") and not S.add_column(spark, table, "注文時間")
    S.append(spark, table, rows(spark, [("2026-07-05", "e", "5", "10:00")], "`日付` string, sku string, n string, `注文時間` string"), "日付")
    t = S.read(spark, table)
    assert t.columns == ["日付", "sku", "n", "注文時間", "pdate"]
    assert {(r.sku, r["注文時間"]) for r in t.collect()} == {("a", None), ("b", None), ("c", None), ("z", None), ("e", "10:00")}
    assert [m.schema.names for m in S.history(spark, table)] == [["日付", "sku", "n"]] + [["日付", "sku", "n", "注文時間"]] * 2
    with pytest.raises(ValueError, match="is string, not int"):
        S.append(spark, table, rows(spark, [("2026-07-05", 5)], "`日付` string, sku int"), "日付")


def test_only_wanted_days_are_listed(spark, table):
    t = S.read(spark, table, from_day="2026-07-02")
    assert sorted(r.sku for r in t.collect()) == ["c", "z"] and len(t.inputFiles()) == 2


def test_compact_keeps_rows(spark, table):
    for i in range(3):
        S.append(spark, table, rows(spark, [("2026-07-01", f"m{i}", "1")]), "日付")
    before = contents(spark, table)
    m = S.compact(spark, table)
    assert {d: len(x) for d, x in m.days.items()} == {d: 1 for d in m.days} and contents(spark, table) == before
    assert S.compact(spark, table) is None


def test_missing_table(spark, tmpdir_path):
    assert S.read(spark, f"{tmpdir_path}/none") is None and S.versions(spark, f"{tmpdir_path}/none") == []
    with pytest.raises(ValueError, match="no version"):
        S.replace_days(spark, f"{tmpdir_path}/none", rows(spark, [("2026-07-01", "a", "1")]))


def test_daily_run_and_refresh_on_versioned_tables(spark, tmpdir_path):
    from tallyspark.plans import ingest as I
    root, wh = f"{tmpdir_path}/in", f"{tmpdir_path}/wh"
    os.makedirs(f"{root}/rpp_reports")
    path = f"{root}/rpp_reports/RPP商品別12h_20260710_0900.csv"
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("日付,商品管理番号,orders\n" + f"{JP.format(10, 10)},a,1\n")
    day = spark.range(1).select(F.current_date()).first()[0]
    fam, target = I.FAMILIES["raw_shohin_betsu"], f"{wh}/raw_shohin_betsu"
    first = I.run_daily(spark, root, wh, None, families=["raw_shohin_betsu"], versioned=True).collect()
    assert [r.state for r in first] == ["loaded"] and S.versions(spark, target) == [1]
    I.run_daily(spark, root, wh, None, families=["raw_shohin_betsu"])                 # nothing new: no new version
    assert S.versions(spark, target) == [1]
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("日付,商品管理番号,orders\n" + f"{JP.format(10, 10)},a,5\n")
    plan = I.refresh_window(spark, root, fam, target, day, dates="2026-07-10", today=None)
    assert plan.first().rows == 1 and S.versions(spark, target) == [1, 2]
    assert [r.orders for r in S.read(spark, target).collect()] == ["5"]
