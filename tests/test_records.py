"""Records of report files: line breaks in cells, files split over tasks, files that must be rejected."""

import csv
import io
import random

import pytest

from tallyspark.sources import records as RC


@pytest.fixture()
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def cells(rng, i, wild):
    hard = ['a "q" b', "x,y", "l1\nl2", "c1\r\nc2", '"', '""', "\n", "日本語\n二行", "", "\\", "long " * 900 + "\n" * 30]
    return [str(i), rng.choice(hard) if wild else f"plain {i}", rng.choice(["商品", "b"])]


def report(path, n, wild, end="\n", encoding="utf-8", seed=1):
    rng = random.Random(seed)
    rows = [cells(rng, i, wild and rng.random() < 0.5) for i in range(n)]
    out = io.StringIO()
    w = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=end)
    w.writerow(["no", "text", "名"])
    w.writerows(rows)
    with open(path, "wb") as f:
        f.write(out.getvalue().encode(encoding))
    return rows


def got(rows, name):
    r = rows.where(rows.source_file.contains(name)).orderBy("source_line").collect()
    return [[x.no, x.text, x["名"]] for x in r]


def test_one_file_over_many_tasks(spark, tmpdir_path, small_blocks):
    want = report(f"{tmpdir_path}/a.csv", 600, True)
    assert RC.physical_lines(spark, [f"{tmpdir_path}/a.csv"]).rdd.getNumPartitions() >= 4
    rows, status = RC.read_report_records(spark, [f"{tmpdir_path}/a.csv"], required=["no"])
    assert got(rows, "a.csv") == want
    assert [(r.state, r.reason) for r in status.collect()] == [("ok", None)]


def test_files_of_every_kind_together(spark, tmpdir_path, small_blocks):
    p = str(tmpdir_path)
    want = {"a": report(f"{p}/a.csv", 200, True, seed=2), "b": report(f"{p}/b.csv", 300, False, "\r\n"),
            "c": report(f"{p}/c.csv", 90, True, "\r\n", seed=3), "d": report(f"{p}/d.csv", 5, True, encoding="utf-8-sig", seed=4)}
    with open(f"{p}/e.csv", "w") as f:
        f.write('"no","text","名"\n"1","lost quote,"x"\n"2","b","c"\n')
    with open(f"{p}/f.csv", "w") as f:
        f.write('"no","text","名"\n"1","a","b","extra"\n')
    with open(f"{p}/g.csv", "w") as f:
        f.write('"number","text"\n"1","a"\n')
    rows, status = RC.read_report_records(spark, [f"{p}/{x}.csv" for x in "abcdefg"], required=["no"])
    for name, w in want.items():
        assert got(rows, f"{name}.csv") == w, name
    state = {r.path[-5]: (r.state, r.reason) for r in status.collect()}
    assert state == {**{x: ("ok", None) for x in "abcd"}, "e": ("rejected", "unclosed quote"), "f": ("rejected", "fields 4 > 3"), "g": ("rejected", "missing column no")}
    assert {r.source_file[-5] for r in rows.select("source_file").distinct().collect()} == set("abcd")


def test_lines_stay_where_they_are_read(spark, tmpdir_path, small_blocks):
    """No join moves the lines, also when none would be broadcast by itself."""
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    try:
        want = {x: report(f"{tmpdir_path}/{x}.csv", 300, wild, seed=i) for i, (x, wild) in enumerate([("a", True), ("b", False), ("c", True)])}
        lines, _ = RC.read_records(spark, [f"{tmpdir_path}/{x}.csv" for x in "abc"])
        assert "SortMergeJoin" not in lines._jdf.queryExecution().executedPlan().toString()
        rows, _ = RC.read_report_records(spark, [f"{tmpdir_path}/{x}.csv" for x in "abc"], required=["no"])
        for x, w in want.items():
            assert got(rows, f"{x}.csv") == w, x
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_cp932(spark, tmpdir_path):
    want = report(f"{tmpdir_path}/s.csv", 40, True, encoding="cp932", seed=6)
    rows, _ = RC.read_report_records(spark, [f"{tmpdir_path}/s.csv"], "MS932")
    assert got(rows, "s.csv") == want


def test_too_long_record_rejects_the_file(spark, tmpdir_path):
    p = str(tmpdir_path)
    with open(f"{p}/x.csv", "w") as f:
        f.write('"no","text","名"\n"1","' + "line\n" * 500 + '","b"\n"2","c","d"\n')
    want = report(f"{p}/ok.csv", 20, True, seed=8)
    rows, status = RC.read_report_records(spark, [f"{p}/x.csv", f"{p}/ok.csv"], max_bytes=20_000)
    assert len(got(rows, "x.csv")) == 2
    rows, status = RC.read_report_records(spark, [f"{p}/x.csv", f"{p}/ok.csv"], max_bytes=2_000)
    assert {(r.path[-6:], r.reason) for r in status.collect() if r.state == "rejected"} >= {("/x.csv", "record over 2000 bytes")}
    assert got(rows, "x.csv") == []


def test_clean_files_are_not_shuffled(spark, tmpdir_path):
    """Lines of files without odd quotes meet only their file's facts: no exchange of the lines."""
    report(f"{tmpdir_path}/b.csv", 50, False)
    lines, _ = RC.read_records(spark, [f"{tmpdir_path}/b.csv"])
    plan = lines._jdf.queryExecution().executedPlan().toString()
    first = plan.split("Union")[1].split("Window")[0]
    assert "SortMergeJoin" not in first or "Exchange hashpartitioning(path" in first   # the static plan; adaptive execution broadcasts the facts
    lines.collect()
    done = lines._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in done
