"""Errors of one table are its own row; the other tables are checked all the same."""

from pyspark.sql import functions as F

from tallyspark.functions import dates as D
from tallyspark.operators import quality as QL


def test_every_state_side_by_side(spark, tmpdir_path):
    good = spark.createDataFrame([("2026-07-18",), ("2026年07月19日～2026年07月19日",), ("合計",)], "d string")
    spark.createDataFrame([("x",)], "d string").write.text(f"{tmpdir_path}/broken")
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 2:
            raise TimeoutError("busy")
        return good

    out = QL.checked_missing_dates(spark, {
        "whole": (lambda: good, "d", D.parse_mixed_date), "none": (lambda: None, "d", D.parse_mixed_date),
        "broken": (lambda: spark.read.schema("d string").parquet(f"{tmpdir_path}/broken"), "d", D.parse_mixed_date),
        "strict": (lambda: good, "d", lambda c: F.to_date(c, "yyyy-MM-dd")), "flaky": (flaky, "d", D.parse_mixed_date)}, "2026-07-20", 2, attempts=2)
    got = {(r.tbl, r.missing_date, r.state) for r in out.collect()}
    assert got == {("whole", None, "none"), ("none", None, "no_table"), ("broken", None, "error"), ("strict", None, "error"), ("flaky", None, "none")}
    assert all(r.message for r in out.where("state = 'error'").collect()) and len(calls) == 2


def test_only_errors(spark):
    def lost():
        raise RuntimeError("gone")

    out = QL.checked_missing_dates(spark, {"a": (lost, "d", D.parse_mixed_date)}, "2026-07-20")
    assert [tuple(r) for r in out.collect()] == [("a", None, "error", "RuntimeError")]
