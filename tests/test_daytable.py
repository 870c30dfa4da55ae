"""Day lookups in the scan stage: same rows as the joins, no exchange of the row side, checked sizes."""

import random

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import daytable, dedup as DD, upsert as U


def days(rng, n):
    return [rng.choice(["2026年07月{:02d}日～2026年07月{:02d}日".format(d, d), f"2026-07-{d:02d}", f"2026/7/{d}", "合計", "2026年13月45日", "２０２６年０７月０１日", "2026-07-05\n", None])
            for d in (rng.randint(1, 28) for _ in range(n))]


def rows(spark, rng, n):
    return spark.createDataFrame([(i, t, rng.randint(1, 6)) for i, t in enumerate(days(rng, n))], "i long, `日付` string, file_rank int")


@pytest.mark.parametrize("seed", [1, 2])
def test_same_rows_as_the_joins(spark, monkeypatch, seed):
    rng = random.Random(seed)
    new, old = rows(spark, rng, 300), rows(spark, rng, 6)
    staged = spark.createDataFrame([("2026-07-03",), ("2026-07-09",), ("2026-07-09",)], "`日付` string").withColumn("i", F.lit(-1).cast("long"))

    def run():
        return [sorted(map(str, x.collect())) for x in (DD.dedup_by_date(new, old, "日付"), DD.first_writer_wins(new, old, "日付", "file_rank"),
                                                        DD.first_writer_wins(new, None, "日付", "file_rank"), U.replace_by_date(new, staged)[0])]

    table = run()
    monkeypatch.setattr(daytable, "MAX_YEARS", -1)                     # too big: the callers join
    assert table == run() and len(table[0]) > 50


def test_lookup(spark):
    t = spark.createDataFrame([("2026-07-03", 5), ("2026-13-45", 6), ("1999-12-31", 7), ("２０２６-０７-０１", 8), ("2026-07-05\n", 9)], "t string, v int")
    table = daytable.day_table(t, "t", "v")
    asked = spark.createDataFrame([(x,) for x in ["2026-07-03", "2026-07-04", "2026-13-45", "1999-12-31", "2001-01-01", "２０２６-０７-０１", "2026-07-01", "2026-07-05", "2026-07-05\n", None]], "x string")
    assert {r.x for r in table.rows(asked, "x", lambda v: v.isNull()).collect()} == {"2026-07-04", "2001-01-01", "2026-07-01", "2026-07-05", None}
    for x, v in [("2026-07-03", 5), ("2026-13-45", 6), ("1999-12-31", 7), ("２０２６-０７-０１", 8), ("2026-07-05\n", 9)]:
        assert [r.x for r in table.rows(asked, F.col("x"), lambda c, v=v: c == v).collect()] == [x]


def test_no_days(spark):
    new = rows(spark, random.Random(3), 40)
    assert DD.dedup_by_date(new, new.where("false"), "日付").count() == DD.normalize_rows(new, "日付", DD.new_rows_order("rpp_range")).count()


def test_bounds_are_checked(spark):
    many = spark.range(1000, 1000 + daytable.MAX_YEARS + 1).select(F.format_string("%d-01-01", "id").alias("t"))
    assert daytable.day_table(many, "t") is None
    odd = spark.range(daytable.MAX_ODD + 1).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("t"))
    assert daytable.day_table(odd, "t") is None


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Subqueries")[0].split("Subquery subquery")[0]


@pytest.mark.parametrize("name", ["dedup_by_date", "replace_by_date", "first_writer_wins"])
def test_registered_rows_are_not_exchanged_by_date(spark, name):
    """No join on the day: what is left to exchange in first_writer_wins is the listing of its files."""
    import __spark_entry__ as E
    plan = _plan(E.queries()[name](spark, "/root/testdata/sf0.001"))
    assert "__norm__" not in "".join(x for x in plan.splitlines() if "Exchange" in x or "Join" in x)
    assert "Anti" not in plan
    if name == "dedup_by_date":
        assert "Exchange" not in plan
