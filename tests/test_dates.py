"""Date spellings and parsing (F1-F3, F17-F19) with the edge rows of the fixtures."""

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import dates as D


@pytest.mark.parametrize("text,fmt,expected", [
    ("2026年07月13日～2026年07月13日", "rpp_range", "2026-07-13"),
    ("2026年7月3日", "rpp_range", None),
    ("2026年7月3日", "jp_range", "2026-07-03"),
    ("2026/7/3 9:05", "datetime_jp", "2026-07-03"),
    ("2026-07-13", "simple", "2026-07-13"),
    ("2026-07-13 00:00:00", "simple", None),
    ("", "simple", None),
    ("合計", "rpp_range", None),
    ("2026年13月45日", "rpp_range", "2026-13-45"),      # no calendar check, as the source
    ("２０２６年０７月１３日", "rpp_range", "２０２６-０７-１３"),  # Unicode digits, like Python's \d
])
def test_normalize(spark, text, fmt, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(D.normalize_date("s", fmt).alias("x")).first().x == expected


def test_chains_and_parsers(spark):
    rows = [("2026年07月13日～2026年07月14日",), ("2026/7/3 9:05",), ("2026-07-13 00:00:00",), ("2026年13月45日",),
            ("2026/07/03",)]
    df = spark.createDataFrame(rows, "s string")
    out = df.select(D.normalize_date_chain("s", D.EXISTING_VALUES_ORDER).alias("n"),
                    D.iso_text(D.parse_mixed_date("s")).alias("m"),
                    D.iso_text(D.strict_date(D.normalize_date_chain("s", D.EXISTING_VALUES_ORDER))).alias("strict"),
                    D.iso_text(D.parse_iso_or_slash("s")).alias("slash")).collect()
    assert [r.n for r in out] == ["2026-07-13", "2026-07-03", None, "2026-13-45", "2026-07-03"]
    assert [r.m for r in out] == ["2026-07-13", None, "2026-07-13", None, None]
    assert out[3].strict is None
    assert [r.slash for r in out] == [None, None, None, None, "2026-07-03"]


def test_window_and_explicit_dates(spark):
    w = [D.iso_text(F.col("d")).alias("d")]
    got = [r.d for r in D.trailing_window(spark, "2026-07-20", 3).select(*w).collect()]
    assert got == ["2026-07-17", "2026-07-18", "2026-07-19"]
    e = D.explicit_dates(spark, "2026-07-01, 20260702 bad 2026/07/03").collect()
    assert [(r.token, str(r.d) if r.d else None) for r in e] == [
        ("2026-07-01", "2026-07-01"), ("20260702", "2026-07-02"), ("bad", None), ("2026/07/03", "2026-07-03")]


def test_target_month(spark):
    df = spark.createDataFrame([("2026-08-01",), ("2026-08-02",)], "s string")
    assert [r.m for r in df.select(D.target_month(F.to_date("s")).alias("m")).collect()] == ["2026-07", "2026-08"]
