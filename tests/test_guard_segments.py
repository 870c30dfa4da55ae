"""Q10 over many files: skylines and bounded segments give what file-by-file work gives."""

import random

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import guard as G
from test_spike_guard import _brute_force

SCHEMA = "row_no long, date_text string, sku string, kw string, guide string, file_rank int"
ARGS = dict(sku="sku", kw="kw", guide="guide", date_col="date_text", tiebreak=["row_no"])


def some_rows(seed, files, n):
    rng = random.Random(seed)
    rows = []
    for f in range(1, files + 1):
        for _ in range(rng.randint(1, n)):
            sku = rng.choice(["a", "a", "a", "b", " a "])
            price = rng.choice(["", "x", "1,001", str(rng.randint(10, 900)), str(rng.randint(10, 900)), f"{rng.randint(40, 90)}.5"])
            rows.append((len(rows) + 1, f"2026-07-{rng.randint(1, 28):02d}", sku, rng.choice("kl"), price, f))
    hist = [(-i, f"2026-07-{i:02d}", "a", "k", str(60 + i), 0) for i in range(1, 4)]
    return rows, hist


def brute(rows, hist):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return _brute_force([dict(zip(names, r)) for r in hist], [dict(zip(names, r)) for r in rows], "2026-07-31")


@pytest.mark.parametrize("most", [1, 3, 16_384])
def test_segments_carry_the_state_on(spark, most):
    rows, hist = some_rows(most, 12, 9)
    got = G.spike_guard_many(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(hist, SCHEMA).drop("file_rank"), "2026-07-31", most=most, **ARGS)
    assert {r.row_no: r.guide for r in got.collect()} == brute(rows, hist)


def test_same_as_file_by_file(spark):
    rows, hist = some_rows(7, 6, 14)
    r, h = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(hist, SCHEMA).drop("file_rank")
    one = {x.row_no: x.guide for x in G.spike_guard_many(r, h, "2026-07-31", most=4, **ARGS).collect()}
    assert one == {x.row_no: x.guide for x in G.spike_guard_files(spark, r, h, "2026-07-31", **ARGS).collect()}


def test_skyline_keeps_only_running_minima(spark):
    """20,000 distinct prices of one key and file: a handful can decide; ties of a day and number-like texts stay right."""
    rng = random.Random(3)
    prices = [(1, i, float(rng.randint(0, 10**6)) + i / 10**6) for i in range(20_000)]
    df = spark.createDataFrame(prices, "f int, d int, g double").select("f", F.struct(F.col("d").alias("d"), F.col("g").alias("g"), F.col("g").alias("v")).alias("_s"))
    left = G.price_skyline(df, ["f"], lambda s: F.struct(s["d"])).select("_s.*").collect()
    want, low = [], float("inf")
    for _, d, g in sorted(prices, key=lambda p: -p[1]):
        if g < low:
            want.append(d)
            low = g
    assert sorted(r.d for r in left) == sorted(want) and len(want) < 40


def test_rising_prices_go_through_several_rounds(spark):
    """The worst case: every price is dearer than the one before, so all stay; they are folded in segments."""
    rows = [(i, f"2026-07-{1 + i // 40:02d}", "a", "k", str(40 + i), 1 + i // 100) for i in range(400)]
    entries_at_once = 50
    got = G.spike_guard_many(spark.createDataFrame(rows, SCHEMA), None, "2026-07-31", most=entries_at_once, **ARGS)
    assert {r.row_no: r.guide for r in got.collect()} == brute(rows, [])


def test_no_rows(spark):
    assert G.spike_guard_many(spark.createDataFrame([], SCHEMA), None, "2026-07-31", **ARGS).collect() == []
