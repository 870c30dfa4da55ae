"""Spike guard: the source system's own check table (T1-T17) plus boundary cases."""

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import guard as G
from tallyspark.functions.numbers import is_spike

SKU, KW, GUIDE, DATE = "商品管理番号", "キーワード", "目安CPC", "日付"


@pytest.mark.parametrize("new,prior,expected", [
    (495, 50, True),      # T1
    (150, 50, False),     # T2: exactly 3x, +100
    (200, 40, True),      # T3
    (160, 40, False),     # T4: +120
    (999, None, False),   # T5
    (500, 39, False),     # T6: prior < 40
    (None, 50, False),    # T7
    (1001, 66, True),     # T8: the real incident
    (300, 100, False),    # ratio boundary
    (301, 100, True),
    (190, 40, False),     # difference boundary
    (191, 40, True),
    (float("nan"), 50, False),
    (500, float("nan"), False),
])
def test_predicate(spark, new, prior, expected):
    f = lambda v: None if v is None else float(v)
    df = spark.createDataFrame([(f(new), f(prior))], "n double, p double")
    assert df.select(is_spike("n", "p").alias("s")).first().s is expected


def _hist(spark, rows):
    return spark.createDataFrame(rows, f"`{SKU}` string, `{KW}` string, `{GUIDE}` string, `{DATE}` string, seq int")


def _new(spark, rows):
    return spark.createDataFrame(rows, f"`{SKU}` string, `{KW}` string, `{GUIDE}` string, `{DATE}` string")


def test_baseline_keyed_by_sku_kw(spark):  # T10, T10b
    h = _hist(spark, [("bird-ref", "鳩よけ", "66.0", "2026-07-13", 1),
                      ("gips-arm", "ギプスカバー 腕", "46.0", "2026年07月12日～2026年07月12日", 2),
                      ("bird-ref", "鳩よけ", "50", "2026-07-01", 3),
                      ("bird-ref", "鳩よけ", "1,001", "2026-07-14", 4),     # not numeric for the baseline
                      ("old", "x", "70", "2026-05-01", 5)])                 # outside 30 days
    b = {(r[SKU], r[KW]): r.prior for r in G.guideline_baseline(h, "2026-07-15", tiebreak=["seq"]).collect()}
    assert b == {("bird-ref", "鳩よけ"): 66.0, ("gips-arm", "ギプスカバー 腕"): 46.0}


def test_no_history_is_noop(spark):  # T9 / T13
    n = _new(spark, [("bird-ref", "鳩よけ", "1001", "2026-07-14")])
    out, spikes = G.spike_guard(n, None, "2026-07-15")
    assert out.first()[GUIDE] == "1001" and spikes is None
    empty_hist = _hist(spark, [])
    out, spikes = G.spike_guard(n, empty_hist, "2026-07-15")
    assert out.first()[GUIDE] == "1001" and spikes.count() == 0


def test_missing_columns_is_noop(spark):  # T11
    df = spark.createDataFrame([("2026-07-14", "100")], f"`{DATE}` string, `{GUIDE}` string")
    out, _ = G.spike_guard(df, _hist(spark, []), "2026-07-15")
    assert out.collect() == df.collect()


def test_empty_frame(spark):  # T12
    n = spark.createDataFrame([], f"`{SKU}` string, `{KW}` string, `{GUIDE}` string, `{DATE}` string")
    out, _ = G.spike_guard(n, _hist(spark, [("a", "b", "60", "2026-07-13", 1)]), "2026-07-15")
    assert out.count() == 0


def test_three_rows(spark):  # T14-T16 + comma and trimming on the new side
    h = _hist(spark, [("bird-ref", "鳩よけ", "66", "2026-07-13", 1), ("gips-arm", "ギプスカバー 腕", "46", "2026-07-13", 2),
                      ("cattoy2", "猫じゃらし", "50", "2026-07-13", 3)])
    n = _new(spark, [("bird-ref", "鳩よけ", "1,001", "2026-07-14"), (" gips-arm ", "ギプスカバー 腕", "495", "2026-07-14"),
                     ("cattoy2", "猫じゃらし", "57", "2026-07-14"), ("cattoy2", "猫じゃらし", "nan", "2026-07-14"),
                     ("cattoy2", "猫じゃらし", "", "2026-07-14")])
    out, spikes = G.spike_guard(n, h, "2026-07-15")
    got = [r[GUIDE] for r in out.collect()]
    assert got == ["", "", "57", "nan", ""]
    assert spikes.count() == 2


def test_all_spikes_blanked_not_only_sample(spark):  # T17
    h = _hist(spark, [(f"s{i}", "k", "40", "2026-07-13", i) for i in range(15)])
    n = _new(spark, [(f"s{i}", "k", "500", "2026-07-14") for i in range(15)])
    out, spikes = G.spike_guard(n, h, "2026-07-15")
    assert {r[GUIDE] for r in out.collect()} == {""}
    assert G.spike_sample(spikes, 10).count() == 10 and spikes.count() == 15


def test_ties_broken_by_load_order(spark):
    h = _hist(spark, [("a", "k", "60", "2026-07-13", 1), ("a", "k", "45", "2026-07-13", 2)])
    b = G.guideline_baseline(h, "2026-07-15", tiebreak=["seq"]).first()
    assert b.prior == 45.0


def test_sequential_files_see_accepted_not_blanked(spark):
    """File 2 is judged against file 1's accepted price, never against a blanked spike."""
    h = _hist(spark, [("a", "k", "50", "2026-07-10", 1), ("b", "k", "50", "2026-07-10", 2)])
    rows = spark.createDataFrame(
        [("a", "k", "120", "2026-07-11", 1, 1),   # accepted -> baseline for a becomes 120
         ("a", "k", "350", "2026-07-12", 2, 1),   # 350 vs 120: not a spike (<= 3x)
         ("b", "k", "600", "2026-07-11", 1, 2),   # spike vs 50 -> blanked
         ("b", "k", "190", "2026-07-12", 2, 2)],  # vs 50 (not 600): 190 - 50 = 140 -> kept
        f"`{SKU}` string, `{KW}` string, `{GUIDE}` string, `{DATE}` string, file_rank int, seq int")
    out = G.spike_guard_files(spark, rows, h.withColumn("seq", F.col("seq")), "2026-07-15",
                              tiebreak=["seq"], checkpoint_every=1)
    got = {(r[SKU], r[DATE]): r[GUIDE] for r in out.collect()}
    assert got == {("a", "2026-07-11"): "120", ("a", "2026-07-12"): "350",
                   ("b", "2026-07-11"): "", ("b", "2026-07-12"): "190"}
    # brute force: one batch with the wrong (non-sequential) baseline would blank a's 350
    one, _ = G.spike_guard(rows, h, "2026-07-15", tiebreak=["seq"])
    assert {(r[SKU], r[DATE]): r[GUIDE] for r in one.collect()}[("a", "2026-07-12")] == ""


def _brute_force(hist, rows, as_of, lookback=30):
    """Plain-Python fold over files in order (the source system's sequence of loads)."""
    import datetime as dt
    import re

    def pdate(t):
        m = re.match(r"^(\d{4}-\d{2}-\d{2})", t)
        if m:
            return dt.date.fromisoformat(m.group(1))
        m = re.search(r"(\d{4})年(\d{2})月(\d{2})日", t)
        return dt.date(int(m.group(1)), int(m.group(2)), int(m.group(3))) if m else None

    def num(v, commas):
        v = v.replace(",", "") if commas else v
        try:
            return float(v.strip()) if re.fullmatch(r"\s*[+-]?(\d+\.?\d*|\.\d+)\s*", v) else None
        except ValueError:
            return None

    lo = dt.date.fromisoformat(as_of) - dt.timedelta(days=lookback)
    table = [dict(r) for r in hist]
    out = {}
    for rank in sorted({r["file_rank"] for r in rows}):
        base = {}
        for r in table:
            g, d = num(r["guide"], False), pdate(r["date_text"])
            if r["guide"] and g is not None and d is not None and d >= lo:
                k = (r["sku"], r["kw"])
                if k not in base or (d, r["row_no"]) > base[k][0]:
                    base[k] = ((d, r["row_no"]), g)
        batch = [dict(r) for r in rows if r["file_rank"] == rank]
        for r in batch:
            prior = base.get((r["sku"].strip(), r["kw"].strip()), (None, None))[1]
            new = num(r["guide"], True)
            if new is not None and prior is not None and prior >= 40 and new > prior * 3 and new - prior > 150:
                r["guide"] = ""
            out[r["row_no"]] = r["guide"]
        table.extend(batch)
    return out


def test_sequential_guard_matches_brute_force(spark):
    from tallyspark.plans import analogues as A
    kw = A.kw_a(spark, "/root/testdata/sf0.001")
    hist = kw.where("d < date'2024-01-25'").drop("d", "clicks", "ctr")
    rows = (kw.where("d >= date'2024-01-25'")
            .withColumn("file_rank", F.datediff("d", F.to_date(F.lit("2024-01-24"))))
            .drop("d", "clicks", "ctr"))
    got = G.spike_guard_files(spark, rows, hist, "2024-01-31", sku="sku", kw="kw", guide="guide",
                              date_col="date_text", tiebreak=["row_no"], checkpoint_every=2)
    got = {r.row_no: r.guide for r in got.collect()}
    want = _brute_force([r.asDict() for r in hist.collect()], [r.asDict() for r in rows.collect()], "2024-01-31")
    assert got == want
    assert sum(1 for v in want.values() if v == "") > 0       # some spikes were blanked


def test_many_files_matches_sequential_and_brute_force(spark):
    from tallyspark.plans import analogues as A
    kw = A.kw_a(spark, "/root/testdata/sf0.001")
    hist = kw.where("d < date'2024-01-20'").drop("d", "clicks", "ctr")
    rows = (kw.where("d >= date'2024-01-20'")
            .withColumn("file_rank", F.datediff("d", F.to_date(F.lit("2024-01-19"))))
            .drop("d", "clicks", "ctr"))
    args = dict(sku="sku", kw="kw", guide="guide", date_col="date_text", tiebreak=["row_no"])
    fix = {r.row_no: r.guide for r in G.spike_guard_many(rows, hist, "2024-01-31", **args).collect()}
    want = _brute_force([r.asDict() for r in hist.collect()], [r.asDict() for r in rows.collect()], "2024-01-31")
    assert fix == want
    assert sum(1 for v in want.values() if v == "") > 0


def test_many_files_cascade(spark):
    """A blanked spike must not become the baseline for the next file (needs more than one round)."""
    h = _hist(spark, [("a", "k", "50", "2026-07-10", 0)])
    rows = spark.createDataFrame(
        [("a", "k", "600", "2026-07-11", 1, 1),   # spike vs 50 -> blanked
         ("a", "k", "190", "2026-07-12", 2, 2),   # vs 50: kept (if 600 were kept: not a spike either)
         ("a", "k", "700", "2026-07-13", 3, 3),   # vs 190: spike; vs 600 (wrong) it would be kept
         ("a", "k", "200", "2026-07-14", 4, 4)],  # vs 190: kept
        f"`{SKU}` string, `{KW}` string, `{GUIDE}` string, `{DATE}` string, file_rank int, seq int")
    out = G.spike_guard_many(rows, h, "2026-07-15", tiebreak=["seq"])
    assert {r[DATE]: r[GUIDE] for r in out.collect()} == {
        "2026-07-11": "", "2026-07-12": "190", "2026-07-13": "", "2026-07-14": "200"}


def test_registered_multi_file_query_matches_brute_force(spark):
    import __spark_entry__ as E
    from tallyspark.plans import analogues as A
    got = {r.row_no: r.guide for r in E.queries()["spike_guard_multi_file"](spark, "/root/testdata/sf0.001").collect()}
    kw = A.kw_a(spark, "/root/testdata/sf0.001")
    hist = kw.where("d < date'2024-01-25'").drop("d", "clicks", "ctr")
    rows = (kw.where("d >= date'2024-01-25'").withColumn("file_rank", F.datediff("d", F.to_date(F.lit("2024-01-24"))))
            .drop("d", "clicks", "ctr"))
    want = _brute_force([r.asDict() for r in hist.collect()], [r.asDict() for r in rows.collect()], "2024-01-31")
    assert got == want


def test_many_files_of_a_price_step(spark):
    """A lasting price step repeated in 150 files: every file stays blanked against the old price, in one pass."""
    h = _hist(spark, [("a", "k", "66", "2026-07-01", 0)])
    rows = spark.createDataFrame([("a", "k", "300", "2026-07-02", i, i) for i in range(1, 151)] + [("a", "z", "300", "2026-07-02", i, i) for i in (1, 2)],
                                 f"`{SKU}` string, `{KW}` string, `{GUIDE}` string, `{DATE}` string, file_rank int, seq int")
    out = G.spike_guard_many(rows, h, "2026-07-15", tiebreak=["seq"]).collect()
    assert sorted(r[GUIDE] for r in out) == [""] * 150 + ["300"] * 2


def test_many_files_without_history(spark):
    rows = spark.createDataFrame([("a", "k", "66", "2026-07-01", 1, 1), ("a", "k", "1001", "2026-07-02", 2, 2), (" a ", "k", "1001", "2026-07-02", 2, 3),
                                  (None, "k", "1001", "2026-07-02", 2, 4)],
                                 f"`{SKU}` string, `{KW}` string, `{GUIDE}` string, `{DATE}` string, file_rank int, seq int")
    out = {r.seq: r[GUIDE] for r in G.spike_guard_many(rows, None, "2026-07-15", tiebreak=["seq"]).collect()}
    assert out == {1: "66", 2: "", 3: "", 4: "1001"}
