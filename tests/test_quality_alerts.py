"""Checks and alert policy (Q1-Q9, Q11) on small frames with the fixture edge rows."""

from pyspark.sql import functions as F

from tallyspark.functions import dates as D
from tallyspark.operators import alerts as AL
from tallyspark.operators import quality as QL


def test_missing_dates_and_not_in_parity(spark):
    t = spark.createDataFrame([("2026-07-18",), ("2026年07月16日～2026年07月16日",), ("",)], "`日付` string")
    tables = {"raw_keyword": (t, "日付", D.parse_mixed_date), "raw_item": (None, "対象日", D.parse_iso_or_slash)}
    got = sorted((r.tbl, r.missing_date, r.state) for r in QL.missing_dates(spark, tables, "2026-07-20", 4).collect())
    assert got == [("raw_item", None, "no_table"), ("raw_keyword", "2026-07-17", "missing"),
                   ("raw_keyword", "2026-07-19", "missing")]
    # the source query's NOT IN: the jp row parses to NULL and hides every gap
    parity = QL.missing_dates(spark, {"raw_keyword": (t, "日付", D.parse_mixed_date)}, "2026-07-20", 4,
                              null_semantics="not_in").collect()
    assert [(r.state) for r in parity] == ["none"]


def test_completeness_and_verdict(spark):
    a = spark.createDataFrame([("2026-07-19",)], "`日付` string")
    b = spark.createDataFrame([("2026/07/19",), ("2026-07-18",)], "`対象日` string")
    st = QL.completeness(spark, {"raw_keyword": (a, "日付", D.parse_mixed_date),
                                 "raw_item": (b, "対象日", D.parse_iso_or_slash)}, "2026-07-18", "2026-07-19")
    v = {r.d: (r.n_missing, r.missing_list, r.complete) for r in QL.completeness_verdict(st).collect()}
    assert v == {"2026-07-18": (1, "raw_keyword", False), "2026-07-19": (0, "", True)}


def test_data_age_states(spark):
    affi = spark.createDataFrame([("2026-07-18 9:05:00",), ("2026-07-17 23:00:00",)], "t string")
    fresh = spark.createDataFrame([("2026-07-19 1:00:00",)], "t string")
    empty = spark.createDataFrame([], "t string")
    bad = spark.createDataFrame([("2026-13-45 1:00:00",)], "t string")
    got = {r.tbl: (r.age_days, r.state) for r in QL.data_age(
        {"affi": (affi, "t"), "fresh": (fresh, "t"), "empty": (empty, "t"), "bad": (bad, "t")}, "2026-07-20").collect()}
    assert got["affi"] == (2, "data_stale") and got["fresh"] == (1, "ok")
    assert got["empty"][1] == "no_data" and got["bad"][1] == "data_check_failed"


def test_freshness_35_37_hours(spark):
    listing = spark.createDataFrame([("raw_affi", "2026-07-19 01:00:00"), ("raw_item", "2026-07-18 23:00:00")],
                                    "tbl string, m string").select("tbl", F.to_timestamp("m").alias("modified"))
    got = {r.tbl: (r.age_minutes, r.state) for r in QL.freshness(listing, "2026-07-20 12:00:00").collect()}
    assert got == {"raw_affi": (35 * 60, "fresh"), "raw_item": (37 * 60, "stale")}


def test_zero_delivery_edge_files(spark):
    files = spark.createDataFrame([
        ("r/RPP日次12h_20260718_20260719_0900.csv", 42, "0", ""),      # older generation
        ("r/RPP日次12h_20260718_20260720_0900.csv", 42, "5", "100"),   # newest -> not zero
        ("r/RPP日次12h_20260719_20260720_0901.csv", 41, "0", "0"),     # wrong shape: skipped
        ("r/RPP日次12h_20260719_20260720_0800.csv", 42, "", ""),       # empty -> 0, 0 -> zero
        ("r/RPP日次12h_20260719_20260720_0930.csv", 42, "1,234", "0"), # not an integer: skipped
        ("r/RPP日次12h_20250724_2023.csv", 42, "0", "0")],             # old name format: no generation
        "path string, n_cols int, clicks_text string, cost_text string")
    dates = spark.createDataFrame([("2026-07-18",), ("2026-07-19",), ("2026-07-21",)], "s string") \
        .select(F.to_date("s").alias("d"))
    got = {r.d: (r.is_zero, r.known) for r in QL.zero_delivery(QL.daily_totals_latest(files), dates).collect()}
    assert got == {"2026-07-18": (False, True), "2026-07-19": (True, True), "2026-07-21": (False, False)}


def _sets(spark, rows):
    m = spark.createDataFrame(rows, "d string, label string")
    return AL.missing_sets(m)


def test_alert_policy_orders(spark):
    sets = _sets(spark, [("2026-07-19", "raw_keyword"), ("2026-07-19", "raw_shohin_betsu"),
                         ("2026-07-18", "raw_affi(stale 40.1h)"), ("2026-07-18", "raw_item")])
    zero = spark.createDataFrame([("2026-07-19", True), ("2026-07-18", True)], "d string, is_zero boolean")
    ledger = spark.createDataFrame([], "target string, digest string, sent_at timestamp")
    late = {r.d: r.decision for r in AL.alerts_due(sets, zero, ledger, "2026-07-20 16:00:00").collect()}
    assert late == {"2026-07-19": "exempt_zero_delivery", "2026-07-18": "send"}
    early = {r.d: r.decision for r in AL.alerts_due(sets, zero, ledger, "2026-07-20 09:00:00").collect()}
    assert early == {"2026-07-19": "hold", "2026-07-18": "hold"}
    files_order = {r.d: r.decision for r in AL.alerts_due(sets, zero, ledger, "2026-07-20 09:00:00",
                                                          order="exempt_first").collect()}
    assert files_order == {"2026-07-19": "exempt_zero_delivery", "2026-07-18": "hold"}


def test_ledger_once_per_digest_and_retention(spark):
    sets = _sets(spark, [("2026-07-18", "raw_affi(stale 40.1h)"), ("2026-07-18", "raw_item")])
    due = AL.alerts_due(sets, None, None, "2026-07-20 16:00:00")
    ledger0 = spark.createDataFrame([], "target string, digest string, sent_at timestamp")
    ok = spark.createDataFrame([("2026-07-18",)], "d string")
    ledger1 = AL.ledger_append(ledger0, due, ok, "2026-07-20 16:00:00")
    assert ledger1.count() == 1
    # the suffix changes (40.1h -> 44.0h) but the digest does not: no second alert
    sets2 = _sets(spark, [("2026-07-18", "raw_affi(stale 44.0h)"), ("2026-07-18", "raw_item")])
    again = AL.alerts_due(sets2, None, ledger1, "2026-07-20 20:00:00").first().decision
    assert again == "already_sent"
    expired = AL.alerts_due(sets2, None, ledger1, "2026-07-28 20:00:00").first().decision
    assert expired == "send"
