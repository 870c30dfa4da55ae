"""Alert decisions over a history of runs, against a plain ledger of files as the source system kept."""

import datetime as dt
import hashlib
import random
import re

import pytest

from tallyspark.operators import alerts as AL

SCHEMA = "run_at timestamp, target string, labels array<string>, send_ok boolean"
LABELS = ["raw_shohin_betsu", "raw_keyword", "raw_item", "raw_affi(stale {}h)"]


def plain(checks, zero, order, normalize, days=7):
    ledger, ever, out = {}, {}, set()
    for run, target, labels, ok in sorted(checks, key=lambda c: c[0]):
        labels = sorted(set(labels))
        names = sorted({re.split(r"[(\s]", x)[0] for x in labels}) if normalize else labels
        digest = hashlib.md5("|".join(names).encode()).hexdigest()[:8]
        exempt = set(names) <= {"raw_shohin_betsu", "raw_keyword"} and zero.get(target)
        before = ever.get((target, digest))
        for k in [k for k, t in ledger.items() if t < run - dt.timedelta(days=days)]:      # markers are deleted by age
            del ledger[k]
        expired = False
        first, second = ((run.hour < 15, "hold"), (exempt, "exempt_zero_delivery"))[:: 1 if order == "hour_first" else -1]
        if not names:
            decision = "complete"
        elif first[0]:
            decision = first[1]
        elif second[0]:
            decision = second[1]
        elif (target, digest) in ledger:
            decision = "already_sent"
        else:
            decision, expired = "send", before is not None
            if ok:
                ledger[target, digest] = ever[target, digest] = run
        out.add((run, target, ",".join(labels), digest, decision, expired, ever.get((target, digest))))
    return out


@pytest.mark.parametrize("order, normalize", [("hour_first", True), ("exempt_first", False)])
def test_replay_against_a_ledger_of_files(spark, order, normalize):
    rng = random.Random(4)
    checks = []
    for day in range(1, 9):
        late = rng.sample(LABELS, rng.randint(0, 3))
        for k in range(12):
            if k == 3 and late:
                late = late[1:]
            for hour in (10, 15, 18):
                run = dt.datetime(2026, 7, day + 1, hour) + dt.timedelta(days=k)
                checks.append((run, f"2026-07-{day:02d}", [x.format(24 * k + hour) if k % 2 and normalize else x for x in late], rng.random() < 0.6))
    zero = {f"2026-07-{d:02d}": d % 2 == 0 for d in range(1, 7)}
    z = spark.createDataFrame(list(zero.items()), "target string, is_zero boolean")
    got = AL.replay(spark.createDataFrame(checks, SCHEMA), z, order=order, normalize=normalize)
    want = plain(checks, zero, order, normalize)
    assert {tuple(r) for r in got.collect()} == want                # a forgotten entry still names the last send


def test_forgotten_entry_is_sent_again(spark):
    runs = [dt.datetime(2026, 7, 2, 16) + dt.timedelta(days=k) for k in range(9)]
    got = AL.replay(spark.createDataFrame([(r, "2026-07-01", ["raw_item"], r != runs[0]) for r in runs], SCHEMA), None).orderBy("run_at").collect()
    assert [r.decision for r in got] == ["send", "send"] + ["already_sent"] * 7          # the first message failed: no entry
    runs += [runs[1] + dt.timedelta(days=7, hours=1)]
    got = AL.replay(spark.createDataFrame([(r, "2026-07-01", ["raw_item"], r != runs[0]) for r in runs], SCHEMA), None).orderBy("run_at").collect()
    assert (got[-1].decision, got[-1].expired, got[-1].last_sent) == ("send", True, runs[-1])


def test_nulls_and_no_runs(spark):
    run = dt.datetime(2026, 7, 2, 16)
    got = AL.replay(spark.createDataFrame([(run, None, ["a"], None), (run, "t", [], None)], SCHEMA), None).collect()
    assert sorted((r.target or "", r.decision) for r in got) == [("", "send"), ("t", "complete")]
    assert AL.replay(spark.createDataFrame([], SCHEMA), None).collect() == []


def test_every_decision_occurs_in_the_registered_query(spark):
    import __spark_entry__ as E
    rows = E.queries()["alert_replay"](spark, "/root/testdata/sf0.01").collect()
    for kind in ("tables", "files"):
        assert {r.decision for r in rows if r.kind == kind} >= {"complete", "hold", "exempt_zero_delivery", "send"}
    assert any(r.decision == "already_sent" for r in rows) and any(r.expired for r in rows)
    assert any("stale" in r.missing for r in rows)
