"""Which missing-data alerts are due (Q7, Q8, Q9; U3, F20, F21).

Input is a frame of missing entries per target (the output of the checks),
the zero-delivery verdicts and the alert ledger.  The decision is a column
expression per target; the ledger is a table keyed by (target, digest) that
only grows after a successful send and forgets entries after a week.

Decisions: ``complete``, ``hold`` (before the final retry hour),
``exempt_zero_delivery`` (only ad tables missing on a day nothing was
delivered), ``already_sent`` and ``send``.  ``order="hour_first"`` is the
table check's order; ``order="exempt_first"`` the file check's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.text import digest8, strip_dynamic_suffix

# The final retry hour and the tables a zero-delivery day explains.
FINAL_RETRY_HOUR = 15
ZERO_DELIVERY_TABLES = ("raw_shohin_betsu", "raw_keyword")
LEDGER_RETENTION_DAYS = 7


def missing_sets(missing: DataFrame, *, target: str = "d", label: str = "label",
                 normalize: bool = True) -> DataFrame:
    """Per target: sorted labels, their normalized names and the 8-hex digest.

    With ``normalize`` the digest is over the names without dynamic suffixes
    (``raw_affi(stale 40.1h)`` -> ``raw_affi``), as the table check does; the
    file check hashes the labels as they are.
    """
    name = strip_dynamic_suffix(label) if normalize else F.col(label)
    g = missing.groupBy(target).agg(F.array_sort(F.collect_set(label)).alias("labels"),
                                    F.array_sort(F.collect_set(name)).alias("names"))
    return g.withColumn("digest", digest8(F.col("names")))


def ledger_retain(ledger: DataFrame, now, days: int = LEDGER_RETENTION_DAYS) -> DataFrame:
    """Q9 retention: forget entries sent more than ``days`` days before ``now``."""
    now_c = F.to_timestamp(F.lit(now)) if isinstance(now, str) else now
    return ledger.where(F.col("sent_at") >= now_c - F.expr(f"INTERVAL {int(days)} DAYS"))


def alerts_due(sets: DataFrame, zero: DataFrame | None, ledger: DataFrame | None, now, *,
               target: str = "d", final_hour: int = FINAL_RETRY_HOUR,
               exemptible: Sequence[str] = ZERO_DELIVERY_TABLES, order: str = "hour_first",
               retention_days: int = LEDGER_RETENTION_DAYS) -> DataFrame:
    """Q7 / Q8: one decision per target with missing entries.

    ``zero`` has (d, is_zero); ``ledger`` has (target, digest, sent_at).
    """
    now_c = F.to_timestamp(F.lit(now)) if isinstance(now, str) else now
    s = sets
    if zero is not None:
        z = zero.select(F.col("d").alias("_zd"), F.col("is_zero").alias("_zero"))
        s = s.join(z, s[target] == z["_zd"], "left").drop("_zd")
    else:
        s = s.withColumn("_zero", F.lit(False))
    if ledger is not None:
        led = (ledger_retain(ledger, now_c, retention_days)
               .select(F.col("target").alias("_lt"), F.col("digest").alias("_ldg")).distinct())
        s = s.join(led, (s[target] == led["_lt"]) & (s["digest"] == led["_ldg"]), "left")
        sent = F.col("_lt").isNotNull()
    else:
        sent = F.lit(False)
    ex = F.array(*[F.lit(t) for t in exemptible])
    subset = (F.size("names") > 0) & F.forall("names", lambda n: F.array_contains(ex, n))
    exempt = subset & F.coalesce(F.col("_zero"), F.lit(False))
    early = F.hour(now_c) < final_hour
    empty = F.size("names") == 0
    if order == "hour_first":
        decision = (F.when(empty, "complete").when(early, "hold").when(exempt, "exempt_zero_delivery")
                    .when(sent, "already_sent").otherwise("send"))
    elif order == "exempt_first":
        decision = (F.when(empty, "complete").when(exempt, "exempt_zero_delivery").when(early, "hold")
                    .when(sent, "already_sent").otherwise("send"))
    else:
        raise ValueError(order)
    return s.select(F.col(target).alias(target), F.array_join("labels", ",").alias("missing"),
                    "digest", decision.alias("decision"))


def ledger_append(ledger: DataFrame, due: DataFrame, sent_ok: DataFrame, now, *, target: str = "d") -> DataFrame:
    """Q9: ledger rows to add -- only targets whose send succeeded (``sent_ok`` has the targets)."""
    now_c = F.to_timestamp(F.lit(now)) if isinstance(now, str) else now
    add = (due.where(F.col("decision") == "send")
           .join(sent_ok.select(F.col(target).alias("_ok")), F.col(target) == F.col("_ok"), "left_semi")
           .select(F.col(target).alias("target"), "digest", now_c.alias("sent_at")))
    return ledger.unionByName(add)


def replay(checks: DataFrame, zero: DataFrame | None, *, final_hour: int = FINAL_RETRY_HOUR,
           exemptible: Sequence[str] = ZERO_DELIVERY_TABLES, order: str = "hour_first", normalize: bool = True,
           retention_days: int = LEDGER_RETENTION_DAYS) -> DataFrame:
    """Q7-Q9 over a whole history of runs: what each run decided, with the ledger its predecessors left.

    ``checks`` has (run_at, target, labels, send_ok): the labels missing at that run (none: complete) and whether a
    message sent then arrives; ``zero`` has (target, is_zero).  An entry (target, digest) is written by a
    successful send only and forgotten ``retention_days`` later, so entries of different (target, digest) never
    touch each other: each is one ordered fold over its runs.  Returns (run_at, target, missing, digest,
    decision, expired, last_sent): ``expired`` marks a send whose earlier entry was forgotten, ``last_sent`` is the
    entry after the run.
    """
    if order not in ("hour_first", "exempt_first"):
        raise ValueError(order)
    plain = F.transform("labels", strip_dynamic_suffix) if normalize else F.col("labels")
    c = checks.select("run_at", "target", F.array_sort(F.array_distinct("labels")).alias("labels"), F.array_sort(F.array_distinct(plain)).alias("names"), "send_ok")
    if zero is None:
        c = c.withColumn("is_zero", F.lit(False))
    else:
        c = c.join(zero.select("target", "is_zero"), "target", "left")
    ex = F.array(*[F.lit(t) for t in exemptible])
    exempt = F.forall("names", lambda n: F.array_contains(ex, n)) & F.coalesce("is_zero", F.lit(False))
    early = F.hour("run_at") < final_hour
    first, second = ((early, "hold"), (exempt, "exempt_zero_delivery")) if order == "hour_first" else ((exempt, "exempt_zero_delivery"), (early, "hold"))
    known = F.when(F.size("names") == 0, "complete").when(*first).when(*second)      # NULL: the ledger decides
    run = F.struct("run_at", F.array_join("labels", ",").alias("missing"), known.alias("known"), F.coalesce("send_ok", F.lit(False)).alias("ok"))
    runs = c.groupBy("target", digest8(F.col("names")).alias("digest")).agg(F.sort_array(F.collect_list(run)).alias("runs"))
    out_type = "array<struct<run_at:timestamp,missing:string,decision:string,expired:boolean,last_sent:timestamp>>"
    acc_type = f"struct<last:timestamp,out:{out_type}>"

    def step(acc, r):
        live = acc["last"].isNotNull() & (acc["last"] >= r["run_at"] - F.expr(f"INTERVAL {int(retention_days)} DAYS"))
        decision = F.when(r["known"].isNotNull(), r["known"]).when(live, "already_sent").otherwise("send")
        last = F.when((decision == "send") & r["ok"], r["run_at"]).otherwise(acc["last"])
        row = F.struct(r["run_at"].alias("run_at"), r["missing"].alias("missing"), decision.alias("decision"),
                       ((decision == "send") & acc["last"].isNotNull()).alias("expired"), last.alias("last_sent"))
        return F.struct(last.alias("last"), F.concat(acc["out"], F.array(row)).alias("out")).cast(acc_type)

    start = F.struct(F.lit(None).cast("timestamp").alias("last"), F.array().cast(out_type).alias("out")).cast(acc_type)
    folded = runs.select("target", "digest", F.explode(F.aggregate("runs", start, step, lambda a: a["out"])).alias("r"))
    return folded.select("r.run_at", "target", "r.missing", "digest", "r.decision", "r.expired", "r.last_sent")
