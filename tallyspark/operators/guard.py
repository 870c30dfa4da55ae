"""Guide-price spike guard.

A new keyword-report row whose guide price jumps implausibly above the latest
accepted price of the same (sku, keyword) is stored with the price blanked.

Plan shape: the baseline is ``max_by(price, (date, tie-breakers))`` per key
-- a partial aggregate, so a hot key collapses map-side before the shuffle and
no task ever holds a whole group.  The new rows then take one left equi-join
against a table with one row per key; AQE picks broadcast or sort-merge from
the real sizes.

Semantics kept: the baseline side neither strips commas nor trims keys; the
new side does both (so ``"1,001"`` is read as 1001 and `` sku `` matches
``sku``).  Missing columns, an empty frame or a missing history are no-ops
(fail-open).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.functions.dates import as_date, parse_mixed_date_iso_first
from tallyspark.functions.numbers import (BASELINE_LOOKBACK_DAYS, SPIKE_ABS_MIN, SPIKE_PRIOR_MIN,
                                          SPIKE_RATIO, comma_float, is_spike, safe_double, spike_ratio)
from tallyspark.functions.text import non_blank, ustrip
from tallyspark.session import materialized, shared_checkpoint_dir

PDATE = "pdate"
#: parts a (key, file) is first reduced in, and skyline rows of one key that are folded at once
SKYLINE_PARTS, FOLD_ENTRIES = 64, 16_384
SKU, KW, GUIDE, DATE = "商品管理番号", "キーワード", "目安CPC", "日付"


def guideline_baseline(history: DataFrame, as_of, *, sku: str = SKU, kw: str = KW, guide: str = GUIDE,
                       date_col: str = DATE, lookback_days: int = BASELINE_LOOKBACK_DAYS,
                       tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest numeric guide per (sku, kw) dated within ``lookback_days`` of ``as_of``.

    Returns (sku, kw, prior, prior_date).  ``tiebreak`` columns order rows that
    share a date (later wins); the source system left such ties arbitrary.
    """
    lo = F.date_sub(as_date(as_of), lookback_days)
    if PDATE in history.columns and date_col != PDATE:      # old partitions are not read at all
        history = history.where((F.col(PDATE) >= lo) | F.col(PDATE).isNull())
    # price and date are parsed once; the filter runs inside the generator, so
    # it is not pushed below the projection and evaluated a second time
    cand = F.struct(safe_double(guide).alias("_g"), parse_mixed_date_iso_first(date_col).alias("_d"))
    kept = F.explode(F.filter(F.array(cand), lambda x: x["_g"].isNotNull() & (x["_d"] >= lo))).alias("_c")
    rows = (history.where(non_blank(guide))
            .select(F.col(sku).alias("_b_sku"), F.col(kw).alias("_b_kw"), kept,
                    # a history without the tie-break column (e.g. the raw table) ranks below new rows
                    *[(F.col(c) if c in history.columns else F.lit(None)).alias(f"_t{i}")
                      for i, c in enumerate(tiebreak)])
            .select("_b_sku", "_b_kw", "_c._g", "_c._d", *[f"_t{i}" for i in range(len(tiebreak))]))
    ts = [f"_t{i}" for i in range(len(tiebreak))]
    order = F.struct("_d", *ts)
    best = F.max_by(F.struct(F.col("_g").alias("prior"), F.col("_d").alias("prior_date"), *ts), order)
    return (rows.groupBy("_b_sku", "_b_kw").agg(best.alias("_b"))
            .select(F.col("_b_sku").alias(sku), F.col("_b_kw").alias(kw), "_b.*"))


def _flag(new: DataFrame, baseline: DataFrame, sku: str, kw: str, guide: str,
          ratio: float, abs_min: float, prior_min: float) -> DataFrame:
    b = baseline.select(F.col(sku).alias("_b_sku"), F.col(kw).alias("_b_kw"), "prior")
    j = new.join(b, (ustrip(new[sku]) == b._b_sku) & (ustrip(new[kw]) == b._b_kw), "left")
    val = comma_float(guide)
    return (j.withColumn("_new_val", val)
             .withColumn("_spike", is_spike(val, F.col("prior"), ratio, abs_min, prior_min))
             .drop("_b_sku", "_b_kw"))


def spike_guard(new: DataFrame, history: DataFrame | None, as_of, *, sku: str = SKU, kw: str = KW,
                guide: str = GUIDE, date_col: str = DATE, ratio: float = SPIKE_RATIO,
                abs_min: float = SPIKE_ABS_MIN, prior_min: float = SPIKE_PRIOR_MIN,
                lookback_days: int = BASELINE_LOOKBACK_DAYS, tiebreak: Sequence[str] = ()):
    """Q10 for one batch: returns (guarded rows, spikes).

    ``guarded`` has the columns of ``new`` with ``guide`` blanked on spikes;
    ``spikes`` has (sku, kw, prior, new_value, ratio) plus the new row's columns.
    """
    if history is None or not {sku, kw, guide} <= set(new.columns):
        return new, None
    base = guideline_baseline(history, as_of, sku=sku, kw=kw, guide=guide, date_col=date_col,
                              lookback_days=lookback_days, tiebreak=tiebreak)
    flagged = _flag(new, base, sku, kw, guide, ratio, abs_min, prior_min)
    guarded = flagged.withColumn(guide, F.when(F.col("_spike"), F.lit("")).otherwise(F.col(guide)))
    spikes = (flagged.where("_spike")
              .select(*[F.col(c) for c in new.columns],
                      F.col("prior"), F.col("_new_val").alias("new_value"),
                      F.try_divide(F.col("_new_val"), F.col("prior")).alias("ratio")))
    return guarded.select(*new.columns), spikes


def guard_summary(new: DataFrame, history: DataFrame, as_of, *, sku: str = SKU, kw: str = KW,
                  guide: str = GUIDE, date_col: str = DATE, ratio: float = SPIKE_RATIO,
                  abs_min: float = SPIKE_ABS_MIN, prior_min: float = SPIKE_PRIOR_MIN,
                  lookback_days: int = BASELINE_LOOKBACK_DAYS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """A12 totals in one aggregate: new rows, rows with a baseline, spikes, keys with a spike."""
    base = guideline_baseline(history, as_of, sku=sku, kw=kw, guide=guide, date_col=date_col,
                              lookback_days=lookback_days, tiebreak=tiebreak)
    f = _flag(new, base, sku, kw, guide, ratio, abs_min, prior_min)
    spike_key = F.when(F.col("_spike"), F.struct(ustrip(sku).alias("s"), ustrip(kw).alias("k")))
    return f.agg(F.count(F.lit(1)).alias("new_rows"), F.count("prior").alias("with_baseline"),
                 F.count_if("_spike").alias("spikes"), F.count_distinct(spike_key).alias("spike_keys"))


def spike_sample(spikes: DataFrame, n: int = 10, order: Sequence[Column | str] | None = None) -> DataFrame:
    """The first ``n`` spikes for the log (distributed top-k; the limit is the feature).

    ``ratio_1dp`` is the ratio as the log prints it (one decimal).
    """
    order = order or [F.desc("ratio")]
    return spikes.orderBy(*order).limit(n).withColumn("ratio_1dp", spike_ratio("new_value", "prior"))


def spike_guard_files(spark: SparkSession, rows: DataFrame, history: DataFrame, as_of, *,
                      file_rank: str = "file_rank", sku: str = SKU, kw: str = KW, guide: str = GUIDE,
                      date_col: str = DATE, tiebreak: Sequence[str] = (), ratio: float = SPIKE_RATIO,
                      abs_min: float = SPIKE_ABS_MIN, prior_min: float = SPIKE_PRIOR_MIN,
                      lookback_days: int = BASELINE_LOOKBACK_DAYS, ranks: Sequence[int] | None = None,
                      checkpoint_every: int = 8, sink=None) -> DataFrame | None:
    """Q10 over several files in load order: file k sees the accepted prices of files < k.

    The state is the baseline itself (one row per key), folded with
    ``max_by`` -- associative, so ``state_{k+1} = latest(state_k, accepted_k)``
    -- and checkpointed to the session's shared checkpoint folder (when it names
    one) every few files so the lineage stays short.  ``ranks`` is the (small) list of file ranks; when not
    given it is read from the file-rank column.  With ``sink`` each file's
    guarded rows are handed over as soon as they are planned (append writes),
    otherwise their union is returned.
    """
    if ranks is None:
        ranks = [r[0] for r in rows.select(file_rank).distinct().orderBy(file_rank).collect()]
    if not ranks:
        return None if sink is not None else rows
    state = guideline_baseline(history, as_of, sku=sku, kw=kw, guide=guide, date_col=date_col,
                               lookback_days=lookback_days, tiebreak=tiebreak)
    state = state.select(sku, kw, "prior", F.col("prior_date").alias("_d"),
                         *[F.col(f"_t{i}").cast(rows.schema[c].dataType).alias(f"_t{i}")
                           for i, c in enumerate(tiebreak)])
    lo = F.date_sub(as_date(as_of), lookback_days)
    outs = []
    for i, r in enumerate(ranks):
        batch = rows.where(F.col(file_rank) == F.lit(r))
        flagged = _flag(batch, state, sku, kw, guide, ratio, abs_min, prior_min)
        guarded = flagged.withColumn(guide, F.when(F.col("_spike"), F.lit("")).otherwise(F.col(guide)))
        guarded = guarded.select(*rows.columns)
        if sink is not None:
            sink(guarded)
        else:
            outs.append(guarded)
        # accepted numeric prices of this file (the stored, possibly blanked value)
        d = parse_mixed_date_iso_first(date_col)
        acc = (guarded.where(non_blank(guide) & safe_double(guide).isNotNull() & (d >= lo))
               .select(F.col(sku), F.col(kw), safe_double(guide).alias("prior"), d.alias("_d"),
                       *[F.col(c).alias(f"_t{j}") for j, c in enumerate(tiebreak)]))
        both = state.unionByName(acc)
        order = F.struct("_d", *[f"_t{j}" for j in range(len(tiebreak))])
        state = (both.groupBy(sku, kw)
                 .agg(F.max_by(F.struct("prior", "_d", *[f"_t{j}" for j in range(len(tiebreak))]), order)
                      .alias("_s"))
                 .select(sku, kw, "_s.*"))
        if checkpoint_every and (i + 1) % checkpoint_every == 0 and shared_checkpoint_dir(spark):
            state = state.checkpoint(eager=True)
    if sink is not None:
        return None
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def price_skyline(prices: DataFrame, keys: Sequence[str], order) -> DataFrame:
    """Rows of (``keys``, ``_s``) that can decide what a file leaves as its latest accepted price.

    A price is accepted up to a bound that depends on the prior only, so a row counts only if every later row
    of its group is dearer: from the latest row on, the running minima.  Groups are first reduced in parts
    (by a hash of the price), so one hot group is spread; rows without a price stay.
    """
    # a price that is no number is never a spike: below all others
    bound = F.when(F.col("_s.v").isNull() | F.isnan("_s.v"), F.lit(float("-inf"))).otherwise(F.col("_s.v"))
    later = F.when(F.col("_s").isNotNull(), F.struct(order(F.col("_s")), F.col("_s.g")))
    part = F.pmod(F.xxhash64("_s.g"), F.lit(SKYLINE_PARTS))
    left = prices.withColumn("_part", part)
    for by in ([*keys, "_part"], list(keys)):
        w = Window.partitionBy(*by).orderBy(later.desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        left = left.withColumn("_low", F.min(bound).over(w)).where(F.col("_s").isNull() | F.col("_low").isNull() | (bound < F.col("_low")))
    return left.drop("_part", "_low")


def _segments(entries: DataFrame, most: int) -> DataFrame:
    """Deal each key's entries, file by file, to segments of about ``most`` (``_seg``, from 0 without gaps)."""
    key = Window.partitionBy("_k1", "_k2").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("_k1", "_k2", "_r").orderBy("_s.g")
    files = entries.groupBy("_k1", "_k2", "_r").agg(F.count("*").alias("_n"))
    files = files.select("_k1", "_k2", "_r", F.floor(F.coalesce(F.sum("_n").over(key), F.lit(0)) / most).alias("_from"))
    at = entries.withColumn("_at", F.floor((F.row_number().over(in_file) - 1) / most))
    return at.join(files, ["_k1", "_k2", "_r"]).select("_k1", "_k2", "_r", "_s", (F.col("_from") + F.col("_at")).cast("int").alias("_seg"))


def spike_guard_many(rows: DataFrame, history: DataFrame | None, as_of, *, file_rank: str = "file_rank",
                     sku: str = SKU, kw: str = KW, guide: str = GUIDE, date_col: str = DATE,
                     tiebreak: Sequence[str] = (), ratio: float = SPIKE_RATIO, abs_min: float = SPIKE_ABS_MIN,
                     prior_min: float = SPIKE_PRIOR_MIN, lookback_days: int = BASELINE_LOOKBACK_DAYS,
                     most: int = FOLD_ENTRIES) -> DataFrame:
    """Q10 over many files in load order: file k sees the prices accepted from files < k.

    Same result as ``spike_guard_files``, whatever the number of files and spikes.  Prices are reduced to one
    row per (key, file, distinct price) with partial ``max_by``, then to each file's skyline
    (``price_skyline``: a handful of rows, however many prices).  A key's files are folded in order with
    ``aggregate`` over segments of about ``most`` skyline rows; what a segment leaves (the state before its last file
    and the best price of that file so far) is carried to the key's next one, so no array grows with the key.
    Almost always there is one segment; a longer key takes further rounds, for that key only.  The fold gives
    the prior of every (key, file), which the rows join.  Only rows whose stored key has no blanks to strip
    can ever be looked up, so only they feed the fold.  Without a history the first file has no prior and
    later files see the earlier ones.
    """
    if not {sku, kw, guide} <= set(rows.columns):
        return rows
    lo = F.date_sub(as_date(as_of), lookback_days)
    ts = [f"t{i}" for i in range(len(tiebreak))]
    kinds = [rows.schema[c].dataType for c in tiebreak]

    def order(s):
        return F.struct(s["d"], *[s[t] for t in ts])

    # per (key, file, price): the best dated occurrence; NULL marks a file that only looks up
    feeds = (F.col(sku) == ustrip(sku)) & (F.col(kw) == ustrip(kw)) & non_blank(guide)
    seen = F.struct(parse_mixed_date_iso_first(date_col).alias("d"), *[F.when(F.col(sku).isNotNull(), F.col(c)).alias(t) for c, t in zip(tiebreak, ts)],
                    safe_double(guide).alias("g"), comma_float(guide).alias("v"))
    k1, k2 = ustrip(sku).alias("_k1"), ustrip(kw).alias("_k2")
    keyed = (rows.where(F.col(sku).isNotNull() & F.col(kw).isNotNull())
             .select(k1, k2, F.col(file_rank).alias("_r"), F.when(feeds, seen).alias("_s")))
    usable = F.col("_s.g").isNotNull() & (F.col("_s.d") >= lo)
    keyed = keyed.select("_k1", "_k2", "_r", F.when(usable, F.col("_s")).alias("_s"))
    per_price = keyed.groupBy("_k1", "_k2", "_r", F.col("_s.g").alias("_g")).agg(
        F.max_by("_s", F.when(F.col("_s").isNotNull(), order(F.col("_s")))).alias("_s")).drop("_g")
    entries = materialized(_segments(price_skyline(per_price, ["_k1", "_k2", "_r"], order), most))
    rounds = (entries.agg(F.max("_seg")).first()[0] or 0) + 1
    state_type = entries.schema["_s"].dataType
    rtype = rows.schema[file_rank].dataType
    none = F.lit(None).cast(state_type)
    no_file = F.lit(None).cast(rtype)
    if history is not None:
        base = guideline_baseline(history, as_of, sku=sku, kw=kw, guide=guide, date_col=date_col,
                                  lookback_days=lookback_days, tiebreak=tiebreak)
        start = F.struct(F.col("prior_date").alias("d"), *[F.col(f"_t{i}").cast(k).alias(t) for i, (t, k) in enumerate(zip(ts, kinds))],
                         F.col("prior").alias("g"), F.col("prior").alias("v")).cast(state_type)
        state = base.select(F.col(sku).alias("_k1"), F.col(kw).alias("_k2"), start.alias("s"), none.alias("b"), no_file.alias("r"))
    else:
        state = None
    out_type = f"array<struct<r:{rtype.simpleString()},prior:double>>"
    acc_type = f"struct<s:{state_type.simpleString()},b:{state_type.simpleString()},r:{rtype.simpleString()},out:{out_type}>"

    def later(a, b):
        ahead = F.struct(order(b), b["g"]) > F.struct(order(a), a["g"])
        return F.when(a.isNull(), b).when(b.isNull(), a).when(ahead, b).otherwise(a)

    def step(acc, e):
        opens = acc["r"].isNull() | (e["_r"] != acc["r"])          # the first entry of a file

        def taken(s):
            best = F.when(opens, none).otherwise(acc["b"])
            take = e["_s"].isNotNull() & ~is_spike(e["_s"]["v"], s["g"], ratio, abs_min, prior_min)
            out = F.when(opens, F.concat(acc["out"], F.array(F.struct(e["_r"].alias("r"), s["g"].alias("prior"))))).otherwise(acc["out"])
            return F.struct(s.alias("s"), F.when(take, later(best, e["_s"])).otherwise(best).alias("b"), e["_r"].alias("r"), out.alias("out")).cast(acc_type)

        return _let(F.when(opens, later(acc["s"], acc["b"])).otherwise(acc["s"]), taken)

    outs = []
    for i in range(rounds):
        part = entries if rounds == 1 else entries.where(F.col("_seg") == i)
        keys = part.groupBy("_k1", "_k2").agg(F.sort_array(F.collect_list(F.struct("_r", "_s"))).alias("_e"))
        keys = keys.join(state, ["_k1", "_k2"], "left") if state is not None else \
            keys.select("*", none.alias("s"), none.alias("b"), no_file.alias("r"))
        init = F.struct("s", "b", "r", F.array().cast(out_type).alias("out")).cast(acc_type)
        folded = keys.select("_k1", "_k2", F.aggregate("_e", init, step).alias("_a")).select("_k1", "_k2", "_a.*")
        if rounds > 1:
            folded = materialized(folded)
        state = folded.select("_k1", "_k2", "s", "b", "r")
        outs.append(folded.select("_k1", "_k2", F.explode("out").alias("_o")).select("_k1", "_k2", F.col("_o.r").alias("_r"), F.col("_o.prior").alias("_prior")))
    folded = outs[0]
    for o in outs[1:]:
        folded = folded.unionAll(o)
    j = rows.join(folded, (ustrip(rows[sku]) == folded["_k1"]) & (ustrip(rows[kw]) == folded["_k2"])
                  & (rows[file_rank] == folded["_r"]), "left")
    spike = is_spike(comma_float(guide), F.col("_prior"), ratio, abs_min, prior_min)
    return j.withColumn(guide, F.when(spike, F.lit("")).otherwise(F.col(guide))).select(*[rows[c] if c != guide else F.col(guide) for c in rows.columns])
