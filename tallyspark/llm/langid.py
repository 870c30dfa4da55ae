"""Language identification by interpolated Kneser-Ney character models.

One model per language, kept as sorted arrays of n-gram hashes that share their
keys; a text gets the language of lowest length-normalised cross-entropy.  The
score is a curve, fitted on texts the models have not seen, over the gap to the
runner-up; the rejection limit is the worst cross-entropy of those texts plus a
margin (text that no learned language explains).

Cases: null text and text without a letter is ``und`` with score 0.0 and is
rejected; ties go to the first language in name order; null languages teach
nothing; with no learned language everything is ``und``; repeated rows are
judged each; extra columns are ignored; very long texts are read whole.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import charlm
from tallyspark.llm.common import portions

ORDER = 4
UNKNOWN = "und"
#: bounds of the training sample
MAX_ROWS_PER_LANG = 3000
MAX_LANGS = 400
#: a text is rejected when its cross-entropy is this many times the worst one of the calibration texts
REJECT_MARGIN = 1.25


def training_sample(docs: DataFrame, max_rows: int = MAX_ROWS_PER_LANG) -> tuple[DataFrame, list[str]]:
    """((cls, part, text) of about ``max_rows`` hashed rows of each language; the languages in name order)."""
    known = docs.where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(MAX_LANGS).collect()}
    langs = sorted(sizes)
    if not langs:
        return known.select(F.lit(0).alias("cls"), F.lit(0).alias("part"), "text").limit(0), langs
    share = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(min(1.0, max_rows / sizes[lang])))])
    cls = F.create_map(*[x for i, lang in enumerate(langs) for x in (F.lit(lang), F.lit(i))])
    h = F.xxhash64(F.lit(5), F.coalesce("doc_id", F.lit(-1)))
    u = F.pmod(h, F.lit(1 << 30)) / float(1 << 30)
    part = (F.pmod(F.shiftright(h, 32), F.lit(10)) >= 7).cast("int")
    return known.where(u < share[F.col("lang")]).select(cls[F.col("lang")].alias("cls"), part.alias("part"), "text"), langs


def _scored(docs: DataFrame, keep: list[str], types: str, shared) -> DataFrame:
    """``keep`` columns and best class, its cross-entropy, the gap to the runner-up (nats a character) and characters."""
    cols = keep if "text" in keep else [*keep, "text"]
    at = cols.index("text")

    def run(batches):
        model, digest = shared.value
        scorer = charlm.ChunkScorer(model, f"langid-{digest}")
        k = model["classes"]
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            for s, e in portions(texts):
                rows, counts = scorer.rows(texts[s:e])
                tot = np.zeros((e - s, k + 2))
                has = np.flatnonzero(counts)
                if len(has):
                    tot[has] = np.add.reduceat(rows, np.concatenate(([0], np.cumsum(counts)[:-1]))[has], axis=0)
                chars = tot[:, k]
                ce = -tot[:, :k] / np.maximum(chars, 1)[:, None]
                best = ce.argmin(1)
                two = np.sort(ce, 1)
                gap = two[:, 1] - two[:, 0] if k > 1 else np.full(e - s, 1.0)
                best = np.where(chars > 0, best, -1)
                yield pa.RecordBatch.from_arrays([b.column(i).slice(s, e - s) for i in range(len(keep))] + [pa.array(best.astype(np.int32)), pa.array(two[:, 0]), pa.array(gap), pa.array(chars)], keep + ["best", "ce", "gap", "chars"])

    return docs.select(*cols).mapInArrow(run, f"{types}, best int, ce double, gap double, chars double")


def fit(docs: DataFrame, max_rows: int = MAX_ROWS_PER_LANG) -> dict:
    """Models, curve and rejection limit, learned from text and lang of ``docs`` (a bounded sample)."""
    sample, langs = training_sample(docs, max_rows)
    if not langs:
        return {"langs": []}
    model = charlm.fit(sample.where("part = 0"), len(langs), ORDER)
    shared = docs.sparkSession.sparkContext.broadcast((model, hashlib.md5(pickle.dumps(model)).hexdigest()))
    seen = _scored(sample.where("part = 1"), ["cls"], "cls int", shared).where("best >= 0").toPandas()
    right = (seen["cls"] == seen["best"]).to_numpy(float)
    gap, chars = seen["gap"].to_numpy(), seen["chars"].to_numpy()
    # a gap of nothing is an even guess: two opposite observations at 0 anchor the curve
    x = np.r_[np.c_[gap, gap * np.sqrt(chars)], np.zeros((2, 2))]
    beta = charlm.logistic(x, np.r_[right, 1.0, 0.0], np.r_[np.ones(len(right)), 1.0, 1.0], ridge=1e-2)
    limit = float(seen.loc[right > 0, "ce"].max() * REJECT_MARGIN) if right.any() else float("inf")
    return {"langs": langs, "shared": shared, "beta": beta, "limit": limit}


def predict(docs: DataFrame, fitted: dict, keep: dict[str, str]) -> DataFrame:
    """Columns ``keep`` (name: type) of every row with lang_pred, score, cross_entropy (nats a character) and rejected."""
    if not fitted["langs"]:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    names = F.array(*[F.lit(x) for x in fitted["langs"]])
    b = [float(x) for x in fitted["beta"]]
    t = _scored(docs, list(keep), ", ".join(f"{k} {t}" for k, t in keep.items()), fitted["shared"])
    has = F.col("best") >= 0
    z = F.col("gap") * b[0] + F.col("gap") * F.sqrt("chars") * b[1] + b[2]
    return t.select(*keep,
                    F.when(has, F.get(names, F.col("best"))).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
                    F.when(has, 1 / (1 + F.exp(-z))).otherwise(F.lit(0.0)).alias("score"),
                    F.when(has, F.col("ce")).alias("cross_entropy"),
                    (~has | (F.col("ce") > fitted["limit"])).alias("rejected"))


def language_id(docs: DataFrame, train: Column, held_out: Column | None = None) -> DataFrame:
    """Predict the language of every document; learn only where ``train`` holds."""
    fitted = fit(docs.where(train))
    rows = docs.select("doc_id", (held_out if held_out is not None else ~train).alias("held_out"), "text")
    return predict(rows, fitted, {"doc_id": "long", "held_out": "boolean"})
