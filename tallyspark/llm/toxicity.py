"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models, one of toxic and one of ordinary labelled
texts, give every expression (word) a log-likelihood ratio; their lower orders
share one pooled set of backoff counts, so rare expressions differ only by what
the class-specific orders have seen.  A text's evidence is its length-normalised
log-likelihood ratio and the ratios of its strongest expressions; a logistic
curve fitted on labelled texts the models have not seen turns it into a score.

Cases: a null or empty text, or one without letters, has no evidence (all
features 0) and gets the curve's value there; repeated rows are scored each;
null labels and labels of unknown documents teach nothing; contradicting labels
of one document count as toxic; with only one class
labelled every score is 0.0 (nothing toxic known) or the class share; extra
columns are ignored; very long texts are read whole.
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

ORDER = 5
SHARED_BELOW = 3
#: bound of the labelled sample: rows of each class (ordered by a hash of the id)
MAX_ROWS_PER_CLASS = 6000
THRESHOLD = 0.7
N_FEATURES = 5


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS) -> DataFrame:
    """(doc_id, cls, part, text) of at most ``max_rows`` labelled rows of each class; part 0 fits the models, 1 the curve."""
    by = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("cls"))
    picked = None
    for c in (0, 1):
        one = by.where(F.col("cls") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
        picked = one if picked is None else picked.unionAll(one)
    picked = picked.withColumn("part", (F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(10)) >= 6).cast("int"))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")  # 2 * max_rows ids


def _features(scorer: charlm.ChunkScorer, texts: list[str]) -> np.ndarray:
    rows, counts = scorer.rows(texts)
    out = np.zeros((len(texts), N_FEATURES))
    has = np.flatnonzero(counts)
    if not len(has):
        return out
    llr = rows[:, 1] - rows[:, 0]
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))[has]
    doc = np.repeat(np.arange(len(has)), counts[has])
    chars = np.maximum(np.add.reduceat(rows[:, 2], starts), 1)
    out[has, 0] = np.add.reduceat(llr, starts) / chars * 10
    left = llr.copy()
    for k in (1, 2, 3):  # the three strongest expressions
        top = np.maximum.reduceat(left, starts)
        out[has, k] = np.maximum(top, 0)
        hit = np.flatnonzero(left == top[doc])
        _, first = np.unique(doc[hit], return_index=True)
        left[hit[first]] = -np.inf
    out[has, 4] = np.log1p(np.add.reduceat(rows[:, 3], starts))
    return out


def _feature_rows(docs: DataFrame, keep: list[str], types: str, shared) -> DataFrame:
    """``keep`` columns and the features of each (.., text) row."""
    cols = keep if "text" in keep else [*keep, "text"]
    at = cols.index("text")

    def run(batches):
        model, digest = shared.value
        scorer = charlm.ChunkScorer(model, f"toxicity-{digest}")
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            for s, e in portions(texts):
                f = _features(scorer, texts[s:e])
                yield pa.RecordBatch.from_arrays([b.column(i).slice(s, e - s) for i in range(len(keep))] + [pa.array(f[:, j]) for j in range(N_FEATURES)], keep + [f"f{j}" for j in range(N_FEATURES)])

    return docs.select(*cols).mapInArrow(run, f"{types}, " + ", ".join(f"f{j} double" for j in range(N_FEATURES)))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS) -> dict:
    """Models and curve, learned from the labelled rows of ``docs`` (a bounded sample of ``max_rows`` of each class)."""
    sc = docs.sparkSession.sparkContext
    sample = labelled_sample(docs, labels, max_rows)
    model = charlm.fit(sample.where("part = 0"), 2, ORDER, SHARED_BELOW)
    shared = sc.broadcast((model, hashlib.md5(pickle.dumps(model)).hexdigest()))
    seen = _feature_rows(sample.where("part = 1"), ["cls"], "cls int", shared).toPandas()
    x, y = seen.filter(like="f").to_numpy(), seen["cls"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        beta = np.zeros(N_FEATURES + 1)
        beta[-1] = np.log((share + 1e-6) / (1 - share + 1e-6))
        mean, sd = np.zeros(N_FEATURES), np.ones(N_FEATURES)
    else:
        mean, sd = x.mean(0), x.std(0) + 1e-9
        beta = charlm.logistic((x - mean) / sd, y, ridge=0.3)
    return {"shared": shared, "mean": mean, "sd": sd, "beta": beta}


def score(docs: DataFrame, fitted: dict, keep: dict[str, str]) -> DataFrame:
    """Columns ``keep`` (name: type) of every row of ``docs`` with ``score``, ``predicted`` and ``llr`` (per 10 characters)."""
    mean, sd, beta = (F.array(*[F.lit(float(v)) for v in fitted[k]]) for k in ("mean", "sd", "beta"))
    f = _feature_rows(docs, list(keep), ", ".join(f"{k} {t}" for k, t in keep.items()), fitted["shared"])
    z = sum((((F.col(f"f{j}") - mean[j]) / sd[j]) * beta[j] for j in range(N_FEATURES)), beta[N_FEATURES])
    scored = f.select(*keep, (1 / (1 + F.exp(-z))).alias("score"), F.col("f0").alias("llr"))
    return scored.select(*keep, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "llr")


def toxicity(docs: DataFrame, labels: DataFrame, train: Column, held_out: Column | None = None) -> DataFrame:
    """Score every document; learn labels only where ``train`` holds."""
    fitted = fit(docs.where(train), labels)
    rows = docs.select("doc_id", (held_out if held_out is not None else ~train).alias("held_out"), "text")
    return score(rows, fitted, {"doc_id": "long", "held_out": "boolean"})
