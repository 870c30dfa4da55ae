"""Benchmark decontamination by latent semantic retrieval.

Passages (32 words, every 16) are TF-IDF vectors over hashed words.  A
randomised SVD of all half-passages, run as two distributed passes over all
texts, gives a latent space; every passage of every document and
every benchmark passage is projected into it, and cosine search (blocks of
passages against all benchmark passages) finds candidates.  A candidate is then
read again as words: the longest common subsequence of the item with the
document around the passage must hold most of the item, and the answer (the
item's last sentence) must be there too.

Document frequencies and the index space cover all passages, and every passage
is searched.

Cases: null and empty texts contain nothing; items without words match nothing;
repeated rows and items are judged each; an empty benchmark or table gives no
rows; extra columns are ignored; very long texts are searched whole; equal
matches are all returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import bytewords
from tallyspark.llm.common import portions, worker_cache

U = np.uint64
FEATURES = 1 << 14
DIMENSIONS = 64
WIDTH, STRIDE = 32, 16
COSINE = 0.4
#: share of an item's words that the common subsequence must hold, and of its last sentence's words
COMMON, ANSWER = 0.75, 0.5
#: candidates whose surrounding words are counted at once
COUNTED = 1024
#: texts of more words are not held against their words in any order before the candidates' spans are
WHOLE_TEXT = 1 << 16
#: benchmark rows held by each task at once; more are searched in several blocks
ITEM_BLOCK = 500


def _bytes():
    """Lower-cased text as bytes (accented letters too)."""
    return F.lower(F.col("text").cast("string")).cast("binary").alias("text")


def _features(texts: list[bytes], cache: dict) -> tuple[np.ndarray, np.ndarray]:
    h, counts = bytewords.words(texts, cache)
    return (h % U(FEATURES)).astype(np.int32), counts


def _chunks(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-passages of STRIDE words: (first word of each, text of each)."""
    per = -(-counts // STRIDE)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    text = np.repeat(np.arange(len(counts)), per)
    k = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    return first[text] + k * STRIDE, text


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(half-passages that hold each hashed word, number of half-passages) over all texts."""

    def run(batches):
        cache = worker_cache("bytewords")
        df, n = np.zeros(FEATURES, np.int64), 0
        for b in batches:
            texts = [t or b"" for t in b.column(0).to_pylist()]
            for s, e in portions(texts):
                f, counts = _features(texts[s:e], cache)
                if not len(f):
                    continue
                at, _ = _chunks(counts)
                chunk = np.repeat(np.arange(len(at)), np.diff(np.concatenate((at, [len(f)]))))
                key = np.sort(chunk * FEATURES + f)
                key = key[np.concatenate(([True], key[1:] != key[:-1]))]
                df += np.bincount(key % FEATURES, minlength=FEATURES)
                n += len(at)
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(hit, -1).astype(np.int32)), pa.array(np.append(df[hit], n))], ["f", "n"])

    rows = docs.select(_bytes()).mapInArrow(run, "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(FEATURES)
    at = rows["f"].to_numpy()
    df[at[at >= 0]] = rows["n"].to_numpy()[at >= 0]
    return df, int(rows["n"].to_numpy()[at < 0].sum())


def _project(f: np.ndarray, counts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit vectors of the passages, first word, text): passage = a half-passage and the next of the same text."""
    at, text = _chunks(counts)
    span = at[:, None] + np.arange(STRIDE)[None, :]
    inside = span < np.minimum(at + STRIDE, np.cumsum(counts)[text])[:, None]
    index = np.where(inside, f[np.minimum(span, len(f) - 1)], len(table) - 1)  # the last row of the table is zero
    half = np.empty((len(at), table.shape[1]), np.float32)
    for s in range(0, len(at), 512):
        half[s : s + 512] = np.einsum("ijk->ik", table.take(index[s : s + 512], 0))
    vec = half.copy()
    same = np.flatnonzero(text[1:] == text[:-1])
    vec[same] += half[same + 1]
    norm = np.sqrt(np.einsum("ij,ij->i", vec, vec))
    return vec / np.maximum(norm, 1e-12)[:, None], at, text


def _group_sums(values: np.ndarray, order: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sum of values[order[s : s + n]] for every (s, n) of ``start`` and ``count`` (1 to STRIDE); the last row of ``values`` is zero."""
    out = np.zeros((len(start), values.shape[1]), np.float32)
    width = 1
    while width <= STRIDE:  # groups of like size together
        like = np.flatnonzero((count <= width) & (count > width // 2))
        for s in range(0, len(like), 512):
            g = like[s : s + 512]
            i = np.arange(width)[None, :]
            at = np.where(i < count[g][:, None], order[np.minimum(start[g][:, None] + i, len(order) - 1)], len(values) - 1)
            out[g] = np.einsum("ijk->ik", values.take(at, 0))
        width *= 2
    return out


def _gram_pass(texts: DataFrame, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A' A basis, where A holds all half-passages as unit TF-IDF rows; summed by Spark, a row per word comes back."""
    table = np.r_[idf[:, None] * basis, np.zeros((1, DIMENSIONS))].astype(np.float32)
    shared = texts.sparkSession.sparkContext.broadcast((idf, table))

    def rows(out):
        hit = np.flatnonzero(np.abs(out).sum(1))
        for s in range(0, len(hit), 4096):
            v = out[hit[s : s + 4096]].astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(hit[s : s + 4096].astype(np.int32)), pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), DIMENSIONS).cast(pa.list_(pa.float32()))], ["f", "v"])

    def run(batches):
        weight, table = shared.value
        cache = worker_cache("bytewords")
        out = np.zeros((FEATURES, DIMENSIONS))
        for b in batches:
            texts = [t or b"" for t in b.column(0).to_pylist()]
            for s, e in portions(texts):
                f, counts = _features(texts[s:e], cache)
                if not len(f):
                    continue
                at, _ = _chunks(counts)
                size = np.diff(np.concatenate((at, [len(f)])))
                y = _group_sums(table, f, at, size) / np.maximum(np.add.reduceat(weight[f] ** 2, at), 1e-9)[:, None]
                by = np.argsort(f.astype(np.uint16), kind="stable")
                half = np.repeat(np.arange(len(at)), size)[by]
                n = np.bincount(f, minlength=FEATURES)
                per = -(-n // STRIDE)  # a word's rows are added up in groups of STRIDE, then the groups
                word = np.repeat(np.arange(FEATURES), per)
                first = (np.cumsum(n) - n)[word] + STRIDE * (np.arange(len(word)) - np.repeat(np.cumsum(per) - per, per))
                part = _group_sums(np.r_[y, np.zeros((1, DIMENSIONS))].astype(np.float32), half, first, np.minimum(STRIDE, np.cumsum(n)[word] - first))
                new = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
                out[word[new]] += np.add.reduceat(part, new, axis=0)
        yield from rows(out * weight[:, None])

    def total(batches):
        out = np.zeros((FEATURES, DIMENSIONS))
        for b in batches:
            np.add.at(out, b.column(0).to_numpy(), b.column(1).flatten().to_numpy().reshape(-1, DIMENSIONS))
        yield from rows(out)

    schema = "f int, v array<float>"
    sums = texts.mapInArrow(run, schema).repartition("f").mapInArrow(total, schema).toArrow()
    y = np.zeros((FEATURES, DIMENSIONS))
    if sums.num_rows:
        y[sums.column(0).to_numpy()] = sums.column(1).combine_chunks().flatten().to_numpy().reshape(-1, DIMENSIONS)
    return y


def latent_space(docs: DataFrame, benchmark: DataFrame, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(IDF of each hashed word, word vectors): a randomised SVD of the TF-IDF matrix of all half-passages.

    Two passes over the texts: the range of A'A from random vectors, then the singular vectors and values within
    it (Rayleigh-Ritz).  A word's vector is its row of V scaled by 1 / singular value, the usual folding-in.
    One FEATURES x DIMENSIONS matrix a pass is all the driver gets, whatever the number of documents.
    """
    texts = docs.select("text").unionByName(benchmark.select("text"))
    df, n = document_frequencies(texts)
    idf = (np.log((n + 1) / (df + 1)) + 0.1).astype(np.float32)
    texts = texts.select(_bytes())
    basis = np.linalg.qr(_gram_pass(texts, idf, np.random.default_rng(seed).standard_normal((FEATURES, DIMENSIONS))))[0]
    square, turn = np.linalg.eigh(basis.T @ _gram_pass(texts, idf, basis))
    good = square > 1e-9 * max(square.max(), 1e-9)
    vectors = basis @ (turn * np.where(good, 1 / np.sqrt(np.where(good, square, 1)), 0))
    return idf, np.r_[idf[:, None] * vectors, np.zeros((1, DIMENSIONS))].astype(np.float32)


def common_subsequence(item: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence (bit-parallel over the item's words)."""
    place: dict[int, int] = {}
    for i, w in enumerate(item):
        place[w] = place.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in text:
        m = place.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def _items(rows: list[tuple[int, str]], table: np.ndarray) -> dict:
    """Benchmark block: words, answer words and passage vectors of each item."""
    import re

    cache: dict = {}
    ids, texts = [r[0] for r in rows], [(r[1] or "").lower().encode() for r in rows]
    last = [([x for x in re.split(r"(?<=[.!?])\s+", (r[1] or "").strip()) if x] or [""])[-1].lower().encode() for r in rows]
    words, n = bytewords.words(texts, cache)
    aw, an = bytewords.words(last, cache)
    cut = lambda h, c: [x.tolist() for x in np.split(h, np.cumsum(c)[:-1])] if len(c) else []
    vec, at, item = _project((words % U(FEATURES)).astype(np.int32), n, table) if len(words) else (np.zeros((0, DIMENSIONS), np.float32), np.zeros(0, int), np.zeros(0, int))
    nth = at - (np.cumsum(n) - n)[item]
    whole = (nth % WIDTH == 0) & ((nth == 0) | (n[item] - nth >= STRIDE))  # passages side by side, without a short tail
    vec, item = vec[whole], item[whole]
    member = np.zeros((len(rows), FEATURES), bool)
    member[np.repeat(np.arange(len(rows)), n), (words % U(FEATURES)).astype(np.int64)] = True
    listed = np.full((len(rows), max(n.max(initial=0), 1)), FEATURES)  # each item's words, filled up with one that no text has
    listed[np.repeat(np.arange(len(rows)), n), np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n)] = words % U(FEATURES)
    return {"ids": ids, "words": cut(words, n), "answer": cut(aw, an), "vec": vec.astype(np.float32), "item": item, "member": member, "listed": listed, "n": n}


def contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, common: float = COMMON, answer: float = ANSWER) -> DataFrame:
    """One row per document and item it contains: doc_id, item_id, cosine, common (share of the item's words found in order)."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, cosine double, common double"
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = bench.count()
    if not total:
        return spark.createDataFrame([], schema)
    idf, table = latent_space(docs.select(F.col("text").cast("string").alias("text")), bench)
    blocks = -(-total // ITEM_BLOCK)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _bytes())
    out = None
    for k in range(blocks):  # bounded blocks of the benchmark, each against all documents
        part = [(r["item_id"], r["text"]) for r in bench.where(block == k).collect()]
        shared = spark.sparkContext.broadcast((part, table))
        found = rows.mapInArrow(_search(shared, cosine, common, answer), schema)
        out = found if out is None else out.unionAll(found)
    return out


def _may_hold(items: dict, f: np.ndarray, start: np.ndarray, text: np.ndarray, it: np.ndarray, ends: np.ndarray, counts: np.ndarray, common: float) -> np.ndarray:
    """Whether the words compared in order for each candidate hold ``common`` of its item's words in any order.

    The count is over the same words as the common subsequence, so it is an upper bound of it.
    """
    n = items["n"][it]
    lo = np.maximum(start - n, (ends - counts)[text])
    hi = np.minimum(start + WIDTH + n, ends[text])
    hits = np.zeros(len(it), np.int64)
    by = np.argsort(hi - lo, kind="stable")  # spans of like length together
    for s in range(0, len(by), COUNTED):
        k = by[s : s + COUNTED]
        span = lo[k][:, None] + np.arange((hi - lo)[k].max())[None, :]
        there = span < hi[k][:, None]
        hits[k] = (items["member"][it[k][:, None], f[np.minimum(span, len(f) - 1)]] & there).sum(1)
    return hits / n >= common


def _text_may_hold(items: dict, f: np.ndarray, text: np.ndarray, it: np.ndarray, ends: np.ndarray, counts: np.ndarray, common: float) -> np.ndarray:
    """Whether each candidate's whole text has ``common`` of its item's words at all: an upper bound of the common subsequence."""
    texts, row = np.unique(text, return_inverse=True)
    short = np.flatnonzero(counts[texts] <= WHOLE_TEXT)
    has = np.zeros((len(texts), FEATURES + 1), bool)
    n = counts[texts[short]]
    at = np.arange(n.sum()) + np.repeat((ends - counts)[texts[short]] - (np.cumsum(n) - n), n)
    has[np.repeat(short, n), f[at]] = True
    pairs, back = np.unique(row * len(items["n"]) + it, return_inverse=True)
    r, i = np.divmod(pairs, len(items["n"]))
    hits = np.empty(len(pairs), np.int64)
    for s in range(0, len(pairs), COUNTED):
        k = slice(s, s + COUNTED)
        hits[k] = has[r[k][:, None], items["listed"][i[k]]].sum(1)
    return ((hits / items["n"][i] >= common) | (counts[texts] > WHOLE_TEXT)[r])[back]


def _search(shared, cosine: float, common: float, answer: float):
    def run(batches):
        part, table = shared.value
        items = _items(part, table)
        cache = worker_cache("bytewords")
        for b in batches:
            ids, texts = b.column(0).to_pylist(), [t or b"" for t in b.column(1).to_pylist()]
            out: list[tuple] = []
            for s, e in portions(texts):
                h, counts = bytewords.words(texts[s:e], cache)
                if not len(h) or not len(items["vec"]):
                    continue
                f = (h % U(FEATURES)).astype(np.int32)
                vec, at, text = _project(f, counts, table)
                ends = np.cumsum(counts)
                best: dict[tuple[int, int], list] = {}
                for p in range(0, len(vec), 4096):
                    sim = vec[p : p + 4096] @ items["vec"].T
                    w, j = np.nonzero(sim >= cosine)
                    if not len(w):
                        continue
                    value, w, it = sim[w, j], w + p, items["item"][j]
                    go = _text_may_hold(items, f, text[w], it, ends, counts, common)
                    value, w, it = value[go], w[go], it[go]
                    for q in np.flatnonzero(_may_hold(items, f, at[w], text[w], it, ends, counts, common)).tolist():
                        best.setdefault((int(text[w[q]]), int(it[q])), []).append((int(at[w[q]]), float(value[q])))
                for (d, i), where in best.items():
                    n = int(items["n"][i])
                    lo, hi = int(ends[d] - counts[d]), int(ends[d])
                    top, spans = 0.0, set()
                    for start, _ in sorted(where, key=lambda x: -x[1]):
                        if top == 1.0:
                            break
                        a, z = max(lo, start - n), min(hi, start + WIDTH + n)
                        if (a, z) in spans:
                            continue
                        spans.add((a, z))
                        near = h[a:z]
                        listed = near.tolist()
                        if sum(map(set(listed).__contains__, items["words"][i])) / n < common:  # an upper bound, without the order
                            continue
                        got = common_subsequence(items["words"][i], listed) / n
                        if got > top and got >= common:
                            m = items["answer"][i]
                            if not m or common_subsequence(m, near.tolist()) >= answer * len(m):
                                top = got
                    if top:
                        out.append((ids[s + d], items["ids"][i], max(v for _, v in where), top))
            cols = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64())], ["doc_id", "item_id", "cosine", "common"])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item; rows with a null doc_id are judged by their text."""
    marked = docs.withColumn("__key", F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.coalesce("text", F.lit(""))))
    bad = contaminated(marked.select(F.col("__key").alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__key")).distinct()
    return marked.join(bad, "__key", "left_anti").select(*docs.columns)
