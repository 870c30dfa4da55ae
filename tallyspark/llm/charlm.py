"""Class-conditional interpolated Kneser-Ney character models over words.

Counts are gathered by Spark from a bounded sample of labelled rows (word counts
per class, then character n-grams of the distinct words); the finished model is
a few sorted arrays of 64-bit n-gram hashes with log-probabilities per class,
found by binary search.  Orders below ``shared_below`` use continuation counts
pooled over all classes: an expression no class has seen gets the same
probability from each of them, so it speaks for none.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import portions, worker_cache

U = np.uint64
BOS, EOS = "\x02", "\x03"
_STEP = U(0x9E3779B97F4A7C15)
#: word characters that are numbers but no letters (superscripts, fractions, ...): \d is decimal digits only
_NUMBERS = "".join(c for c in map(chr, range(0x110000)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())
#: runs of letters (Unicode categories L*), and the quicker pattern that also takes those numbers
LETTERS, _MOSTLY_LETTERS = re.compile(rf"[^\W\d_{_NUMBERS}]+"), re.compile(r"[^\W\d_]+")
GRAM_SCHEMA = "o int, cls int, k long, ctx long, suf long, bos boolean, n long"


def letter_runs(text: str) -> list[str]:
    """The runs of letters in ``text``."""
    runs = _MOSTLY_LETTERS.findall(text)
    return runs if not runs or "".join(runs).isalpha() else LETTERS.findall(text)


def gram_hashes(words: list[str], order: int):
    """For every predicted character: its word's index, and per order o the gram hash (0 where the word is too short)."""
    s = np.frombuffer("".join(f"{BOS}{w}{EOS}" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    word = np.repeat(np.arange(len(words)), sizes)
    pos = np.arange(len(s)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    h = [s + U(1)]
    for _ in range(1, order):
        prev = np.zeros(len(s), np.uint64)
        prev[1:] = h[-1][:-1]
        h.append(prev * _STEP + s + U(1))
    return word, pos, h


def word_counts(docs: DataFrame, max_words: int = 400_000) -> DataFrame:
    """(cls, word, n) over ``docs`` (cls int, text): lower-cased letter runs, counted per batch, then summed by Spark."""

    def count(batches):
        from collections import Counter

        for b in batches:
            cls, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            by: dict[int, Counter] = {}
            for c, t in zip(cls, texts):
                by.setdefault(c, Counter()).update(letter_runs((t or "").lower()))
            for c, n in by.items():
                w = list(n)
                for i in range(0, len(w), max_words):
                    part = w[i : i + max_words]
                    yield pa.RecordBatch.from_arrays([pa.array([c] * len(part), pa.int32()), pa.array(part, pa.string()), pa.array([n[x] for x in part], pa.int64())], ["cls", "word", "n"])

    return docs.select("cls", "text").mapInArrow(count, "cls int, word string, n long").groupBy("cls", "word").agg(F.sum("n").alias("n"))


def gram_counts(counts: DataFrame, order: int) -> DataFrame:
    """Raw n-gram counts (order, class, gram, context, suffix gram, whether it starts the word) of the counted words."""

    def grams(batches):
        for b in batches:
            cls, ws, n = (b.column(i).to_pylist() for i in range(3))
            for s, e in portions(ws, 200_000):
                word, pos, h = gram_hashes(ws[s:e], order)
                wc, wn = np.array(cls[s:e]), np.array(n[s:e])
                for o in range(1, order + 1):
                    at = np.flatnonzero((pos >= max(1, o - 1)))
                    key, c, m = h[o - 1][at], wc[word[at]], wn[word[at]]
                    by = np.lexsort((c, key))
                    key, c, at = key[by], c[by], at[by]
                    new = np.ones(len(key), bool)
                    new[1:] = (key[1:] != key[:-1]) | (c[1:] != c[:-1])
                    first = np.flatnonzero(new)
                    if not len(first):
                        continue
                    total, i = np.add.reduceat(m[by], first), at[first]
                    ctx = h[o - 2][i - 1] if o > 1 else np.zeros(len(i), np.uint64)
                    suf = h[o - 2][i] if o > 1 else np.zeros(len(i), np.uint64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(i), o, np.int32)), pa.array(c[first].astype(np.int32)), pa.array(key[first].view(np.int64)),
                        pa.array(ctx.view(np.int64)), pa.array(suf.view(np.int64)), pa.array(pos[i] == o - 1), pa.array(total)],
                        ["o", "cls", "k", "ctx", "suf", "bos", "n"])

    return counts.select("cls", "word", "n").mapInArrow(grams, GRAM_SCHEMA).groupBy("o", "cls", "k").agg(
        F.first("ctx").alias("ctx"), F.first("suf").alias("suf"), F.first("bos").alias("bos"), F.sum("n").alias("n"))


def fit(docs: DataFrame, classes: int, order: int, shared_below: int = 1) -> dict:
    """The model of ``docs`` (cls int 0..classes-1, text), which must be a bounded sample: its size follows the sample's."""
    t = gram_counts(word_counts(docs), order).select("o", "cls", "k", "ctx", "suf", "bos", "n").toArrow()
    o, cls, k, ctx, suf, bos, n = (t.column(i).to_numpy() for i in range(7))
    k, ctx, suf = k.view(np.uint64), ctx.view(np.uint64), suf.view(np.uint64)
    model: dict = {"order": order, "classes": classes, "levels": []}
    tables = []
    for lv in range(1, order + 1):
        at = np.flatnonzero(o == lv)
        keys, first, inv = np.unique(k[at], return_index=True, return_inverse=True)
        raw = np.zeros((len(keys), classes))
        np.add.at(raw, (inv, cls[at]), n[at])
        tables.append((keys, ctx[at][first], suf[at][first], bos[at][first], raw))
    lower = None
    for lv, (keys, cx, sf, starts, raw) in enumerate(tables, 1):
        c = raw.copy()
        if lv < order:  # continuation counts: distinct characters before the gram
            up_keys, _, up_suf, _, up_raw = tables[lv]
            cont = np.zeros_like(raw)
            if len(keys) and len(up_keys):
                i = np.minimum(np.searchsorted(keys, up_suf), len(keys) - 1)
                ok = keys[i] == up_suf
                np.add.at(cont, i[ok], (up_raw[ok] > 0).astype(float))
            c = np.where(starts[:, None] & (lv > 1), raw, cont)
        if lv < shared_below:
            c = np.repeat(c.sum(1, keepdims=True), classes, 1)
        once, twice = (c == 1).sum(0), (c == 2).sum(0)
        d = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
        ck, ci = np.unique(cx, return_inverse=True)
        tot, kinds = np.zeros((len(ck), classes)), np.zeros((len(ck), classes))
        np.add.at(tot, ci, c)
        np.add.at(kinds, ci, (c > 0).astype(float))
        with np.errstate(divide="ignore", invalid="ignore"):
            bow = np.where(tot > 0, d * kinds / tot, 1.0)
            top = np.where(tot[ci] > 0, np.maximum(c - d, 0) / tot[ci], 0.0)
        if lower is None:
            base = np.full((len(keys), classes), 1.0 / (len(keys) + 64))
        else:
            lk, lp = lower
            base = lp[np.minimum(np.searchsorted(lk, sf), len(lk) - 1)] if len(lk) else np.full((len(keys), classes), 1e-6)
        prob = top + bow[ci] * base
        model["levels"].append((keys, np.log(prob).astype(np.float32), ck, np.log(bow).astype(np.float32)))
        lower = (keys, prob)
    chars = len(tables[0][0]) if tables else 0
    model["floor"] = float(np.log(1.0 / (chars + 64)))
    return model


def _find(keys: np.ndarray, x: np.ndarray):
    if not len(keys):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    i = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return i, keys[i] == x


def log_probs(model: dict, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(sum of log P over the characters and the end of each word, per class; characters counted)."""
    c = model["classes"]
    word, pos, h = gram_hashes(words, model["order"])
    lp = np.full((len(pos), c), model["floor"], np.float32)
    for o, (keys, logp, ctxs, bow) in enumerate(model["levels"], 1):
        at = np.flatnonzero(pos >= max(1, o - 1))
        i, ok = _find(keys, h[o - 1][at])
        if o == 1:
            miss = at[~ok]
            if len(bow):
                lp[miss] += bow[0]
        else:
            miss = at[~ok]
            j, seen = _find(ctxs, h[o - 2][miss - 1])
            lp[miss[seen]] += bow[j[seen]]
        lp[at[ok]] = logp[i[ok]]
    lp[pos == 0] = 0
    total = np.zeros((len(words), c))
    if len(words):
        starts = np.flatnonzero(pos == 0)
        total = np.add.reduceat(lp, starts, axis=0).astype(np.float64)
    return total, np.fromiter((len(w) + 1 for w in words), np.int64, len(words))


class ChunkScorer:
    """Scores white-space chunks of texts; a chunk's value is worked out once per worker and kept (bounded)."""

    def __init__(self, model: dict, name: str, keep: int = 400_000):
        self.model, self.keep = model, keep
        self.state = worker_cache(name)
        if "index" not in self.state:
            self._clear()

    def _clear(self):
        self.state["index"] = {}
        self.state["rows"] = np.zeros((0, self.model["classes"] + 2))

    def _learn(self, chunks: list[str]):
        # a chunk may hold several letter runs, or none
        runs = [letter_runs(c.lower()) for c in chunks]
        flat = sorted({w for r in runs for w in r})
        at = {w: i for i, w in enumerate(flat)}
        lp, n = log_probs(self.model, flat) if flat else (np.zeros((0, self.model["classes"])), np.zeros(0, np.int64))
        rows = np.zeros((len(chunks), self.model["classes"] + 2))
        for j, r in enumerate(runs):
            for w in r:
                i = at[w]
                rows[j, :-2] += lp[i]
                rows[j, -2] += n[i]
            rows[j, -1] = len(r)
        index, base = self.state["index"], len(self.state["rows"])
        for j, c in enumerate(chunks):
            index[c] = base + j
        self.state["parts"] = None
        self.state["rows"] = np.concatenate((self.state["rows"], rows))

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(one row per chunk: log P per class, characters, words; number of chunks of each text)."""
        split = [t.split() for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        flat = [c for s in split for c in s]
        if len(self.state["index"]) > self.keep:
            self._clear()
        idx = list(map(self.state["index"].get, flat))
        if None in idx:
            self._learn(list({c for c, i in zip(flat, idx) if i is None}))
            idx = list(map(self.state["index"].get, flat))
        return self.state["rows"][np.array(idx, np.int64)], counts


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last coefficient is the intercept."""
    a = np.c_[x, np.ones(len(x))]
    w = np.ones(len(x)) if weight is None else weight
    beta = np.zeros(a.shape[1])
    reg = np.full(a.shape[1], ridge)
    reg[-1] = 1e-4
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        g = a.T @ (w * (y - p)) - reg * beta
        hess = (a * (w * p * (1 - p))[:, None]).T @ a + np.diag(reg + 1e-9)
        step = np.linalg.solve(hess, g)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return beta
