"""Language-model scores by context-tree weighting, with an add-one unigram base.

Text is scored as its lower-cased (A-Z) words joined by one space and closed by
an end byte.  Every byte is eight binary decisions; each decision (bits of the
byte so far) has its own tree over the preceding DEPTH bytes.  A tree node holds
the counts of its decision in the training texts, its Krichevsky-Trofimov (KT)
block probability, and the weighted probability that mixes it half and half
with the product of its children's.  A decision is then predicted by mixing the
nodes' KT estimates along its context, each by the posterior weight of stopping
there; a context the training texts never had ends the path.

Spark does the work in joins and groups: counts of (DEPTH + 1)-byte strings over
all texts; subtrees grouped by the three latest context bytes (a group is bounded
by the alphabet, 256**3 strings, however large the corpus); the levels above
(contexts of two bytes and less: 256**3 nodes at most, some 10**5 in practice)
are finished on the driver and broadcast.  Texts are dealt into
blocks; a block gets the counts of its own distinct words and the code lengths
of its own distinct strings by joins, so nothing that grows with the corpus is
broadcast.

Cases: null and empty texts are the end alone; repeated rows are scored each and
each teaches; with no training text the base is -log10(1) = 0 per token and
every bit costs one bit; extra columns are ignored; very long texts are scored
whole; ties don't occur.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import saved

U = np.uint64
DEPTH = 5
BLOCK_BYTES = 36_000_000
#: strings sorted at once while counting
SORT_AT_ONCE = 3_000_000
END = b"\n"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


def strings_of(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(packed (DEPTH + 1)-byte strings ending at every byte, bytes of each text); a text starts after DEPTH end bytes."""
    bodies = [b" ".join(t) + END for t in texts]
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    pad = END * DEPTH
    raw = np.frombuffer(pad.join([b"", *bodies]), np.uint8)  # every body has its padding in front
    first = np.cumsum(sizes + DEPTH) - sizes
    at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    g = np.zeros(len(raw), np.uint64)
    for k in range(DEPTH + 1):
        g[k:] |= raw[: len(raw) - k].astype(np.uint64) << U(8 * k)
    return g[at], sizes


def _bits(g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For 8 x n decisions: contexts, node of the byte's bits so far (1..255), bit."""
    x = (g & U(255)).astype(np.int64)
    node = np.stack([(1 << j) | (x >> (8 - j)) for j in range(8)])
    bit = np.stack([(x >> (7 - j)) & 1 for j in range(8)])
    return np.broadcast_to(g >> U(8), node.shape), node, bit


def _lgamma(x: np.ndarray) -> np.ndarray:
    y = x + 7
    s = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3)
    return s - np.log(x * (x + 1) * (x + 2)) - np.log((x + 3) * (x + 4) * (x + 5) * (x + 6))


def kt_block(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov block probability of n0 zeros and n1 ones."""
    return _lgamma(n0 + 0.5) + _lgamma(n1 + 0.5) - _lgamma(n0 + n1 + 1.0) - math.log(math.pi)


def _levels(g: np.ndarray, n: np.ndarray, top: int) -> dict[int, dict]:
    """Nodes of depths DEPTH..top: sorted keys (context << 8 | bits so far), counts, stopping weight, log Pw."""
    ctx, node, bit = _bits(g)
    key = ((ctx << U(8)) | node.astype(np.uint64)).ravel()
    n8 = np.broadcast_to(n.astype(np.float64), node.shape).ravel()
    keys, inv = np.unique(key, return_inverse=True)
    one = bit.ravel() == 1
    n1 = np.bincount(inv[one], n8[one], len(keys))
    n0 = np.bincount(inv[~one], n8[~one], len(keys))
    out, below = {}, None
    for d in range(DEPTH, top - 1, -1):
        if d < DEPTH:
            up = ((keys >> U(8)) & U((1 << (8 * d)) - 1)) << U(8) | (keys & U(255))
            child = below
            keys, inv = np.unique(up, return_inverse=True)
            n0, n1 = np.bincount(inv, n0, len(keys)), np.bincount(inv, n1, len(keys))
            split = np.bincount(inv, child, len(keys))
        le = kt_block(n0, n1)
        if d == DEPTH:
            w, lw = np.ones(len(keys)), le
        else:
            w = 1 / (1 + np.exp(np.clip(split - le, -50, 50)))
            lw = np.logaddexp(le, split) - math.log(2)
        below = lw
        out[d] = {"keys": keys, "n0": n0, "n1": n1, "w": w, "lw": lw, "kt": (n1 + 0.5) / (n0 + n1 + 1)}
    return out


def _slot(g: np.ndarray) -> np.ndarray:
    return ((g * U(0x9E3779B97F4A7C15)) >> U(42)).astype(np.int64)


def _find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(x.shape, np.int64), np.zeros(x.shape, bool)
    i = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return i, keys[i] == x


def upper_levels(c: np.ndarray, p: np.ndarray, n0: np.ndarray, n1: np.ndarray, split: np.ndarray) -> dict[str, np.ndarray]:
    """Depths 0 to 2 from rows (two latest bytes, bits so far, n0, n1, sum of the children's log Pw)."""
    keys = (c.astype(np.uint64) << U(8)) | p.astype(np.uint64)
    by = np.argsort(keys)
    keys, n0, n1, split = keys[by], n0[by], n1[by], split[by]
    le = kt_block(n0, n1)
    two = {"keys": keys, "w": 1 / (1 + np.exp(np.clip(split - le, -50, 50))), "kt": (n1 + 0.5) / (n0 + n1 + 1)}
    lw = np.logaddexp(le, split) - math.log(2)
    at = (keys & U(0xFFFF)).astype(np.int64)  # latest byte and bits so far
    n0, n1, split = (np.bincount(at, x, 1 << 16).reshape(256, 256) for x in (n0, n1, lw))
    seen1 = n0 + n1 > 0
    le1 = kt_block(n0, n1)
    w1 = 1 / (1 + np.exp(np.clip(split - le1, -50, 50)))
    lw1 = np.where(seen1, np.logaddexp(le1, split) - math.log(2), 0.0)
    m0, m1 = n0.sum(0), n1.sum(0)
    seen0 = m0 + m1 > 0
    le0, s0 = kt_block(m0, m1), lw1.sum(0)
    w0 = 1 / (1 + np.exp(np.clip(s0 - le0, -50, 50)))
    kt0, kt1 = (m1 + 0.5) / (m0 + m1 + 1), (n1 + 0.5) / (n0 + n1 + 1)
    end0 = np.where(seen0, kt0, 0.5)[None, :].repeat(256, 0)
    a0, r0 = (w0 * kt0)[None, :], (1 - w0)[None, :]
    return {"end": np.where(seen1, a0 + r0 * kt1, end0), "a": a0 + r0 * w1 * kt1, "r": r0 * (1 - w1), "two": two}


def code(g: np.ndarray, lv: dict[int, dict], top: dict[str, np.ndarray]) -> np.ndarray:
    """log10 probability of the last byte of each string ``g`` after its context; ``lv`` holds depths 3..DEPTH."""
    ctx, node, bit = _bits(g)
    byte = (ctx & U(255)).astype(np.int64)
    p = top["end"][byte, node].copy()
    a, r = top["a"][byte, node].copy(), top["r"][byte, node].copy()
    alive = np.ones(node.shape, bool)
    for d in range(2, DEPTH + 1):
        t = top["two"] if d == 2 else lv[d]
        key = ((ctx & U((1 << (8 * d)) - 1)) << U(8)) | node.astype(np.uint64)
        i, ok = _find(t["keys"], key)
        alive &= ok
        j = i[alive]
        p[alive] = a[alive] + r[alive] * t["kt"][j]
        a[alive] += r[alive] * t["w"][j] * t["kt"][j]
        r[alive] *= 1 - t["w"][j]
    return np.log10(np.where(bit == 1, p, 1 - p)).sum(0)


def _gather(docs: DataFrame) -> DataFrame:
    """(block, w, g, n): per block the distinct words (end: empty) and strings with their counts in training texts."""

    def run(batches):
        from collections import Counter

        held: dict[int, tuple] = {}

        def counted(raw: list, learn: bool) -> tuple[np.ndarray, np.ndarray]:
            g = np.concatenate(raw)
            raw.clear()
            g.sort()
            first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
            n = np.diff(np.concatenate((first, [len(g)]))) if learn else np.zeros(len(first), np.int64)
            return g[first], n

        def merged(done: list) -> tuple[np.ndarray, np.ndarray]:
            g, n = np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])
            done.clear()
            by = np.argsort(g, kind="stable")
            g, n = g[by], n[by]
            first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
            return g[first], np.add.reduceat(n, first)

        def rows(block):
            words, raw, done = held.pop(block)
            done += [counted(r, k) for k, r in raw.items() if r]
            g, n = merged(done) if done else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            w = list(words)
            for s in range(0, len(w), 100_000):
                part = w[s : s + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(part), pa.int32()), pa.array(part, pa.binary()), pa.nulls(len(part), pa.int64()), pa.array([words[x] for x in part], pa.int64())], ["block", "w", "g", "n"])
            for s in range(0, len(g), 100_000):
                m = len(g[s : s + 100_000])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, block, np.int32)), pa.nulls(m, pa.binary()), pa.array(g[s : s + 100_000].view(np.int64)), pa.array(n[s : s + 100_000])], ["block", "w", "g", "n"])

        for b in batches:
            block, train, texts = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            by: dict[tuple[int, bool], list[int]] = {}
            for i, k in enumerate(zip(block, train)):
                by.setdefault(k, []).append(i)
            for (k, learn), at in by.items():
                if k not in held:
                    for old in list(held):  # rows come sorted by block: the one before is done
                        yield from rows(old)
                    held[k] = (Counter(), {True: [], False: []}, [])
                words, raw, done = held[k]
                for s in range(0, len(at), 300):
                    split = [tokens_of(texts[i] or b"") for i in at[s : s + 300]]
                    if learn:
                        for t in split:
                            words.update(t)
                        words[b""] += len(split)
                    else:
                        for x in set().union(*split):
                            words.setdefault(x, 0)
                    raw[learn].append(strings_of(split)[0])
                    if sum(map(len, raw[learn])) > SORT_AT_ONCE:
                        done.append(counted(raw[learn], learn))
                        if sum(len(x) for x, _ in done[1:]) > SORT_AT_ONCE:  # the counts so far never grow beyond their distinct strings by more
                            done.append(merged(done))
        for old in list(held):
            yield from rows(old)

    return docs.mapInArrow(run, "block int, w binary, g long, n long")


def score(docs: DataFrame, held_out: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; learns where ``held_out`` is false."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    blocks = max(1, -(-(size[0] + size[1]) // block_bytes))
    block = F.pmod(F.xxhash64(F.lit(17), "doc_id", "text"), F.lit(blocks)).cast("int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("binary").alias("text"), block.alias("block"))
    dealt = rows.select("block", (~F.col("held_out")).alias("train"), "text").repartition(F.col("block")).sortWithinPartitions("block")
    parts = saved(_gather(dealt))

    words = parts.where("w is not null")
    counts = words.groupBy("w").agg(F.sum("n").alias("c"))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    n_train, kinds = int(total[0]), int(total[1])

    strings = saved(parts.where("g is not null").groupBy("g").agg(F.sum("n").alias("n")).withColumn("three", F.shiftright("g", 8).bitwiseAND(0xFFFFFF)))

    def subtree(table: pa.Table) -> pa.Table:
        g, n = table.column("g").to_numpy().view(np.uint64), table.column("n").to_numpy()
        t = _levels(g[n > 0], n[n > 0], 3)[3]
        return pa.table({"c": ((t["keys"] >> U(8)) & U(0xFFFF)).astype(np.int32), "p": (t["keys"] & U(255)).astype(np.int32), "n0": t["n0"], "n1": t["n1"], "lw": t["lw"]})

    shape = "c int, p int, n0 double, n1 double, lw double"
    trained = strings.where("n > 0")
    upper = trained.groupBy("three").applyInArrow(subtree, shape).groupBy("c", "p").agg(*[F.sum(x).alias(x) for x in ("n0", "n1", "lw")]).toArrow()
    shared = spark.sparkContext.broadcast(upper_levels(*[upper.column(x).to_numpy() for x in ("c", "p", "n0", "n1", "lw")]))

    def lengths(table: pa.Table) -> pa.Table:
        g, n = table.column("g").to_numpy().view(np.uint64), table.column("n").to_numpy()
        lv = _levels(g[n > 0], n[n > 0], 3)
        out = [code(g[s : s + 200_000], lv, shared.value) for s in range(0, len(g), 200_000)]
        return pa.table({"g": table.column("g"), "v": np.concatenate(out)})

    lengths_of = strings.groupBy("three").applyInArrow(lengths, "g long, v double")
    back = words.select("block", "w").join(counts.where("c > 0"), "w").select("block", "w", F.lit(None).cast("long").alias("g"), F.log10(F.col("c") + 1).alias("v"))
    back = back.unionByName(parts.where("g is not null").select("block", "g").join(lengths_of, "g").select("block", F.lit(None).cast("binary").alias("w"), "g", "v"))
    floor = math.log10(n_train + kinds + 1) if n_train else 0.0

    def block_scores(left: pa.Table, right: pa.Table) -> pa.Table:
        known: dict[bytes, float] = {}
        found, values = [np.zeros(0, np.uint64)], [np.zeros(0)]
        for b in right.select(["w", "g", "v"]).to_batches():  # batch by batch: no second copy of the whole table
            is_word = b.column(0).is_valid()
            words_ = b.filter(is_word)
            known.update(zip(words_.column(0).to_pylist(), words_.column(2).to_pylist()))
            rest = b.filter(b.column(1).is_valid())
            found.append(rest.column(1).to_numpy().view(np.uint64))
            values.append(rest.column(2).to_numpy())
        g, gv = np.concatenate(found), np.concatenate(values)
        del found, values
        by = np.argsort(g)
        g, gv = g[by], gv[by]
        del by
        slot = np.zeros(1 << 22, np.int32)  # where a string probably is; the few that clash are searched
        slot[_slot(g)] = np.arange(len(g), dtype=np.int32)
        texts = left.column("text")
        cols: list[list] = [[], [], [], []]
        for s in range(0, left.num_rows, 300):
            split = [tokens_of(t or b"") for t in texts.slice(s, 300).to_pylist()]
            strings_, sizes = strings_of(split)
            i = slot[_slot(strings_)]
            other = np.flatnonzero(g[i] != strings_)
            i[other] = np.searchsorted(g, strings_[other])
            value = gv[i]
            cols[3] += np.add.reduceat(value, np.cumsum(sizes) - sizes).tolist()
            for t in split:
                got = [x for x in map(known.get, t) if x is not None]
                end = known.get(b"")
                n = len(t) + 1
                cols[0].append(n)
                cols[1].append(len(got) + (end is not None))
                cols[2].append(math.fsum(got) + (end or 0.0) - n * floor)
        return pa.table({"doc_id": left.column("doc_id"), "held_out": left.column("held_out"), "n_tokens": pa.array(cols[0], pa.int64()), "n_known": pa.array(cols[1], pa.int64()),
                         "train_tokens": pa.array([n_train] * left.num_rows, pa.int64()), "base_score": pa.array(cols[2], pa.float64()), "score": pa.array(cols[3], pa.float64())})

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(block_scores, schema)
