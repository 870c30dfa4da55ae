"""op8 against plain Python, and the pipeline with planted rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import ctw
from tallyspark.llm.common import crc_mod

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(t):
    return (t or "").translate(LOWER).encode().split()


def brute(rows, held):
    """(base, context-tree) log10 scores by direct recursion over whole contexts."""
    counts, nodes = Counter(), {}
    bodies = {}
    for i, (d, t) in enumerate(rows):
        bodies[i] = ctw.END * ctw.DEPTH + b" ".join(tokens(t)) + ctw.END
        if held(d):
            continue
        counts.update(tokens(t))
        counts[b""] += 1
        for k in range(ctw.DEPTH, len(bodies[i])):
            for j in range(8):
                p = (1 << j) | (bodies[i][k] >> (8 - j))
                bit = (bodies[i][k] >> (7 - j)) & 1
                for n in range(ctw.DEPTH + 1):
                    nodes.setdefault((bodies[i][k - n : k], p), [0, 0])[bit] += 1
    lg = math.lgamma
    le = {k: lg(a + 0.5) + lg(b + 0.5) - lg(a + b + 1) - math.log(math.pi) for k, (a, b) in nodes.items()}
    kids = {}
    for c, p in nodes:
        if c:
            kids.setdefault((c[1:], p), []).append((c, p))
    lw, w = {}, {}
    for key in sorted(nodes, key=lambda x: -len(x[0])):
        if len(key[0]) == ctw.DEPTH:
            lw[key], w[key] = le[key], 1.0
        else:
            s = sum(lw[c] for c in kids[key])
            lw[key] = np.logaddexp(le[key], s) - math.log(2)
            w[key] = 1 / (1 + math.exp(min(50, max(-50, s - le[key]))))

    def one(ctx, p):
        a, r = 0.0, 1.0
        last = None
        for n in range(ctw.DEPTH + 1):
            key = (ctx[len(ctx) - n :], p)
            if key not in nodes:
                break
            x, y = nodes[key]
            kt = (y + 0.5) / (x + y + 1)
            last = a + r * kt
            a, r = a + r * w[key] * kt, r * (1 - w[key])
        return 0.5 if last is None else last

    n, v = sum(counts.values()), len(counts)
    out = []
    for i, (d, t) in enumerate(rows):
        toks = tokens(t) + [b""]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in toks)
        score = 0.0
        for k in range(ctw.DEPTH, len(bodies[i])):
            for j in range(8):
                q = one(bodies[i][k - ctw.DEPTH : k], (1 << j) | (bodies[i][k] >> (8 - j)))
                score += math.log10(q if (bodies[i][k] >> (7 - j)) & 1 else 1 - q)
        out.append((len(toks), sum(counts[x] > 0 for x in toks), n, base, score))
    return out


def test_scores_equal_direct_recursion(spark, docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "Cat", "sat.", "on", "mat", "émile", "x\ty\nz", "q%d" % i]) for _ in range(rng.randint(1, 12)))) for i in range(40)]
    rows += [(None, None), (41, ""), (42, " \t\n"), (43, "nbsp here"), (43, "nbsp here")]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    got = ctw.score(docs(rows), crc_mod("doc_id", 7) == 2, block_bytes=300).collect()
    want = brute(rows, held)
    key = lambda x: (str(x[0]), x[1], round(x[5], 6))
    a = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    b = sorted(((d, held(d), *w) for (d, _), w in zip(rows, want)), key=key)
    for x, y in zip(a, b, strict=True):
        assert x[:5] == y[:5]
        assert x[5] == pytest.approx(y[5], rel=1e-9) and x[6] == pytest.approx(y[6], rel=1e-6)
    assert ctw.score(docs(rows).limit(0), F.lit(False)).count() == 0


def test_next_byte_probabilities_sum_to_one(spark, docs):
    """All 256 bytes after one context, known or not."""
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(300)).encode().split()
    g, _ = ctw.strings_of([text])
    keys, n = np.unique(g, return_counts=True)
    lv = ctw._levels(keys, n, 3)
    t = lv[3]
    c, p = ((t["keys"] >> np.uint64(8)) & np.uint64(0xFFFF)).astype(int), (t["keys"] & np.uint64(255)).astype(int)
    two = {}
    for i in range(len(c)):
        x = two.setdefault((c[i], p[i]), [0.0, 0.0, 0.0])
        x[0] += t["n0"][i]; x[1] += t["n1"][i]; x[2] += t["lw"][i]  # noqa: E702
    k = list(two)
    top = ctw.upper_levels(np.array([a for a, _ in k]), np.array([b for _, b in k]), *np.array([two[x] for x in k]).T)
    for ctx in (b"alpha", b"zzzzz", b"  alp", b"xlpha"):
        s = sum(int(b) << (8 * (len(ctx) - i)) for i, b in enumerate(ctx))
        q = np.array([s | x for x in range(256)], np.uint64)
        assert 10 ** ctw.code(q, lv, top) @ np.ones(256) == pytest.approx(1.0, rel=1e-9)


def test_pipeline_keeps_clean_and_drops_planted(spark, tmp_path):
    rng = random.Random(7)
    syl = "th er on an re he in ed nd ha ti en es".split()
    prose = lambda n: " ".join("".join(rng.choice(syl) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows, labels = [], []
    for i in range(150):
        rows.append([i, prose(60), "en", "s", 0])
        labels.append((i, 1, 0))
    for i in range(150, 200):
        w = prose(60).split()
        for _ in range(4):
            w.insert(rng.randrange(60), rng.choice(["scumbag", "moronic", "vilexx"]))
        rows.append([i, " ".join(w), "en", "s", 0])
        labels.append((i, 0, 1))
    item = prose(40) + "."
    rows.append([200, prose(30) + " " + item + " " + prose(30), "en", "s", 0])
    rows += [[201, rows[3][1], "en", "s", 0], [202, rows[4][1] + " extra", "en", "s", 0], [203, "123 456", "en", "s", 0], [204, None, None, None, None]]
    sf = str(tmp_path)
    spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        docs = out
        left.append({r.doc_id for r in docs.select("doc_id").distinct().collect()})
    clean = set(range(150))
    assert not left[0] & set(range(150, 200)) and clean <= left[0]
    assert {203, 204} <= left[0] and not {203, 204} & left[1] and clean <= left[1]
    assert not {201, 202} & left[2] and clean <= left[2]
    assert left[3] == clean and left[4] == clean
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").distinct().collect()} == clean
