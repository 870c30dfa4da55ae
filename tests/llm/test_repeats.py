"""op12: grammar extensions and runs against plain Python, planted runs, and the odd cases."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.llm import repeats
from tallyspark.llm.queries import _table


def plain_runs(w):
    n, by = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                by.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in by.items())


def plain_row(doc_id, text, made=True):
    w = [x for x in "".join(" " if c in "\x20\x09\x0a\x0b\x0c\x0d" else c for c in text or "").split(" ") if x]
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if made and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = plain_runs(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = None if not runs else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def periodic(rng, n, letters):
    out = []
    while len(out) < n:
        if rng.random() < 0.5:
            out += [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        else:
            p = [rng.choice(letters) for _ in range(rng.randint(1, 7))]
            out += (p * 12)[: rng.randint(len(p), 11 * len(p))]
    return out[:n]


def test_runs_against_plain_search():
    rng = random.Random(2)
    for trial in range(40):
        texts = [[x.encode() for x in periodic(rng, rng.choice([0, 1, 5, 6, 7, 60, 300]), "ab"[: rng.choice([1, 2])] + "cdefgh"[: rng.randint(0, 6)])] for _ in range(rng.randint(1, 12))]
        got = [[tuple(r) for r in m.tolist()] for m in repeats.find_runs(texts)]
        assert got == [plain_runs(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), min_size=1, max_size=4))
def test_runs_property(texts):
    assert [[tuple(r) for r in m.tolist()] for m in repeats.find_runs(texts)] == [plain_runs(t) for t in texts]


def test_extensions_are_exact():
    rng = random.Random(9)
    w = np.array([1000] + [rng.randrange(3) for _ in range(400)] + [0, 1] * 150 + [2] * 120 + [1001] + [rng.randrange(2) for _ in range(300)] + [1002])
    names, w = np.unique(w, return_inverse=True)
    g = repeats.Grammar(w, len(names) - 3)
    assert len(g.levels) > 5
    a = np.array([rng.randrange(1, len(w) - 2) for _ in range(3000)])
    b = np.array([rng.randrange(x + 1, len(w) - 1) for x in a])
    for back in (False, True):
        for x, y, r in zip(a.tolist(), b.tolist(), g.extend(a, b, back).tolist()):
            k = 0
            while (w[x - 1 - k] == w[y - 1 - k]) if back else (w[x + k] == w[y + k]):
                k += 1
            assert k == r


def test_query_on_the_smallest_documents(spark):
    docs = _table(spark, "/root/testdata/sf0.001", "documents")
    from tallyspark.llm.queries import op12_periodic_runs
    got = {tuple(r) for r in op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert got == {plain_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    assert sum(1 for r in got if r[1]) >= 5


def test_odd_texts(spark, docs):
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a a a a a a b"), (5, "x " * 30_000), (5, "x " * 30_000),
            (6, "a b a b a b a b a b a b"), (7, "a\x1cb " * 9), (8, "p q r " * 4 + "p"), (9, "p q r " * 3 + "p q")]
    d = docs(rows).withColumn("runs", F.lit(1)).withColumn("h", F.lit("h")).withColumn("collapsed", F.lit("c"))
    got = sorted(map(tuple, repeats.report(repeats.repetitions(d)).collect()), key=str)
    assert got == sorted((plain_row(*r, made=False) for r in rows), key=str)
    real = {r.doc_id: r for r in repeats.repetitions(d.where("doc_id >= 8")).collect()}
    assert [tuple(x) for x in real[8].runs] == [(0, 13, 3)] and bytes(real[8].collapsed) == b"p q r" and real[9].runs == []


def test_no_rows(spark, docs):
    assert repeats.report(repeats.repetitions(docs([(1, "a")]).where("doc_id = 2"))).collect() == []
