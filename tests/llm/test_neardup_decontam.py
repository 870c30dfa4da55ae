"""op5 and op7 against brute force on small tables."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import bytewords, decontam, neardup
from tallyspark.llm.components import components


def words(rng, n, v=3000):
    return ["w%d" % rng.randrange(v) for _ in range(n)]


def edited(rng, ws, k):
    ws = list(ws)
    for _ in range(k):
        ws[rng.randrange(len(ws))] = "e%d" % rng.randrange(10**6)
    return ws


def shingle_set(t):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_classes(rows):
    root = {i: i for i in range(len(rows))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [shingle_set(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    return [min(least[find(i)]) for i in range(len(rows))]


def sample(seed=1):
    rng = random.Random(seed)
    rows = []
    for g in range(25):
        base = words(rng, rng.choice((30, 120, 400)))
        rows.append(" ".join(base))
        for _ in range(rng.randrange(5)):
            rows.append(" ".join(edited(rng, base, rng.choice((0, 1, len(base) // 60, len(base) // 4)))))
    hot = words(rng, 300)
    rows += [" ".join(edited(rng, hot, 3)) for _ in range(60)] + [" ".join(hot)] * 40
    chain = words(rng, 400)
    for _ in range(8):  # neighbours alike, ends not
        rows.append(" ".join(chain))
        chain = edited(rng, chain, 6)
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def test_classes_equal_brute_force(spark, docs):
    rows = sample()
    got = {r.doc_id: r for r in neardup.near_duplicates(docs(rows)).collect()}
    want = brute_classes(rows)
    assert [got[d].class_id for d, _ in rows] == want
    for d, _ in rows:
        assert got[d].class_size == want.count(got[d].class_id)


def test_deduplicate_keeps_one_row_of_each_class(spark, docs):
    rows = sample(2)
    want = set(brute_classes(rows))
    rows += [(None, None), (900, ""), (901, "!!"), (902, "one two"), (903, "One, two!"), (904, "solo"), (904, "solo")]
    out = neardup.deduplicate(docs(rows))
    assert out.columns == docs(rows).columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None and i < 900) == sorted(want)
    assert sorted(i for i in ids if i is not None and i >= 900) == [900, 901, 902, 904] and ids.count(None) == 1


def test_near_duplicate_cases(spark, docs):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (4, None), (5, ""), (5, ""), (6, "A B  c,d e\nf")]
    got = sorted(((r.doc_id, r.class_id, r.class_size, r.links) for r in neardup.near_duplicates(docs(rows)).collect()), key=str)
    assert got == sorted([(None, 3, 3, 1), (3, 3, 3, 1), (4, 4, 1, 0), (5, 5, 1, 0), (5, 5, 1, 0), (6, 3, 3, 1)], key=str)
    assert neardup.near_duplicates(docs([])).count() == 0


def test_pairs_inside_a_family_that_shares_a_passage(spark, docs):
    """Texts of pairwise similarity 0.75 fill one another's keys; the planted pairs of 0.81 among them are all linked."""
    rng = random.Random(11)
    shared = words(rng, 103)
    rows, pairs = [], 80
    for i in range(700):
        own = words(rng, 17, 10**6)
        rows.append((2 * i, " ".join(shared + own)))
        if i < pairs:
            rows.append((2 * i + 1, " ".join(shared + own[:5] + words(rng, 12, 10**6))))
    got = {r.doc_id: (r.class_id, r.class_size) for r in neardup.near_duplicates(docs(rows)).collect()}
    assert got == {d: (d - d % 2, 2 if d // 2 < pairs else 1) for d, _ in rows}


def family(n, pairs, seed=11):
    """Texts of pairwise similarity 0.75; the first ``pairs`` ones have a partner of 0.81."""
    rng = random.Random(seed)
    shared, rows = words(rng, 103), []
    for i in range(n):
        own = words(rng, 17, 10**6)
        rows.append((2 * i, " ".join(shared + own)))
        if i < pairs:
            rows.append((2 * i + 1, " ".join(shared + own[:5] + words(rng, 12, 10**6))))
    return rows


def test_family_in_many_tiles(spark, docs, monkeypatch):
    monkeypatch.setattr(neardup, "TILE_ROWS", 60)
    rows = family(300, 40)
    got = {r.doc_id: (r.class_id, r.class_size, r.links) for r in neardup.near_duplicates(docs(rows)).collect()}
    assert got == {d: (d - d % 2, 2, 1) if d // 2 < 40 else (d, 1, 0) for d, _ in rows}


def test_rows_written_grow_with_the_texts_of_a_family(spark, docs, monkeypatch):
    """No table of pairs: a family of four times the texts writes four times the rows, at most a little more."""
    written = {}
    for n in (150, 600):
        counts = []

        def counted(df, save=neardup.saved):
            out = save(df)
            counts.append(out.count())
            return out

        with monkeypatch.context() as m:
            m.setattr(neardup, "saved", counted)
            assert neardup.near_duplicates(docs(family(n, 0))).where("class_size > 1").count() == 0
        written[n] = max(counts), sum(counts)
    assert all(b <= 5 * a for a, b in zip(written[150], written[600])), written


def test_open_pairs_are_each_given_once(spark):
    """Over all keys and tiles: the pairs that share a key, agree and differ in class, each in one tile."""
    rng = np.random.default_rng(3)
    n, base = 90, rng.integers(0, 256, neardup.REGISTERS)
    sig = np.where(rng.random((n, neardup.REGISTERS)) < 0.8, base, rng.integers(0, 256, (n, neardup.REGISTERS))).astype(np.uint8)
    keys = np.stack([1000 * k + rng.integers(0, 3, n) for k in range(5)], 1)
    root, own, got = rng.integers(0, 40, n), rng.integers(0, 3, n), []
    for key in np.unique(keys):
        for i in range(3):
            for j in range(i, 3):
                at = np.flatnonzero((keys == key).any(1) & ((own == i) | (own == j)))
                if len(at):
                    for x, y in neardup.open_pairs((key, i, j), own[at], root[at], sig[at], keys[at]):
                        got += zip(at[x].tolist(), at[y].tolist())
    want = [(x, y) for x in range(n) for y in range(x + 1, n)
            if root[x] != root[y] and (keys[x] == keys[y]).any() and (sig[x] == sig[y]).sum() >= neardup.AGREE]
    assert len(want) > 500 and sorted(got) == want


def test_bound_of_both_jaccard_values():
    rng = np.random.default_rng(8)
    for top in (1, 6):
        bags = [(np.sort(rng.choice(60, k, replace=False)), rng.integers(1, top + 1, k).astype(float)) for k in rng.integers(1, 50, 40)]
        for ids, w in bags[:10]:
            weight = np.zeros(60)
            weight[ids] = w
            bound = neardup.at_most(weight, np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags]), np.array([len(b[0]) for b in bags]))
            exact = np.array([max(neardup.jaccard(ids, w, *b)) for b in bags])
            assert (bound >= exact - 1e-12).all() and (top > 1 or np.abs(bound - exact).max() < 1e-12)


def test_signature_agreement_estimates_probability_jaccard():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 1 << 63, 600).astype(np.uint64)
    wa = rng.integers(1, 5, 400)
    wb = rng.integers(1, 5, 400)
    doc = np.repeat([0, 1], 400)
    sig = neardup.signatures(doc, np.concatenate((ids[:400], ids[200:])), np.concatenate((wa, wb)), 2, m=4096)
    oa, ob = np.argsort(ids[:400]), np.argsort(ids[200:])
    _, jp = neardup.jaccard(ids[:400][oa], wa[oa], ids[200:][ob], wb[ob])
    a, b = dict(zip(ids[:400].tolist(), wa)), dict(zip(ids[200:].tolist(), wb))
    direct = sum(1 / sum(max(a.get(y, 0) / a[x], b.get(y, 0) / b[x]) for y in set(a) | set(b)) for x in set(a) & set(b))
    assert abs(jp - direct) < 1e-9
    assert abs((sig[0] == sig[1]).mean() - jp) < 0.03


def test_shingle_hashes_follow_words():
    cache = {}
    t = [b"One two, THREE four five six", b"", b"one  two three four five", b"a b"]
    sh, n = bytewords.shingles(t, cache)
    assert n.tolist() == [2, 0, 1, 1] and sh[0] == sh[2] and len(set(sh.tolist())) == 3


def test_components_on_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, None)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "u int, v int")).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "u int, v int")).count() == 0


def leaks(seed=4):
    rng = random.Random(seed)
    items = [(i, " ".join(words(rng, rng.randint(15, 60), 5000)) + ". " + " ".join(words(rng, 6, 5000)) + ".") for i in range(30)]
    rows, truth = [], set()
    for d in range(200):
        ws = words(rng, rng.randint(5, 400), 5000)
        if d % 4 == 0:
            i = rng.randrange(30)
            item = items[i][1].split()
            if d % 8 == 0:  # a paraphrase: some words changed or left out
                item = [w if rng.random() > 0.1 else "zz%d" % rng.randrange(999) for w in item if rng.random() > 0.03]
            at = rng.randrange(len(ws) + 1)
            ws = ws[:at] + item + ws[at:]
            truth.add((d, i))
        rows.append((d, " ".join(ws).upper() if d % 12 == 0 else " ".join(ws)))
    return rows, items, truth


def test_decontamination_finds_copies_and_paraphrases(spark, docs):
    rows, items, truth = leaks()
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(rows), b).collect()}
    assert got == truth
    left = {r.doc_id for r in decontam.decontaminate(docs(rows), b).collect()}
    assert left == {d for d, _ in rows} - {d for d, _ in truth}


def test_latent_space_comes_from_all_passages(spark):
    """Word vectors against two plain passes over every half-passage, of more texts than a sample would hold."""
    from tallyspark.llm import bytewords

    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, n).clip(max=900)) for n in rng.integers(1, 520, 2800)]
    frame = lambda t: spark.createDataFrame([(x,) for x in t], "text string")
    idf, table = decontam.latent_space(frame(texts[:-3]).repartition(5), frame(texts[-3:]), seed=7)
    halves = []
    for t in texts:
        f = (bytewords.words([t.encode()], {})[0] % np.uint64(decontam.FEATURES)).astype(int)
        halves += [f[k : k + 16] for k in range(0, len(f), 16)]
    assert len(halves) > 45_000
    used = np.unique(np.concatenate(halves))  # all other rows of the matrix are zero
    place = np.zeros(decontam.FEATURES, int)
    place[used] = np.arange(len(used))
    count = np.zeros((len(halves), len(used)))
    for i, f in enumerate(halves):
        np.add.at(count[i], place[f], 1)
    want_idf = np.log((len(halves) + 1) / ((count > 0).sum(0) + 1)) + 0.1
    assert idf[used] == pytest.approx(want_idf, rel=1e-5)
    # half-passages as the operator weighs them: a word's vector once per occurrence, over the sum of squared weights
    size = (count * want_idf**2).sum(1)
    m = want_idf[:, None] * (count.T @ (count / size[:, None])) * want_idf[None, :]
    omega = np.random.default_rng(7).standard_normal((decontam.FEATURES, decontam.DIMENSIONS))[used]
    basis = np.linalg.qr(m @ omega)[0]
    folded = want_idf[:, None] * basis
    want = folded @ np.linalg.inv(basis.T @ m @ basis) @ folded.T  # the words' inner products: free of signs and turns
    got = table[used].astype(float) @ table[used].T.astype(float)
    assert np.abs(got - want).max() < 1e-3 * np.abs(want).max()


def test_cosine_candidates_recall(spark, docs):
    """The latent space against brute force: every true (document, item) reaches the cosine limit (recall 0.9 asked)."""
    rows, items, truth = leaks(9)
    b = spark.createDataFrame(items, "item_id long, text string")
    loose = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(rows), b, cosine=-1.0).collect()}
    index = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(rows), b).collect()}
    assert loose >= index and len(loose & truth) >= 0.9 * len(truth) and len(index) >= 0.9 * len(loose)


def spread(seed=6):
    """Items whose words are changed in part and set apart by inserted words."""
    rng = random.Random(seed)
    items = [(i, " ".join(words(rng, (22, 40)[i % 2] - 6, 5000)) + ". " + " ".join(words(rng, 6, 5000)) + ".") for i in range(24)]
    rows = []
    for d in range(240):
        item, out = items[d % 24][1].split(), []
        step, changed = ((2, 0.15), (1, 0.1), (3, 0.2))[d % 3]
        for k, w in enumerate(item):
            out.append(w if rng.random() > changed else "zz%d" % rng.randrange(10**6))
            if k % step == step - 1:
                out.append("ff%d" % rng.randrange(10**6))
        rows.append((d, " ".join(words(rng, rng.randrange(120), 5000) + out + words(rng, rng.randrange(120), 5000))))
    return rows, items


def test_decontamination_of_items_spread_by_inserted_words(spark, docs):
    """Against the order test on every passage, with neither cosine nor word count."""
    rows, items = spread()
    truth = set()
    for i, t in items:
        item, last = re.findall("[a-z0-9]+", t), re.findall("[a-z0-9]+", t.split(". ")[1])
        for d, text in rows:
            ws = re.findall("[a-z0-9]+", text)
            for start in range(0, len(ws), 16):
                near = ws[max(0, start - len(item)) : start + 32 + len(item)]
                if decontam.common_subsequence(item, near) / len(item) >= 0.75 and decontam.common_subsequence(last, near) >= 0.5 * len(last):
                    truth.add((d, i))
    b = spark.createDataFrame(items, "item_id long, text string")
    every = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(rows), b, cosine=-1.0).collect()}
    index = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(rows), b).collect()}
    print("recall", len(truth), len(every & truth), len(index & truth))
    assert len(truth) > 150 and every == truth
    assert index <= truth and len(index) >= 0.9 * len(truth)


def test_decontamination_cases(spark, docs):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta. iota kappa."), (2, None), (3, "!!"), (None, "")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, "alpha beta gamma delta epsilon zeta eta theta. iota kappa."), (3, "alpha beta gamma delta epsilon zeta eta theta. iota kappa."), (None, "plain words only"), (4, "pad " * 40000 + "alpha beta gamma delta epsilon zeta eta theta iota kappa")]
    got = sorted((r.doc_id, r.item_id) for r in decontam.contaminated(docs(rows), items).collect())
    assert got == [(3, 1), (3, 1), (4, 1)]
    assert decontam.decontaminate(docs(rows), items).count() == 3
    assert decontam.contaminated(docs(rows), items.limit(0)).count() == 0
    assert decontam.contaminated(docs([]), items).count() == 0


def test_common_subsequence():
    rng = random.Random(0)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randint(1, 12))]
        b = [rng.randrange(6) for _ in range(rng.randint(0, 15))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontam.common_subsequence(a, b) == t[-1][-1]
