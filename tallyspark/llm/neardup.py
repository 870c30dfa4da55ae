"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is the weighted set of its five-word shingles (weight: how often it
holds one).  Every shingle is a Poisson process of that rate whose arrivals are
dealt over the registers; a register keeps the shingle that arrives first, and
a document stops as soon as no later arrival can win.  Two registers agree with
the probability Jaccard of the documents.

Banding: keys over groups of 4, 12 and 32 registers.  All texts of a key are
first compared with its first and its last text (by text digest).  Where the
texts between them belong to more than one class, every two of different classes
are compared inside a task, which holds a tile of the key: all its texts, or two
blocks of them where they are many.  A pair belongs to the first key its texts
share, so it is compared once; only pairs that agree in AGREE registers are
compared on their texts, and a tile puts out its texts or its links, never its
pairs.  Every link is verified on the whole texts, and verified links make the
classes.

Texts that are equal byte for byte are one node from the start, however many
rows hold it.

Cases: a null or empty text, or one without any word, is in a class of its own
row (nothing to compare); texts of one to four words are one shingle; repeated
rows join the class of their text; a null doc_id counts as a row and never
names a class unless the class has no other id; an empty table gives an empty
result; extra columns are ignored; very long texts are compared whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm import bytewords
from tallyspark.llm.common import portions, saved, worker_cache
from tallyspark.llm.components import components

U = np.uint64
SIMILARITY = 0.8
REGISTERS = 96
#: registers per key and number of keys of each kind
BANDS = ((4, 24), (12, 8), (32, 3))
#: registers that a pair of probability Jaccard 0.8 has in common but for a chance of 4e-7 (binomial)
AGREE = 56
#: texts of a key, and bytes of text, that a block of a tile holds at most (about, as blocks are dealt by hash)
TILE_ROWS, TILE_BYTES = 4096, 4_000_000


def signatures(doc: np.ndarray, ids: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers (n x m shingle ids) of n documents given as (document, shingle, weight) rows."""
    best = np.full(n * m, np.inf)
    who = np.zeros(n * m, np.uint64)
    d, x, w = doc.astype(np.int64), bytewords.mix(ids), weight.astype(np.float64)
    t = np.zeros(len(d))
    r = 0
    while len(d):
        r += 1
        z = bytewords.mix(x + U((r * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        t = t - np.log(((z >> U(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))) / w
        cell = d * m + (bytewords.mix(z) % U(m)).astype(np.int64)
        win = np.flatnonzero(t < best[cell])
        cw, tw = cell[win], t[win]
        np.minimum.at(best, cw, tw)
        first = tw == best[cw]
        who[cw[first]] = x[win[first]]
        limit = best.reshape(n, m).max(axis=1)
        go = t < limit[d]  # early termination: a later arrival can only be worse
        d, x, w, t = d[go], x[go], w[go], t[go]
    return who.reshape(n, m)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """All banding keys (64 bit) of each signature."""
    out, kind = [], 0
    for rows, count in BANDS:
        for b in range(count):
            h = np.full(len(sig), (kind + 1) * 0x51AFD7ED558CCD & 0xFFFFFFFFFFFFFFFF, np.uint64)
            for j in range(rows):
                h = bytewords.mix(h ^ sig[:, (b * rows + j) % sig.shape[1]]) + U(j)
            out.append(h)
            kind += 1
    return np.stack(out, 1)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, node, keys, sig, size): text digest, banding keys, a byte of each register and bytes of every row that has a word; other rows have a null node."""

    def run(batches):
        cache = worker_cache("bytewords")
        for b in batches:
            texts = [t or b"" for t in b.column(1).to_pylist()]
            for s, e in portions(texts):
                part = texts[s:e]
                doc, sh, w = bytewords.bag(part, cache)
                has = np.unique(doc)
                back = np.searchsorted(has, doc)
                regs = signatures(back, sh, w, len(has))
                keys = band_keys(regs).view(np.int64)
                node: list = [None] * len(part)
                rows: list = [None] * len(part)
                sig: list = [None] * len(part)
                for i, k, r in zip(has.tolist(), keys, regs.astype(np.uint8)):
                    node[i], rows[i], sig[i] = hashlib.md5(part[i]).digest(), k, r.tobytes()
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s, e - s), pa.array(node, pa.binary()), pa.array(rows, pa.list_(pa.int64())), pa.array(sig, pa.binary()), pa.array([len(t) for t in part], pa.int64())], ["doc_id", "node", "keys", "sig", "size"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, node binary, keys array<long>, sig binary, size long")


def _pairs(j: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of (node, other) rows."""
    return j.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def shared_keys(one: DataFrame) -> DataFrame:
    """(key, node, lo, hi, n) of every node (``one``: node, keys) in each of its keys that other nodes have too."""
    of_key = Window.partitionBy("key")
    rows = one.select("node", F.explode("keys").alias("key"))
    return rows.select("key", "node", F.min("node").over(of_key).alias("lo"), F.max("node").over(of_key).alias("hi"), F.count("*").over(of_key).alias("n")).where("lo < hi")


def candidates(shared: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of nodes to verify: every member of a key with the key's first and last node."""
    return _pairs(shared.select("node", F.explode(F.array("lo", "hi")).alias("other")).where("node <> other"))


def mixed(shared: DataFrame, info: DataFrame) -> DataFrame:
    """(key, node, n, bytes) of the members between the first and last node of their key, where they (``info``: node, root, size) are in several classes."""
    of_key = Window.partitionBy("key")
    rooted = shared.where("n > 3 and node <> lo and node <> hi").select("key", "node").join(info.select("node", "root", "size"), "node")
    return rooted.select("key", "node", F.min("root").over(of_key).alias("r0"), F.max("root").over(of_key).alias("r1"),
                         F.count("*").over(of_key).alias("n"), F.sum("size").over(of_key).alias("bytes")).where("r0 < r1").drop("r0", "r1")


def tiles(members: DataFrame, rows: int | None = None, size: int | None = None) -> DataFrame:
    """(key, i, j, own, node): ``members`` (key, node, n, bytes) dealt over blocks, each block (own) to its tile with every block."""
    blocks = F.greatest(F.ceil(F.col("n") / (rows or TILE_ROWS)), F.ceil(F.col("bytes") / (size or TILE_BYTES)), F.lit(1)).cast("int")
    dealt = members.select("key", "node", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    return dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node")


def open_pairs(tile: tuple, own: np.ndarray, root: np.ndarray, sig: np.ndarray, keys: np.ndarray, least: int = AGREE):
    """(x, y) arrays of a tile's pairs to compare on their texts, for some rows x at a time (ascending).

    ``tile`` is (key, i, j).  A pair's classes differ, its signatures have ``least`` bytes in common, its
    blocks are the tile's two, and no key before the tile's is common to it.
    """
    n, (key, i, j) = len(own), tile
    at = int(np.argmax(keys[0] == key))
    registers = np.ascontiguousarray(sig.T)
    step = max(1, 1_000_000 // n)
    for s in range(0, n, step):
        e = min(n, s + step)
        go = (root[s:e, None] != root[None, s:]) & (np.arange(s, e)[:, None] < np.arange(s, n)[None, :])
        if i != j:
            go &= own[s:e, None] != own[None, s:]
        if not go.any():
            continue
        if go.size < 500:
            same = (sig[s:e, None, :] == sig[None, s:, :]).sum(2)
        else:
            same = np.zeros(go.shape, np.uint8)
            for r in registers:
                same += r[s:e, None] == r[None, s:]
        x, y = np.nonzero(go & (same >= least))
        x, y = x + s, y + s
        for k in range(at):
            new = keys[x, k] != keys[y, k]
            x, y = x[new], y[new]
        if len(x):
            yield x, y


def _tile_columns(t: pa.Table) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Table]:
    """(nodes, own, root number, sig, keys, table) of a tile's members in order of their nodes."""
    t = t.take(pa.array(np.argsort(np.array(t.column("node").to_pylist(), object)))).combine_chunks()
    own = t.column("own").to_numpy()
    root = t.column("root").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(-1, REGISTERS)
    keys = np.array(t.column("keys").to_pylist(), np.int64)
    return t.column("node").to_pylist(), own, root, sig, keys, t


def active(tiled: DataFrame) -> DataFrame:
    """(key, i, j, own, node) of the members that have a pair to compare in their tile."""

    def run(tile, t):
        _, own, root, sig, keys, t = _tile_columns(t)
        used = np.zeros(len(own), bool)
        for x, y in open_pairs(tuple(v.as_py() for v in tile), own, root, sig, keys):
            used[x] = used[y] = True
        return t.select(["key", "i", "j", "own", "node"]).filter(pa.array(used))

    return tiled.groupBy("key", "i", "j").applyInArrow(run, "key long, i int, j int, own int, node binary")


def at_most(weight: np.ndarray, ids: np.ndarray, w: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Upper bounds of both Jaccard values of one text with others; the exact value where all weights are 1.

    ``weight`` holds the text's weight of every shingle number; the others' (shingle number, weight) rows lie one
    after the other, ``sizes`` each.  As in ``jaccard``, but the maxima's sum over the common shingles is taken as
    the larger of the two sums.
    """
    start = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    a = weight[ids]
    common = a > 0
    n = np.add.reduceat(common.astype(np.int64), start)
    sum_a, sum_b = np.add.reduceat(a, start), np.add.reduceat(np.where(common, w, 0.0), start)
    plain = n / (np.count_nonzero(weight) + sizes - n)
    a, b, of = a[common], w[common], np.repeat(np.arange(len(sizes)), n)
    total = (weight.sum() - sum_a)[of] / a + (np.add.reduceat(w, start) - sum_b)[of] / b + np.maximum(sum_a[of] / a, sum_b[of] / b)
    return np.maximum(plain, np.bincount(of, 1.0 / total, len(sizes)))


def tile_links(texts: list[bytes], root: np.ndarray, pairs, similarity: float, cache: dict) -> list[tuple[int, int]]:
    """Verified pairs among ``pairs`` (as from ``open_pairs``), but those whose classes (``root``) earlier ones have joined."""
    doc, sh, w = bytewords.bag(texts, cache)
    order = np.lexsort((sh, doc))
    sh, w = sh[order], w[order].astype(float)
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    distinct, number = np.unique(sh, return_inverse=True)
    sizes, weight = np.diff(cut), np.zeros(len(distinct))
    root, links = root.copy(), []
    for x, y in pairs:
        for i in np.unique(x):
            js = y[np.searchsorted(x, i, "left") : np.searchsorted(x, i, "right")]
            js = js[root[js] != root[i]]
            if not len(js):
                continue
            own = slice(cut[i], cut[i + 1])
            weight[number[own]] = w[own]
            ends = np.cumsum(sizes[js])
            rows = np.arange(ends[-1]) + np.repeat(cut[js] - ends + sizes[js], sizes[js])
            near = at_most(weight, number[rows], w[rows], sizes[js]) >= similarity - 1e-9
            weight[number[own]] = 0.0
            for j in js[near]:
                other = slice(cut[j], cut[j + 1])
                if root[i] != root[j] and max(jaccard(sh[own], w[own], sh[other], w[other])) >= similarity - 1e-12:
                    links.append((int(i), int(j)))
                    root[root == root[j]] = root[i]
    return links


def linked(tiled: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) that join the classes inside each tile of ``tiled`` (with text); pairs of a tile never leave its task."""

    def run(tile, t):
        nodes, own, root, sig, keys, t = _tile_columns(t)
        pairs = open_pairs(tuple(v.as_py() for v in tile), own, root, sig, keys)
        links = tile_links(t.column("text").to_pylist(), root, pairs, similarity, worker_cache("bytewords"))
        return pa.table({c: pa.array([nodes[p[k]] for p in links], pa.binary()) for k, c in enumerate("ab")})

    return tiled.groupBy("key", "i", "j").applyInArrow(run, "a binary, b binary")


def jaccard(a_ids: np.ndarray, a_w: np.ndarray, b_ids: np.ndarray, b_w: np.ndarray) -> tuple[float, float]:
    """(Jaccard of the shingle sets, probability Jaccard of the weighted shingles); ids sorted and distinct."""
    both, ia, ib = np.intersect1d(a_ids, b_ids, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0, 0.0
    plain = len(both) / (len(a_ids) + len(b_ids) - len(both))
    a, b = a_w[ia].astype(float), b_w[ib].astype(float)
    only_a, only_b = a_w.sum() - a.sum(), b_w.sum() - b.sum()
    # for x: sum over y of max(a_y / a_x, b_y / b_x); which side is larger follows the order of b_y / a_y
    ratio = b / a
    order = np.argsort(ratio)
    ca = np.concatenate(([0.0], np.cumsum(a[order])))
    cb = np.concatenate(([0.0], np.cumsum(b[order])))
    k = np.searchsorted(ratio[order], ratio, "right")
    total = (ca[k] + only_a) / a + (cb[-1] - cb[k] + only_b) / b
    return plain, float((1.0 / total).sum())


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (a, b) whose whole texts are at least ``similarity`` alike by probability Jaccard or plain Jaccard."""

    def run(batches):
        cache, kept = worker_cache("bytewords"), {}
        for bt in batches:
            a, b = bt.column(0).to_pylist(), bt.column(1).to_pylist()
            ta, tb = bt.column(2), bt.column(3)
            ok = []
            for i in range(len(a)):
                sides = []
                for key, col in ((a[i], ta), (b[i], tb)):
                    if key not in kept:
                        if len(kept) > 500:
                            kept.clear()
                        _, sh, w = bytewords.bag([col[i].as_py() or b""], cache)
                        o = np.argsort(sh)
                        kept[key] = (sh[o], w[o])
                    sides.append(kept[key])
                if max(jaccard(*sides[0], *sides[1])) >= similarity - 1e-12:
                    ok.append(i)
            take = pa.array(ok, pa.int64())
            yield pa.RecordBatch.from_arrays([bt.column(0).take(take), bt.column(1).take(take)], ["a", "b"])

    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    return with_b.select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def _classes(docs: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """(node, first, class_id, class_node, class_size, links) of every text digest in ``rows``."""
    some = rows.where("node is not null")
    # equal texts have equal keys, signatures and sizes: any of a node's rows has them
    one = saved(some.groupBy("node").agg(F.min(_id()).alias("first"), F.count("*").alias("copies"), F.first("keys").alias("keys"), F.first("sig").alias("sig"), F.first("size").alias("size")))
    nodes = one.select("node", "first", "copies")
    whole = docs.select(_id().alias("first"), F.col("text").cast("binary").alias("text")).withColumn("node", F.unhex(F.md5("text")))

    def texts(wanted: DataFrame) -> DataFrame:
        """(node, text) of the nodes in ``wanted``."""
        return whole.join(nodes.select("node", "first").join(wanted.distinct(), "node"), ["first", "node"]).dropDuplicates(["first", "node"]).select("node", "text")

    shared = saved(shared_keys(one))
    pairs = saved(candidates(shared))
    links = saved(verified(pairs, texts(pairs.select(F.explode(F.array("a", "b")).alias("node"))), similarity))
    comp = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    info = one.select("node", "keys", "sig", "size").join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
    left = saved(mixed(shared, info))
    if not left.isEmpty():
        members = info.select("node", "root", "sig", "keys")
        found = saved(active(tiles(left).join(members, "node")))
        if not found.isEmpty():
            more = saved(linked(found.join(members, "node").join(texts(found.select("node")), "node"), similarity))
            if not more.isEmpty():
                links = links.unionByName(more)
                comp = components(comp.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(more.select("a", "b")))
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    info = nodes.join(comp, "node", "left").join(degree, "node", "left")
    info = info.select("node", "first", "copies", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    classes = info.groupBy("root").agg(F.min(F.struct("first", "node")).alias("f"), F.sum("copies").alias("class_size"))
    return info.join(classes, "root").select("node", "first", F.col("f.first").alias("class_id"), F.col("f.node").alias("class_node"), "class_size", "links")


def _id():
    """doc_id as a key: a null one sorts last."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its class), class_size, links (verified other texts)."""
    rows = saved(fingerprints(docs))
    classes = _classes(docs, rows, similarity)
    joined = rows.where("node is not null").select("doc_id", "node").join(classes, "node").select(
        "doc_id", F.nullif("class_id", F.lit((1 << 63) - 1)).alias("class_id"), "class_size", "links")
    alone = rows.where("node is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("links"))
    return joined.unionByName(alone)


def deduplicate(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class left: the one of least doc_id.  Rows without words all stay."""
    rows = saved(fingerprints(docs))
    classes = _classes(docs, rows, similarity)
    kept = classes.where("node = class_node").select(F.col("first").alias("__first"), F.col("node").alias("__node"))
    marked = docs.withColumn("__first", _id()).withColumn("__node", F.unhex(F.md5(F.col("text").cast("binary"))))
    one = marked.join(kept, ["__first", "__node"]).dropDuplicates(["__first", "__node"]).select(*docs.columns)
    empty = marked.where(~F.coalesce(F.col("text"), F.lit("")).rlike("[0-9A-Za-z\\x{80}-\\x{10FFFF}]")).select(*docs.columns)
    return one.unionByName(empty)
