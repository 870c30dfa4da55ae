"""op11: the trie against plain Python, over many small blocks and rounds, and the odd cases."""

import hashlib
import math
import random
import zlib

from pyspark.sql import functions as F

from tallyspark.llm import convtrie
from tallyspark.llm.common import crc_mod

SCHEMA = "conv_id long, turn long, role string, text string, seq string, path string, turns int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def plain_trie(seqs):
    nodes, kids, leaves, saved = {}, {}, {}, {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    out = set()
    for k in sorted(nodes, key=len, reverse=True):
        ch = kids.get(k, [])
        leaves[k] = sum(leaves[x] for x in ch) if ch else 1
        saved[k] = sum(saved[x] for x in ch) + ((len(nodes[k]) - 1) * len(k[-1][1]) if k else 0)
        ends = ",".join(str(c) for c in sorted(nodes[k]) if len(seqs[c]) == len(k))
        out.add((min(nodes[k]), len(k), min(nodes[k[:-1]]) if k else None, len(nodes[k]), len(ch), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def own_turns(rows):
    by = {}
    for c, t, r, x in rows:
        if c is not None:
            by.setdefault(c, []).append((t is not None, t or 0, hashlib.sha256(f"{len(r or '')}:{r or ''}{x or ''}".encode()).digest()[:16], r or "", x or ""))
    return {c: tuple(a[3:] for a in sorted(v)) for c, v in by.items()}


def rebuilt(rows):
    own = own_turns(rows)
    out = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), ())[:h] + s[h:]
    return out


def query(spark, rows):
    c = F.col("conv_id")
    return convtrie.with_shared_heads(convtrie.turn_lists(table(spark, rows)), c - c % 100, crc_mod("conv_id", 6), 5)


def test_many_blocks_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "BLOCK", 8)
    monkeypatch.setattr(convtrie, "PIECE", 3)
    rng = random.Random(5)
    rows = []
    for c in range(-30, 420):
        n = rng.choice([1, 2, 3, 3, 5, 9, 40 if c % 50 == 7 else 4])
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bß", "", None, "日本" * 3])) for t in range(n)]
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1150) for t in range(4)]   # a third are copies
    rng.shuffle(rows)
    got = {tuple(r) for r in convtrie.trie_report(query(spark, rows)).collect()}
    assert got == plain_trie(rebuilt(rows))
    as_they_are = {tuple(r) for r in convtrie.trie_report(convtrie.turn_lists(table(spark, rows))).collect()}
    assert as_they_are == plain_trie(own_turns(rows))


def test_blocks_of_long_conversations_shrink(spark, monkeypatch):
    """Every path is longer than a block's turns: rounds still end."""
    monkeypatch.setattr(convtrie, "BLOCK", 16)
    monkeypatch.setattr(convtrie, "BLOCK_TURNS", 2)
    rows = [(c, t, "user", f"{t if t < c % 7 else (c, t)}") for c in range(90) for t in range(12)]
    got = {tuple(r) for r in convtrie.trie_report(convtrie.turn_lists(table(spark, rows))).collect()}
    assert got == plain_trie(own_turns(rows))


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, "user", "tie"), (1, 0, "user", "tie"),
            (2, 5, "user", "x" * 100_000), (3, 1, "", ""), (200, 1, "user", "head"), (201, 1, "user", "own")]
    got = [tuple(r) for r in convtrie.trie_report(query(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_trie(rebuilt(rows))


def test_only_turnless_conversations(spark):
    # conversations whose few turns all fall to an absent head: only the root is left
    ids = [c for c in range(101, 160) if zlib.crc32(str(c).encode()) % 6 >= 1][:6]
    rows = [(c, 0, "user", f"t{c}") for c in ids]
    assert {tuple(r) for r in convtrie.trie_report(query(spark, rows)).collect()} == {(min(ids), 0, None, 6, 0, 1, 0, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())}


def test_no_conversations(spark):
    assert convtrie.trie_report(query(spark, [(None, 1, "user", "x")])).collect() == []


def test_open_children_are_spread(spark):
    """The children of one open node meet its id under many salts, not in one task."""
    n = spark.range(1000).select(F.col("id").alias("conv_id"), *[F.lit(1).cast("long").alias(c) for c in ("depth", "n_convs", "n_children", "n_leaves", "saved_tokens")],
                                 F.lit(None).cast("binary").alias("seq"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(b"k").alias("waits_for"), F.lit(None).cast("binary").alias("own_key"))
    root = n.where("conv_id = 0").withColumn("depth", F.lit(0).cast("long")).withColumn("waits_for", F.lit(None).cast("binary")).withColumn("own_key", F.lit(b"k"))
    out = convtrie._with_parents(n.unionAll(root))
    assert out.count() == 1001 and out.where("parent_conv_id = 0").count() == 1000
