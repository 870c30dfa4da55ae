"""Prefix trie of conversations by union-find over sorted-neighbour LCP edges.

A conversation is the sequence of its turns; a turn is the 128-bit digest of its
role and text, so a conversation is one binary path and sorting the paths puts
conversations with a common beginning next to each other.  The distinct paths are
range-partitioned and cut into blocks; in a block the edges between neighbours,
weighted by their longest common prefix (LCP), are merged in descending order by
union-find: a merge at depth d creates (or widens) the branching node of depth d,
and the nodes a component passes on its way up are its unary chain.  What lies on a
block's first or last path may go on in the next block, so such nodes stay open:
a block contracts to its two outer paths with what is already known of their open
nodes, and the contracted blocks are merged by the same function, round by round,
until one is left.  Children whose parent was still open get its id by a join.

Cases: rows without conv_id take no part; null turns come first, rows of one
conversation with equal turns are ordered by the digest of (role, text); null role or text is the empty text;
repeated rows are turns of their own; a conversation without turns belongs to the
root only; no conversations: no nodes; other columns are ignored.  One
conversation's digests (16 bytes a turn) are one row; texts are never gathered.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import saved

#: bytes of a turn in a path
WIDTH = 16
#: paths of a block, and turns after which a block is closed early
BLOCK, BLOCK_TURNS = 1024, 400_000
#: copies of an open node's id for the join with its children
SALTS = 64
#: conversation ids of one piece of a list that is hashed
PIECE = 4096

NODE_SCHEMA = "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, seq binary, parent_conv_id long, waits_for binary, own_key binary"
_SPINE = "array<struct<depth:int,n:long,m:long,kids:long,leaves:long,saved:long,seq:binary>>"
ITEM_SCHEMA = f"first binary, first_chars array<long>, head {_SPINE}, last binary, last_chars array<long>, tail {_SPINE}"
_PA_SPINE = pa.list_(pa.struct([("depth", pa.int32()), ("n", pa.int64()), ("m", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("seq", pa.binary())]))
_PA_NODE = pa.schema([(c, pa.int64()) for c in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [("seq", pa.binary()), ("parent_conv_id", pa.int64()), ("waits_for", pa.binary()), ("own_key", pa.binary())])
_PA_ITEM = pa.schema([("first", pa.binary()), ("first_chars", pa.list_(pa.int64())), ("head", _PA_SPINE), ("last", pa.binary()), ("last_chars", pa.list_(pa.int64())), ("tail", _PA_SPINE)])


class Trie(NamedTuple):
    """``nodes``: one row per node, ``seq`` naming the sequence that ends there (null: none); ``ends``: (seq, conv_id)."""

    nodes: DataFrame
    ends: DataFrame


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order as structs of digest ``d`` and code points ``n``."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    d = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH))
    one = F.struct(F.col("turn").cast("long").alias("turn"), d.alias("d"), F.length(text).cast("long").alias("n"))
    return (conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
            .select("conv_id", F.transform("ts", lambda t: F.struct(t["d"].alias("d"), t["n"].alias("n"))).alias("turns")))


def with_shared_heads(lists: DataFrame, source: Column, taken: Column, most: int) -> DataFrame:
    """Rebuild each conversation: the first ``taken`` (at most ``most``) turns of conversation ``source``, then its own after as many."""
    lists = saved(lists)
    heads = lists.select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, most).alias("head"))
    own = lists.select("conv_id", "turns", source.alias("source"), taken.cast("int").alias("taken"))
    heads = heads.join(own.select(F.col("source").alias("head_id")).distinct(), "head_id", "left_semi")
    j = own.join(heads, own["source"] == heads["head_id"], "left")
    empty = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce(F.col("head"), empty), F.lit(1), F.col("taken"))
    rest = F.slice(F.col("turns"), F.col("taken") + 1, F.greatest(F.size("turns"), F.lit(0)))
    return j.select("conv_id", F.concat(head, rest).alias("turns"))


def _lcp(a: bytes, b: bytes) -> int:
    """Turns that both paths begin with."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * WIDTH : mid * WIDTH] == b[low * WIDTH : mid * WIDTH]:
            low = mid
        else:
            high = mid - 1
    return low


def _key(path: bytes, depth: int) -> bytes:
    """Name of the node that ``path`` passes at ``depth``."""
    return hashlib.sha256(path[: depth * WIDTH]).digest()


class _Open:
    """A node being gathered: closed members and children so far, and the children's rows that wait for its id."""

    __slots__ = ("n", "m", "kids", "leaves", "saved", "seq", "waited", "rows")

    def __init__(self, n=0, m=None, kids=0, leaves=0, saved=0, seq=None, waited=False):
        self.n, self.m, self.kids, self.leaves, self.saved, self.seq, self.waited, self.rows = n, m, kids, leaves, saved, seq, waited, []

    def add(self, o: "_Open") -> "_Open":
        self.n += o.n
        self.m = o.m if self.m is None else self.m if o.m is None else min(self.m, o.m)
        self.kids, self.leaves, self.saved = self.kids + o.kids, self.leaves + o.leaves, self.saved + o.saved
        self.seq, self.waited = self.seq or o.seq, self.waited or o.waited
        if len(o.rows) > len(self.rows):
            self.rows, o.rows = o.rows, self.rows
        self.rows.extend(o.rows)
        return self


def merge_block(paths: list[tuple[bytes, list[int], dict[int, _Open]]], whole: bool):
    """Node rows of a block of sorted distinct paths, and the contracted block (None if ``whole``).

    Each path comes with its turns' code points and what is known of its nodes by depth (the last one always).
    """
    count, out = len(paths), []
    up = list(range(count))
    low, high = list(range(count)), list(range(count))
    depth = [len(p) // WIDTH for p, _, _ in paths]
    known = [k for _, _, k in paths]
    node = [k.pop(d) for k, d in zip(known, depth)]
    outer: tuple[dict, dict] = ({}, {})

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def rise(c: int, to: int) -> None:
        """Close the nodes of component ``c`` from its depth up to ``to`` + 1 (open ones: set them aside)."""
        path, chars, _ = paths[low[c]]
        side = None if whole else 0 if low[c] == 0 else 1 if high[c] == count - 1 else None
        while depth[c] > to:
            d, here = depth[c], node[c]
            above = known[c].pop(d - 1, None) or _Open()
            if side is None:
                here.saved += (here.n - 1) * (chars[d - 1] if d else 0)
                if not here.kids:
                    here.leaves = 1
                for row in here.rows:
                    row[7] = here.m
                out.extend(here.rows)
                row = [here.m, d, here.n, here.kids, here.leaves, here.saved, here.seq, None, None, _key(path, d) if here.waited else None]
                if d == 0:
                    out.append(row)
                else:
                    above.add(_Open(here.n, here.m, 1, here.leaves, here.saved)).rows.append(row)
            else:
                if here.rows:
                    key = _key(path, d)
                    for row in here.rows:
                        row[8] = key
                    out.extend(here.rows)
                outer[side][d] = here
            depth[c], node[c] = d - 1, above

    edges = sorted((-_lcp(paths[i][0], paths[i + 1][0]), i) for i in range(count - 1))
    for d, i in edges:
        a, b = find(i), find(i + 1)
        rise(a, -d)
        rise(b, -d)
        if high[a] - low[a] < high[b] - low[b]:
            a, b = b, a
        up[b] = a
        node[a].add(node[b])
        low[a], high[a] = min(low[a], low[b]), max(high[a], high[b])
        for k, o in known[b].items():
            known[a][k] = known[a][k].add(o) if k in known[a] else o
        known[b] = {}
    rise(find(0), -1)
    if whole:
        return out, None
    spines = [[{"depth": d, "n": o.n, "m": o.m, "kids": o.kids, "leaves": o.leaves, "saved": o.saved, "seq": o.seq} for d, o in sorted(s.items())] for s in outer]
    last = paths[-1] if count > 1 else (None, None, None)
    return out, [paths[0][0], paths[0][1], spines[0], last[0], last[1], spines[1]]


def _spine(entries: list[dict] | None) -> dict[int, _Open]:
    return {e["depth"]: _Open(e["n"], e["m"], e["kids"], e["leaves"], e["saved"], e["seq"], True) for e in entries or []}


def _paths(batches, fresh: bool):
    """Paths with what is known of them, from rows of sequences (``fresh``) or of contracted blocks."""
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if fresh:
                path, chars, n, m, seq = r
                yield path, chars, {len(path) // WIDTH: _Open(n, m, seq=seq)}
            else:
                first, first_chars, head, last, last_chars, tail = r
                yield first, first_chars, _spine(head)
                if last is not None:
                    yield last, last_chars, _spine(tail)


def _merge(rows: DataFrame, fresh: bool, whole: bool) -> DataFrame:
    """One round over sorted rows: node rows and contracted blocks, told apart by ``first`` being null."""
    schema = pa.schema(list(_PA_NODE) + list(_PA_ITEM))

    def flush(block):
        nodes, item = merge_block(block, whole)
        for i in range(0, len(nodes), 20_000):
            part = nodes[i : i + 20_000]
            cols = [pa.array(c, f.type) for c, f in zip(zip(*part), _PA_NODE)]
            yield pa.RecordBatch.from_arrays(cols + [pa.nulls(len(part), f.type) for f in _PA_ITEM], schema=schema)
        if item:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in _PA_NODE] + [pa.array([v], f.type) for v, f in zip(item, _PA_ITEM)], schema=schema)

    def run(batches):
        block, turns = [], 0
        for p in _paths(batches, fresh):
            # at least four paths, so that blocks of the longest conversations become fewer from round to round too
            if not whole and (len(block) >= BLOCK or (turns >= BLOCK_TURNS and len(block) >= 4)):
                yield from flush(block)
                block, turns = [], 0
            block.append(p)
            turns += len(p[1])
        if block:
            yield from flush(block)

    return rows.mapInArrow(run, f"{NODE_SCHEMA}, {ITEM_SCHEMA}")


def prefix_trie(lists: DataFrame) -> Trie:
    """All nodes of the prefix trie of ``lists`` (conv_id, turns) as :func:`turn_lists` makes them."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["d"])), ""))
    chars = F.transform("turns", lambda t: t["n"])
    convs = saved(lists.select("conv_id", path.alias("path"), chars.alias("chars")).withColumn("seq", F.unhex(F.sha2("path", 256))))
    rows = (convs.groupBy("path").agg(F.first("chars").alias("chars"), F.count("*").alias("n"), F.min("conv_id").alias("m"), F.first("seq").alias("seq"))
            .repartitionByRange("path").sortWithinPartitions("path").select("path", "chars", "n", "m", "seq"))
    rounds, fresh, whole = [], True, False
    while True:
        made = saved(_merge(rows, fresh, whole))
        rounds.append(made.where("first is null").select(*_PA_NODE.names))
        if whole:
            break
        items = made.where("first is not null").select(*_PA_ITEM.names)
        left = items.count()
        fresh, whole = False, left <= BLOCK // 2
        parts = 1 if whole else left // (BLOCK // 4)
        rows = items.repartitionByRange(parts, "first").sortWithinPartitions("first")
    nodes = rounds[0]
    for r in rounds[1:]:
        nodes = nodes.unionAll(r)
    return Trie(_with_parents(nodes), convs.select("seq", "conv_id"))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Give the children of once open nodes their parent's id; the salt spreads the children of one parent."""
    keep = [c for c in _PA_NODE.names if c not in ("waits_for", "own_key", "parent_conv_id")]
    settled = nodes.where("waits_for is null").select(*keep, "parent_conv_id")
    waiting = nodes.where("waits_for is not null").select(*keep, "waits_for", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int").alias("salt"))
    parents = nodes.where("own_key is not null").select(F.col("own_key").alias("waits_for"), F.col("conv_id").alias("parent_conv_id"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return settled.unionAll(waiting.join(parents, ["waits_for", "salt"]).select(*keep, "parent_conv_id"))


def list_digests(ends: DataFrame) -> DataFrame:
    """(seq, sha256): lower-case SHA-256 of each sequence's conversation ids, ascending, joined by commas.

    Ids are first put together to pieces of ``PIECE`` over a range-partitioned sort, so a sequence that
    a third of all conversations share is spread; only its pieces then go through one hash, as SHA-256 must.
    """

    def pieces(batches):
        seq, first, ids = None, None, []
        out: list[tuple] = []

        def rows():
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.string())], ["seq", "first", "ids"])

        for b in batches:
            for s, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if s != seq or len(ids) == PIECE:
                    if ids:
                        out.append((seq, first, ",".join(ids)))
                    seq, first, ids = s, c, []
                    if len(out) >= 2000:
                        yield rows()
                        out.clear()
                ids.append(str(c))
        if ids:
            out.append((seq, first, ",".join(ids)))
        if out:
            yield rows()

    def digests(batches):
        seq, h = None, None
        for b in batches:
            got: tuple[list, list] = ([], [])
            for s, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if s != seq:
                    if h is not None:
                        got[0].append(seq)
                        got[1].append(h.hexdigest())
                    seq, h = s, hashlib.sha256(t.encode())
                else:
                    h.update(b"," + t.encode())
            yield pa.RecordBatch.from_arrays([pa.array(got[0], pa.binary()), pa.array(got[1], pa.string())], ["seq", "sha256"])
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([seq], pa.binary()), pa.array([h.hexdigest()], pa.string())], ["seq", "sha256"])

    put = ends.select("seq", "conv_id").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id").mapInArrow(pieces, "seq binary, first long, ids string")
    return put.repartition("seq").sortWithinPartitions("seq", "first").mapInArrow(digests, "seq binary, sha256 string")


def trie_report(lists: DataFrame) -> DataFrame:
    """The trie's nodes with the digest of the conversations that end in each."""
    trie = prefix_trie(lists)
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    none = trie.nodes.where("seq is null").select(*cols, F.lit(hashlib.sha256(b"").hexdigest()).alias("ends_sha256"))
    some = trie.nodes.where("seq is not null").join(list_digests(trie.ends), "seq").select(*cols, F.col("sha256").alias("ends_sha256"))
    return none.unionAll(some)
