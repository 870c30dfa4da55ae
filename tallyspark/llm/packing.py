"""Packing documents into token sequences by a configuration linear program.

Documents are encoded, cut into pieces of at most ``capacity`` tokens (only the
first piece of a long document may be shorter) and counted by piece length.
The histogram (at most ``capacity`` rows) is what the solver sees: minimise the
number of sequences over configurations (which lengths share a sequence) that
cover every length's count.  Multiplicative weights price the lengths, a
knapsack dynamic program finds the best configuration under these prices, and
the average of the found configurations is the fractional solution.  It is
rounded down to whole sequences; the few pieces left (bounded by the number of
configurations, not by the data) go by best fit on the histogram.

The pieces then get their places without any global order: every length has its
ranks cut into ranges per configuration, and a piece's rank comes from counts
per (length, salt) group, so a length that a third of all pieces share is split.

Cases: null and empty texts are one piece holding the end token; repeated rows
are packed each; an empty table gives an empty result; extra columns are
ignored; ties between equal pieces fall in hash order of (doc_id, piece).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import portions, saved
from tallyspark.llm.tokens import END_ID, PORTION, Encoder, vocabulary_path

CAPACITY = 1024
ROUNDS = 400
STEP = 0.5
#: share of the fractional solution that is rounded; the rest goes by best fit (all of it would strand odd lengths)
ROUND_SHARE = 0.5
#: pieces of one (length, salt) group that a task ranks
RANK_GROUP = 200_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's encoded ids followed by the end id."""
    path = path or vocabulary_path()

    def run(batches):
        enc = Encoder(path)
        end = np.array([END_ID], "<u4").tobytes()
        for b in batches:
            docs_, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for s, e in portions(texts, PORTION):
                rows: list[tuple] = []
                for d, ids in zip(docs_[s:e], enc(texts[s:e])):
                    ids += end
                    n = len(ids) // 4
                    first = n % capacity or capacity
                    at, k = 0, 0
                    while at < n:
                        size = first if k == 0 else capacity
                        rows.append((d, k, at, size, zlib.crc32(memoryview(ids)[at * 4 : (at + size) * 4])))
                        at, k = at + size, k + 1
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32())] + [pa.array(c, pa.int64()) for c in cols[2:]], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE_SCHEMA)


def _best_configuration(sizes: np.ndarray, price: np.ndarray, capacity: int) -> dict[int, int]:
    """Unbounded knapsack: the configuration {index of size: count} of highest total price within ``capacity``."""
    value = np.zeros(capacity + 1)
    take = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        k = int(np.searchsorted(sizes, c, "right"))
        if not k:
            continue
        v = price[:k] + value[c - sizes[:k]]
        i = int(v.argmax())
        value[c], take[c] = v[i], i
    out: dict[int, int] = {}
    c = capacity
    while c > 0 and take[c] >= 0:
        i = int(take[c])
        out[i] = out.get(i, 0) + 1
        c -= int(sizes[i])
    return out


def configuration_lp(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS, step: float = STEP) -> list[tuple[dict[int, int], float]]:
    """Fractional cover [(configuration, sequences)] of ``counts`` pieces of ``sizes`` by multiplicative weights."""
    if not len(sizes):
        return []
    log_w = np.log(sizes / capacity)  # start from each length's share of a sequence
    used: dict[tuple, float] = {}
    need = counts.astype(float)
    for _ in range(rounds):
        conf = _best_configuration(sizes, np.exp(log_w - log_w.max()), capacity)
        idx, k = np.array(list(conf)), np.array(list(conf.values()))
        amount = float((need[idx] / k).min())  # the scarcest length of it is covered once
        key = tuple(sorted(conf.items()))
        used[key] = used.get(key, 0.0) + amount
        log_w[idx] -= step * amount * k / need[idx]
    # the average configuration, scaled to as many tokens as there are
    filled = sum(x * sum(int(sizes[i]) * k for i, k in c) for c, x in used.items())
    scale = float((need * sizes).sum()) / filled
    return sorted(((dict(c), x * scale) for c, x in used.items()), key=lambda p: -p[1])


def round_cover(sizes: np.ndarray, counts: np.ndarray, capacity: int, cover: list[tuple[dict[int, int], float]]) -> list[tuple[dict[int, int], int]]:
    """Whole sequences [(configuration, sequences)] holding exactly ``counts`` pieces."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[dict[int, int], int]] = []

    def use(conf: dict[int, int], at_most: int) -> None:
        n = min([at_most] + [int(left[i]) // k for i, k in conf.items()])
        if n > 0:
            for i, k in conf.items():
                left[i] -= n * k
            out.append((conf, n))

    for conf, x in cover:
        if sum(int(sizes[i]) * k for i, k in conf.items()) == capacity:
            use(conf, int(x * ROUND_SHARE))
    # best fit on what is left: longest piece first, then always the longest that still fits
    while left.any():
        conf: dict[int, int] = {}
        room = capacity
        alive = np.flatnonzero(left)
        while k := int(np.searchsorted(sizes[alive], room, "right")):
            i = int(alive[k - 1])
            n = min(room // int(sizes[i]), int(left[i])) if conf else 1
            conf[i] = n
            room -= n * int(sizes[i])
            if n < left[i] and room >= sizes[i]:  # the opening piece again
                more = min(room // int(sizes[i]), int(left[i]) - n)
                conf[i] += more
                room -= more * int(sizes[i])
            alive = alive[: k - 1]
        use(conf, 1 << 60)
    return out


def slots(sizes: np.ndarray, plan: list[tuple[dict[int, int], int]]) -> tuple[np.ndarray, int]:
    """Per length and configuration the ranks it takes: rows (length, first rank, per sequence, first sequence, offset)."""
    taken = np.zeros(len(sizes), np.int64)
    rows, seq = [], 0
    for conf, n in plan:
        off = 0
        for i in sorted(conf, reverse=True):
            rows.append((int(sizes[i]), int(taken[i]), conf[i], seq, off))
            taken[i] += n * conf[i]
            off += int(sizes[i]) * conf[i]
        seq += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5), seq


def pack_pieces(p: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``p`` (doc_id, piece, length, ...) with ``sequence_id`` and ``offset``; sequences are gapless from offset 0."""
    spark = p.sparkSession
    p = saved(p)
    total = p.count()
    salts = max(1, -(-total // RANK_GROUP))
    salted = p.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    sizes_rows = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    # lengths are at most `capacity` many; the salts' counts stay in Spark
    hist = sizes_rows.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").collect()
    sizes, counts = np.array([r["length"] for r in hist], np.int64), np.array([r["n"] for r in hist], np.int64)
    plan = round_cover(sizes, counts, capacity, configuration_lp(sizes, counts, capacity))
    table, _ = slots(sizes, plan)
    shared = spark.sparkContext.broadcast(table)  # lengths x configurations, whatever the number of pieces
    before = sizes_rows.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).select("length", "salt", "base")
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy("length", "salt").orderBy(F.xxhash64("doc_id", "piece"), "doc_id", "piece", "start")) - 1)
    ranked = ranked.join(before, ["length", "salt"]).withColumn("r", F.col("r") + F.col("base")).drop("salt", "base")
    out_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in p.schema.fields) + ", sequence_id long, offset long"
    names = [f.name for f in p.schema.fields]

    def place(batches):
        t = shared.value
        key = t[:, 0] * (1 << 44) + t[:, 1]
        for b in batches:
            at = {n: i for i, n in enumerate(b.schema.names)}
            length, rank = b.column(at["length"]).to_numpy(zero_copy_only=False), b.column(at["r"]).to_numpy(zero_copy_only=False)
            row = t[np.searchsorted(key, length * (1 << 44) + rank, "right") - 1]
            k = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays([b.column(at[n]) for n in names] + [pa.array(row[:, 3] + k // row[:, 2]), pa.array(row[:, 4] + (k % row[:, 2]) * length)], names + ["sequence_id", "offset"])

    return ranked.mapInArrow(place, out_schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Pieces of all documents with their places in as few sequences as the rounded linear program gives."""
    return pack_pieces(pieces(docs, capacity, path), capacity)
