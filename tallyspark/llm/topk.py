"""Exact top-k inner products with vector-approximation files.

Every component x becomes floor(256 * x).  Candidates are cut into shards and
queries into blocks; a task holds one shard and one block.  Within it, an
approximation file gives every candidate dimension a cell of equal width, and a
scan over the cells bounds every score from both sides.  Exact vectors are then
read in the order of their upper bounds until the k-th best exact score reaches
the next bound, so the shard's k best are certain; the shards' lists are merged
by a grouped window.

Cases: vectors that are null, empty or hold null or non-finite components take
no part; a query's own row is no candidate, but other rows of its vec_id are; ties
go to the smaller vec_id; repeated ids are separate candidates, and every row of a
repeated query id is a query with its own k rows; vectors of another length than the query's are no
candidates for it; an empty table gives an empty result; extra columns are
ignored; components beyond +-2**20 after scaling are clipped by no rule: they
are computed in exact 64-bit integers as long as the sum fits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: rows of a candidate shard and of a query block
SHARD, BLOCK = 16_384, 2_048
CELLS = 64


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<long>) of the vectors that take part."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    good = F.col("e").isNotNull() & (F.size("e") > 0) & F.forall("e", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    t = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e")).where(good)
    return t.select("vec_id", F.transform("e", lambda x: F.floor(F.lit(256.0) * x).cast("long")).alias("v"))


def certain_top(cand: np.ndarray, ids: np.ndarray, query: np.ndarray, own: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (row, positions of its k best candidates, their scores); candidates n x d integers, ids ascending.

    One candidate of the query's id ``own`` and vector is left out: the query's own row (its copies stay).
    """
    lo, hi = cand.min(0), cand.max(0)
    width = np.maximum((hi - lo + CELLS) // CELLS, 1)  # cell c of a dimension: lo + c*width .. lo + (c+1)*width - 1
    cells = ((cand - lo) // width).astype(np.uint8)  # the approximation file
    middle = (lo + (width - 1) / 2).astype(np.float64)
    out = []
    q = query.astype(np.float64)
    approx = (q * width) @ cells.T.astype(np.float64) + (q @ middle)[:, None]
    slack = np.abs(q) @ ((width - 1) / 2) + 1e-6 * (1 + np.abs(approx).max(1))
    for i in range(len(query)):
        upper = approx[i] + slack[i]
        lo_id, hi_id = np.searchsorted(ids, own[i], "left"), np.searchsorted(ids, own[i], "right")
        same = np.flatnonzero((cand[lo_id:hi_id] == query[i]).all(1))
        if len(same):
            upper[lo_id + same[0]] = -np.inf
        n = int(np.isfinite(upper).sum())
        if not n:
            continue
        m = min(k, n)
        # exact vectors in the order of their bounds, in growing steps
        want = min(n, 4 * k)
        while True:
            near = np.argpartition(-upper, want - 1)[:want] if want < len(upper) else np.flatnonzero(np.isfinite(upper))
            exact = cand[near] @ query[i]
            order = np.lexsort((ids[near], -exact))[:m]
            kth = exact[order[-1]]
            rest = upper.copy()
            rest[near] = -np.inf
            if want >= n or rest.max() < kth:  # a tie may still win by its id, so strictly below
                break
            want = min(n, max(2 * want, int((upper >= kth).sum())))
        out.append((i, near[order], exact[order]))
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query row."""
    rows = integers(vectors.select("vec_id", "embedding"))
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    shards, blocks = max(1, -(-sizes["n"] // shard)), max(1, -(-sizes["q"] // block))
    h = F.xxhash64(F.lit(3), "vec_id", "v")
    cand = rows.select("vec_id", "v", F.pmod(h, F.lit(shards)).alias("s"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    # copies of a row are all in its shard, so exactly one of them, the query itself, is left out there
    asked = rows.where(is_query).groupBy("vec_id", "v").agg(F.count("*").cast("int").alias("copies"))
    query = asked.select("vec_id", "v", "copies", F.sha2(F.array_join("v", ","), 256).alias("vector"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s"), F.pmod(h, F.lit(blocks)).alias("b"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[list] = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            sets = []
            for t in (left, right):
                ids = t.column("vec_id").to_numpy()
                col = t.column("v").combine_chunks()
                size = np.diff(col.offsets.to_numpy())
                flat = col.flatten().to_numpy()
                by = {}
                for d in np.unique(size):
                    at = np.flatnonzero(size == d)
                    start = col.offsets.to_numpy()[:-1][at] - col.offsets.to_numpy()[0]
                    m = flat[start[:, None] + np.arange(d)[None, :]]
                    o = np.argsort(ids[at], kind="stable")
                    by[int(d)] = (ids[at][o], m[o], at[o])
                sets.append(by)
            copies, vector = right.column("copies").to_pylist(), right.column("vector").to_pylist()
            for d, (qid, q, row) in sets[1].items():
                if d not in sets[0]:
                    continue
                ids, c, _ = sets[0][d]
                for s in range(0, len(q), 256):
                    for i, pos, score in certain_top(c, ids, q[s : s + 256], qid[s : s + 256], k):
                        found[0] += [qid[s + i]] * len(pos)
                        found[1] += ids[pos].tolist()
                        found[2] += score.tolist()
                        found[3] += [copies[row[s + i]]] * len(pos)
                        found[4] += [vector[row[s + i]]] * len(pos)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        return pa.table([pa.array(x, t) for x, t in zip(found, kinds)], ["query_id", "vec_id", "score", "copies", "vector"])

    near = cand.groupBy("s", "b").cogroup(query.groupBy("s", "b")).applyInArrow(search, "query_id long, vec_id long, score long, copies int, vector string")
    best = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("query_id", "rank", "vec_id", "score")
