"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum and a join; the edges stay in Spark and are
written to the shared folder after every round, so lineage stays short.  A hot
vertex (a class with a third of all rows) is one key of a join that adaptive
execution can split; no step gathers a vertex's neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every (large: greater, small: not greater) neighbour of a vertex to the least one around it."""
    if large:
        e = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    j = e.join(least, "u")
    if large:
        out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, root) of every vertex of ``edges`` (u, v): root is the least vertex of its component.

    Empty edges give an empty result; loops (u = v) and repeated edges change nothing; null ends are ignored.
    ``max_rounds`` only guards against a broken input: the number of rounds is logarithmic in the longest path.
    """
    e = edges.where("u is not null and v is not null and u <> v").select("u", "v").distinct()
    state = None
    for _ in range(max_rounds):
        e = saved(_star(_star(e, True), False))
        now = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(e.select(F.col("v"), F.col("v"))).distinct()
