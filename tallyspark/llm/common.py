"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import types
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import checkpoint_dir


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only for local sessions that name none (tests)."""
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="llm-ckpt-") if local and not named else None)


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: Column | str, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % m


def worker_cache(name: str) -> dict:
    """A dict that lives in the Python worker process while tasks ask for it by this name.

    A new name drops the others: jobs follow one another in the same workers, and one job's
    cache must not take memory from the next.
    """
    holder = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache")).__dict__.setdefault("caches", {})
    if name not in holder:
        if holder:
            for old in list(holder):
                holder.pop(old).clear()
            _give_back()
        holder[name] = {}
    return holder[name]


def _give_back() -> None:
    """Return freed memory to the system, where allocators would keep it for this process."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def portions(texts: list, max_chars: int = 1_000_000):
    """(start, end) slices of ``texts`` with about ``max_chars`` characters each, at least one text."""
    start = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= max_chars:
            yield start, i + 1
            start, n = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
