"""A training-data pipeline over ``documents``: five stages, each one operator of ``tallyspark.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents`` (whatever they are), the last one the
packed pieces.  Stages work on every row their predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import decontam, langid, neardup, packing, toxicity
from tallyspark.llm.common import saved


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list]:
    """``docs`` under names that clash with nothing (text keeps its own), their types, and the way back."""
    names = [c if c in ("text", "doc_id", "lang") else f"c{i}" for i, c in enumerate(docs.columns)]
    plain = docs.toDF(*names)
    return plain, dict(plain.dtypes), [F.col(n).alias(c) for n, c in zip(names, docs.columns)]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models, learned from all labelled rows here, don't call toxic."""
    plain, types, back = _plain(docs)
    fitted = toxicity.fit(plain, _table(spark, sf_dir, "labels"))
    return toxicity.score(plain, fitted, types).where("predicted = 0").select(*back)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that one of the learned languages explains."""
    plain, types, back = _plain(docs)
    return langid.predict(plain, langid.fit(plain), types).where(~F.col("rejected")).select(*back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one of least doc_id."""
    return neardup.deduplicate(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the kept documents with their places in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_languages),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("best_fit_packing", pack_sequences),
]

#: learned models, subword ids and solver choices can't be written in SQL; tests compare with plain Python instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
