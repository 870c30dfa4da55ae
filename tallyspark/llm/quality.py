"""Quality by compression: dictionaries of good and bad labelled text compete.

Zstandard dictionaries are built from blocks of labelled texts, ``DICTIONARIES``
for each class, each from its own share of the blocks.  A text is cut into
blocks of ``BLOCK`` bytes; every block is compressed with every dictionary alone, so
long texts profit from a dictionary as short ones do, and the text's evidence is
the difference of its compressed sizes (bad minus good) for each byte of text.  The
difference, measured against the spread of good texts, becomes a probability by a
logistic curve whose slope grows with the length, as long texts' differences
vary less; the curve is fitted on labelled texts that the dictionaries have not seen.

Cases: a null or empty text has no evidence and gets the share of good
labels; null labels and labels of unknown documents teach nothing; contradicting
labels of one document count as good; with one class labelled every score is
that class's; without labels every score is 0.5; repeated rows are scored each;
other columns are ignored; very long texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.charlm import logistic

#: bytes that are compressed together, dictionaries of each class and their size, compression level
BLOCK, DICTIONARIES, DICTIONARY_BYTES, LEVEL = 512, 3, 32 << 10, 1
#: bounds of the labelled sample: rows and blocks of each class (ordered by a hash)
MAX_ROWS_PER_CLASS, MAX_BLOCKS_PER_CLASS = 4000, 20_000
THRESHOLD = 0.3


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS) -> DataFrame:
    """(cls, part, text) of at most ``max_rows`` labelled documents of each class; part 0 builds dictionaries, 1 fits the curve."""
    by = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("cls"))
    by = by.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = [by.where(F.col("cls") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) for c in (0, 1)]
    both = picked[0].unionAll(picked[1]).withColumn("part", (F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(10)) >= 7).cast("int"))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).join(F.broadcast(both), "doc_id").select("cls", "part", "text")  # 2 * max_rows ids


def dictionaries(sample: DataFrame, max_blocks: int = MAX_BLOCKS_PER_CLASS) -> dict[int, list[bytes]]:
    """Class -> dictionaries, each trained by a task on its share of at most ``max_blocks`` blocks (none where a class has no text)."""

    def blocks(batches):
        for b in batches:
            for c, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for i in range(0, len(t), 1000 * BLOCK):
                    part = [t[j : j + BLOCK] for j in range(i, min(i + 1000 * BLOCK, len(t)), BLOCK)]
                    yield pa.RecordBatch.from_arrays([pa.array([c] * len(part), pa.int32()), pa.array(part, pa.binary())], ["cls", "block"])

    def train(t: pa.Table) -> pa.Table:
        import zstandard

        texts = t.column("block").to_pylist()
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, texts, level=LEVEL).as_bytes()
        except zstandard.ZstdError:                    # too little text to choose from: all of it is the dictionary
            made = b"".join(texts)[-DICTIONARY_BYTES:]
        return pa.table({"cls": pa.array([t.column("cls")[0].as_py()], pa.int32()), "k": pa.array([t.column("k")[0].as_py()], pa.int32()), "made": pa.array([made], pa.binary())})

    cut = sample.select("cls", "text").mapInArrow(blocks, "cls int, block binary").withColumn("h", F.xxhash64("block"))
    kept = [cut.where(F.col("cls") == c).orderBy("h", "block").limit(max_blocks) for c in (0, 1)]
    # each dictionary leaves out other 3 tenths of the blocks
    shares = F.filter(F.sequence(F.lit(0), F.lit(DICTIONARIES - 1)), lambda k: F.pmod(F.pmod(F.col("h"), F.lit(10)) - 3 * k, F.lit(10)) >= 3)
    dealt = kept[0].unionAll(kept[1]).select("cls", F.explode(shares).alias("k"), "h", "block")
    made = dealt.orderBy("cls", "k", "h", "block").groupBy("cls", "k").applyInArrow(train, "cls int, k int, made binary").collect()  # 2 * DICTIONARIES rows of 32 KB
    return {c: [bytes(r.made) for r in sorted(made, key=lambda r: r.k) if r.cls == c] for c in (0, 1)}


def differences(docs: DataFrame, made: dict[int, list[bytes]], keep: dict[str, str]) -> DataFrame:
    """Columns ``keep`` (name: type) of each row with ``difference`` (compressed bytes, bad minus good, a byte of text) and ``bytes``."""

    def run(batches):
        import zstandard

        def compressors(c):
            found = [zstandard.ZstdCompressionDict(d) for d in made[c]] or [None]
            for d in found:
                if d is not None:
                    d.precompute_compress(level=LEVEL)
            return [zstandard.ZstdCompressor(level=LEVEL, **({"dict_data": d} if d is not None else {}), write_content_size=False, write_checksum=False, write_dict_id=False).compress for d in found]

        bad, good = compressors(0), compressors(1)
        for b in batches:
            diff, size = [], []
            for t in b.column(len(keep)).to_pylist():
                saved = 0.0
                for i in range(0, len(t), BLOCK):
                    x = t[i : i + BLOCK]
                    saved += sum([len(f(x)) for f in bad]) / len(bad) - sum([len(f(x)) for f in good]) / len(good)
                diff.append(saved / max(len(t), 1))
                size.append(len(t))
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + [pa.array(diff, pa.float64()), pa.array(size, pa.int64())], [*keep, "difference", "bytes"])

    kinds = ", ".join(f"{k} {t}" for k, t in keep.items())
    return docs.select(*keep, F.coalesce(F.col("text"), F.lit("").cast(dict(docs.dtypes)["text"])).cast("binary")).mapInArrow(run, f"{kinds}, difference double, bytes long")


def _curve(x: np.ndarray, size: np.ndarray, y: np.ndarray) -> dict:
    """Spread of good texts, slope for the length, and the share of good ones."""
    share = float(y.mean()) if len(y) else 0.5
    x, size, y = x[size > 0], size[size > 0], y[size > 0]
    if not len(y) or y.min() == y.max():
        return {"middle": 0.0, "spread": 1.0, "slope": 0.0, "longer": 0.0, "level": float(np.log((share + 1e-6) / (1 - share + 1e-6))), "share": share}
    middle = float(np.median(x[y == 1]))
    spread = float(1.4826 * np.median(np.abs(x[y == 1] - middle))) or float(x.std()) or 1.0
    z = np.arcsinh((x - middle) / spread)
    slope, longer, level = logistic(np.c_[z, z * np.log(size)], y.astype(float), ridge=0.1)
    return {"middle": middle, "spread": spread, "slope": float(slope), "longer": float(longer), "level": float(level), "share": share}


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS) -> dict:
    """Dictionaries and curve, learned from the labelled rows of ``docs`` (a bounded sample of ``max_rows`` of each class)."""
    sample = labelled_sample(docs, labels, max_rows)
    made = dictionaries(sample.where("part = 0"))
    seen = differences(sample.where("part = 1"), made, {"cls": "int"}).toPandas()  # 2 * max_rows rows of numbers
    seen = seen.sort_values(["difference", "bytes", "cls"])  # sums don't depend on the order of tasks
    return {"made": made, **_curve(seen["difference"].to_numpy(float), seen["bytes"].to_numpy(float), seen["cls"].to_numpy(float))}


def score(docs: DataFrame, fitted: dict, keep: dict[str, str]) -> DataFrame:
    """Columns ``keep`` of every row with ``score``, ``predicted`` and the ``difference`` they come from."""
    d = differences(docs, fitted["made"], keep)
    z = F.asinh((F.col("difference") - fitted["middle"]) / fitted["spread"])
    slope = F.greatest(F.lit(0.0), fitted["slope"] + fitted["longer"] * F.log(F.greatest(F.col("bytes"), F.lit(1)).cast("double")))
    p = F.when(F.col("bytes") == 0, F.lit(fitted["share"])).otherwise(1 / (1 + F.exp(-(z * slope + fitted["level"]))))
    return d.select(*keep, p.alias("score"), "difference").select(*keep, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "difference")


def quality(docs: DataFrame, labels: DataFrame, train: Column, held_out: Column | None = None) -> DataFrame:
    """Score every document; learn labels only where ``train`` holds."""
    fitted = fit(docs.where(train), labels)
    rows = docs.select("doc_id", (held_out if held_out is not None else ~train).alias("held_out"), "text")
    return score(rows, fitted, {"doc_id": "long", "held_out": "boolean"})
