"""Token encoding inside Spark tasks and exact token-length statistics.

Encoding goes through ``tokenizers`` and a public vocabulary file (its path is a
parameter).  A byte-level BPE vocabulary with the usual splitting pattern starts a
new piece at every space that follows no white space, so texts are cut there, by
Arrow and for a whole portion of them at once.  Each distinct cut of a portion is looked
up or encoded once; cuts of several runs (letters, points, line ends) are put
together from their runs, and the ids of the others are kept by the worker.
Texts with a space after other white space are encoded whole.

Token counts: documents are aggregated by encoded length (an exact histogram),
and two-level suffix sums over the histogram answer totals, quantiles and
truncated totals for every context limit.

Cases: null and empty texts have the length of the end token alone (or 0 without
one); repeated rows count each; an empty table gives an empty histogram; extra
columns are ignored; very long texts are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import portions, worker_cache

END_ID = 2
# a space after white space: the splitting pattern may take both into one piece
# and runs that the vocabulary's splitting pattern never joins with their neighbours (no digits, apostrophes, rare letters)
UNSAFE = re.compile(r"\s ")
LETTERS, SIGNS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", ".,!?;:#$%&*"
RUN = f"([{LETTERS}]+|[{SIGNS}]+|\n)"
#: a cut of two or more runs (and no empty line, which is looked for apart)
SEVERAL = f"^(?:[{LETTERS}]+[{SIGNS}\n]|[{SIGNS}]+[{LETTERS}\n])[{LETTERS}{SIGNS}\n]*$"
#: characters of texts that are encoded together
PORTION = 3_000_000


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """ids of texts as little-endian unsigned 32-bit bytes; keeps the ids of recent cuts (at most ``keep``)."""

    def __init__(self, path: str, keep: int = 500_000):
        self.keep = keep
        self.state = worker_cache(f"encoder-{path}")
        if "tok" not in self.state:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(path)
            # ids of a text's first cut, and of cuts after a space (kept without that space)
            self.state.update(tok=tok, first={}, rest={})

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.state["tok"].encode_batch_fast(texts, add_special_tokens=False)]

    def _ids(self, known: dict, cuts: pa.Array, lead: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all ``cuts`` one after the other, number of ids of each); new ones are encoded after ``lead`` and kept."""
        texts = cuts.to_pylist()
        ids = list(map(known.get, texts))
        if None in ids:
            at = [i for i, x in enumerate(ids) if x is None]
            for s in range(0, len(at), 20_000):
                part = at[s : s + 20_000]
                for i, x in zip(part, self._encode([lead + texts[i] for i in part])):
                    ids[i] = x
                    if len(texts[i]) <= 200:
                        known[texts[i]] = x
        return np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4

    def _made(self, cuts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_ids`` for cuts of several runs after a space: the first run follows the space, the others nothing."""
        runs = pc.split_pattern(pc.replace_substring_regex(cuts, RUN, "\\1\x01"), "\x01")
        offsets = runs.offsets.to_numpy()
        tail = np.ones(len(runs.values), bool)
        tail[offsets[:-1]] = tail[offsets[1:] - 1] = False  # nothing follows the last mark
        heads = runs.values.take(pa.array(offsets[:-1])).dictionary_encode()
        tails = runs.values.filter(pa.array(tail)).dictionary_encode()
        tables = [self._ids(self.state["rest"], heads.dictionary, " "), self._ids(self.state["first"], tails.dictionary, "")]
        code = np.empty(len(tail), np.int64)
        code[offsets[:-1]] = heads.indices.to_numpy()
        code[tail] = tails.indices.to_numpy() + len(heads.dictionary)
        own = np.ones(len(tail), bool)
        own[offsets[1:] - 1] = False
        ids, n = _gather(tables, code[own])
        return ids, np.add.reduceat(n, offsets[:-1] - np.arange(len(cuts))) if len(cuts) else n

    def __call__(self, texts: list[str]) -> list[bytes]:
        first, rest = self.state["first"], self.state["rest"]
        if len(first) + len(rest) > self.keep:
            first.clear()
            rest.clear()
        out: list[bytes] = [b""] * len(texts)
        whole = [i for i, t in enumerate(texts) if UNSAFE.search(t)]
        for i, ids in zip(whole, self._encode([texts[i] for i in whole])):
            out[i] = ids
        rare = set(whole)
        plain = [i for i in range(len(texts)) if i not in rare]
        if not plain:
            return out
        cuts = pc.split_pattern(pa.array([texts[i] for i in plain], pa.large_string()), " ")
        offsets = cuts.offsets.to_numpy()
        begin = offsets[:-1]
        heads = cuts.values.take(pa.array(begin)).dictionary_encode()
        every = cuts.values.dictionary_encode()
        code = every.indices.to_numpy().astype(np.int64)
        later = np.ones(len(code), bool)
        later[begin] = False
        used = np.bincount(code[later], minlength=len(every.dictionary)) > 0
        several = np.asarray(pc.match_substring_regex(every.dictionary, SEVERAL)) & ~np.asarray(pc.match_substring(every.dictionary, "\n\n"))
        groups = [np.flatnonzero(used & ~several), np.flatnonzero(used & several)]
        tables = [self._ids(rest, every.dictionary.take(pa.array(groups[0])), " "), self._made(every.dictionary.take(pa.array(groups[1]))),
                  self._ids(first, heads.dictionary, "")]
        place = np.zeros(len(used), np.int64)
        place[np.concatenate(groups)] = np.arange(used.sum())
        code = place[code]
        code[begin] = heads.indices.to_numpy() + used.sum()
        ids, n = _gather(tables, code)
        end = np.concatenate(([0], np.cumsum(n)))[offsets] * 4
        raw = ids.tobytes()
        for k, i in enumerate(plain):
            out[i] = raw[end[k] : end[k + 1]]
        return out


def _gather(tables: list[tuple[np.ndarray, np.ndarray]], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of ids of each) of the entries ``code`` of the joined ``tables`` (ids, number of ids of each entry)."""
    ids, size = (np.concatenate(x) for x in zip(*tables))
    n = size[code]
    end = np.cumsum(n)
    shift = (np.cumsum(size) - size)[code] - (end - n)
    return ids[np.arange(n.sum()) + np.repeat(shift, n)], n


def lengths(docs: DataFrame, path: str | None = None, end: bool = True) -> DataFrame:
    """(n_tokens) of every row of ``docs``."""
    path = path or vocabulary_path()

    def run(batches):
        enc = Encoder(path)
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            for s, e in portions(texts, PORTION):
                n = np.fromiter((len(x) // 4 for x in enc(texts[s:e])), np.int64, e - s) + int(end)
                yield pa.RecordBatch.from_arrays([pa.array(n)], ["n_tokens"])

    return docs.select("text").mapInArrow(run, "n_tokens long")


def histogram(docs: DataFrame, path: str | None = None, end: bool = True) -> DataFrame:
    """(n_tokens, docs): documents by encoded length; one row per distinct length."""
    return lengths(docs, path, end).groupBy("n_tokens").agg(F.count("*").alias("docs"))


def context_limits(hist: DataFrame, block: int = 1024) -> DataFrame:
    """For every length in ``hist`` taken as context limit: what fits, what is cut, totals and the quantile.

    Columns: context_limit, docs (of that length), docs_fit (not longer), docs_over (longer),
    tokens_fit (all tokens of those that fit), tokens_kept (all documents truncated to the limit),
    tokens_total, quantile (share of documents not longer).  Suffix sums run inside blocks of lengths and
    over the block totals, so no task holds the whole histogram.
    """
    h = hist.withColumn("tokens", F.col("n_tokens") * F.col("docs")).withColumn("block", F.floor(F.col("n_tokens") / block))
    totals = h.groupBy("block").agg(F.sum("docs").alias("bd"), F.sum("tokens").alias("bt"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select("block", F.coalesce(F.sum("bd").over(after), F.lit(0)).alias("later_docs"), F.coalesce(F.sum("bt").over(after), F.lit(0)).alias("later_tokens"),
                           F.sum("bd").over(whole).alias("all_docs"), F.sum("bt").over(whole).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    j = h.join(totals, "block")
    over = F.coalesce(F.sum("docs").over(inside), F.lit(0)) + F.col("later_docs")
    over_tokens = F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("later_tokens")
    j = j.withColumn("docs_over", over).withColumn("tokens_over", over_tokens)
    fit = F.col("all_tokens") - F.col("tokens_over")
    return j.select(F.col("n_tokens").alias("context_limit"), "docs", (F.col("all_docs") - F.col("docs_over")).alias("docs_fit"), "docs_over",
                    fit.alias("tokens_fit"), (fit + F.col("docs_over") * F.col("n_tokens")).alias("tokens_kept"),
                    F.col("all_tokens").alias("tokens_total"), ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("quantile"))


def quantiles(limits: DataFrame, qs: list[float]) -> DataFrame:
    """(q, n_tokens): the smallest length that at least the share ``q`` of documents does not exceed."""
    return limits.agg(*[F.min(F.when(F.col("quantile") >= q, F.col("context_limit"))).alias(str(i)) for i, q in enumerate(qs)]).select(
        F.explode(F.array(*[F.struct(F.lit(q).alias("q"), F.col(f"`{i}`").alias("n_tokens")) for i, q in enumerate(qs)])).alias("r")).select("r.*")
