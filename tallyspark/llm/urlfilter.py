"""URL filtering with a sorted digest array.

Entries are ``host`` or ``host/path-prefix`` strings, each with the verdict allow or block
(rules) or blocked by list.  Their 64-bit xxhash keys are kept sorted in one
file in the shared folder, followed by the full strings; Spark hands the file to
every executor, each task memory-maps it, probes all host suffixes and path
prefixes of a batch of URLs with one vectorised binary search, and confirms the
stored string of every hit, so a hash collision decides nothing.

An entry fits its host and all its subdomains when the URL's path starts with
the entry's path.  Among rules the longest (characters of host and path) wins;
equally long rules can't fit one URL twice unless block and allow name the same
entry, then block wins.  Without a fitting rule the block list decides: block
if an entry of it fits, else allow.

Cases: a null URL or one without ``://`` has an empty host and path and is
allowed; ports and user names stay part of the host; repeated rows are judged
each; extra columns are ignored; very long URLs are read whole (only prefix
lengths that some entry has are probed).
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import shared_dir, worker_cache

#: the rules of the contract: (entry, verdict)
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: blocked sites (with their subdomains, whatever the path)
BLOCKED = ("ads-track.example.com", "adult-x.example.com", "casino-win.example.net", "cheap-pills.example.net", "free-bets.example.net", "spam-farm.example.org")

ALLOW_RULE, BLOCK_RULE, BLOCK_LIST = 1, 2, 4


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).otherwise(F.lit(""))
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))
    return F.coalesce(rest, F.lit(""))


def digest_array(entries: dict[str, int]) -> bytes:
    """Header (entries, string bytes), sorted keys, flags, string offsets, strings."""
    import xxhash

    rows = sorted((xxhash.xxh64_intdigest(k), k.encode(), f) for k, f in entries.items())
    texts = [r[1] for r in rows]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype("<u8")
    return b"".join([struct.pack("<QQ", len(rows), int(offsets[-1])), np.array([r[0] for r in rows], "<u8").tobytes(), np.array([r[2] for r in rows], "<u8").tobytes(), offsets.tobytes(), *texts])


def publish(spark: SparkSession, blob: bytes) -> str:
    """Write ``blob`` into the shared folder and add it to the job's files; its name."""
    name = f"digests-{hashlib.sha256(blob).hexdigest()[:24]}.bin"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, True)
        out.write(bytearray(blob))
        out.close()
    spark.sparkContext.addFile(str(fs.makeQualified(path).toString()))
    return name


class DigestArray:
    """The memory-mapped array of one file."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n, size = struct.unpack("<QQ", raw[:16].tobytes())
        at = 16
        self.keys = raw[at : at + 8 * n].view("<u8")
        self.flags = raw[at + 8 * n : at + 16 * n].view("<u8")
        self.offsets = raw[at + 16 * n : at + 24 * n + 8].view("<u8")
        self.texts = raw[at + 24 * n + 8 : at + 24 * n + 8 + size]
        hosts, prefixes = set(), set()
        for i in range(n):  # which numbers of labels and which path lengths occur at all
            host, slash, path = self.text(i).partition("/")
            hosts.add(host.count(".") + 1)
            prefixes.add(len(slash + path))
        self.labels, self.prefixes = sorted(hosts), sorted(prefixes)

    def text(self, i: int) -> str:
        return self.texts[int(self.offsets[i]) : int(self.offsets[i + 1])].tobytes().decode()

    def probe(self, candidates: list[str]) -> np.ndarray:
        """Flags of each candidate (0: not an entry)."""
        import xxhash

        out = np.zeros(len(candidates), np.int64)
        if not len(self.keys) or not candidates:
            return out
        h = np.fromiter((xxhash.xxh64_intdigest(c) for c in candidates), np.uint64, len(candidates))
        i = np.searchsorted(self.keys, h)
        for j in np.flatnonzero(self.keys[np.minimum(i, len(self.keys) - 1)] == h).tolist():
            k = int(i[j])
            while k < len(self.keys) and self.keys[k] == h[j]:  # confirm the stored string
                if self.text(k) == candidates[j]:
                    out[j] = int(self.flags[k])
                    break
                k += 1
        return out


def url_filter(pages: DataFrame, rules=RULES, blocked=BLOCKED) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    spark = pages.sparkSession
    entries: dict[str, int] = {}
    for e, v in rules:
        entries[e] = entries.get(e, 0) | (ALLOW_RULE if v == "allow" else BLOCK_RULE)
    for e in blocked:
        entries[e] = entries.get(e, 0) | BLOCK_LIST
    name = publish(spark, digest_array(entries))

    def run(batches):
        held = worker_cache("digest-arrays")
        where = SparkFiles.get(name)
        if where not in held:
            held[where] = DigestArray(where)
        table = held[where]
        for b in batches:
            hosts, paths = b.column(1).to_pylist(), b.column(2).to_pylist()
            cand, owner = [], []
            for j, (h, p) in enumerate(zip(hosts, paths)):
                if not h:
                    continue
                labels = h.split(".")
                for n in table.labels:
                    if n > len(labels):
                        break
                    tail = ".".join(labels[-n:])
                    for m in table.prefixes:
                        if m > len(p):
                            break
                        cand.append(tail + p[:m])
                        owner.append(j)
            flags = table.probe(cand)
            rule: list = [None] * len(hosts)
            verdict = ["allow"] * len(hosts)
            listed = set()
            for c in np.flatnonzero(flags).tolist():
                j, text, f = owner[c], cand[c], int(flags[c])
                if f & BLOCK_LIST:
                    listed.add(j)
                if f & (ALLOW_RULE | BLOCK_RULE) and (rule[j] is None or len(text) > len(rule[j])):
                    rule[j], verdict[j] = text, "block" if f & BLOCK_RULE else "allow"
            for j in listed:
                if rule[j] is None:
                    verdict[j] = "block"
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


def oracle_sql() -> str:
    """The same judgement in DuckDB SQL."""
    values = ", ".join(f"('{e}', '{v}')" for e, v in RULES)
    listed = ", ".join(f"('{e}')" for e in BLOCKED)
    fits = "(u.host = split_part({e}, '/', 1) or ends_with(u.host, '.' || split_part({e}, '/', 1))) and starts_with(u.path, case when instr({e}, '/') > 0 then substr({e}, instr({e}, '/')) else '' end)"
    return f"""
with u as (
  select page_id, case when instr(url, '://') > 0 then translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
         case when instr(url, '://') > 0 then regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') else '' end as path,
         row_number() over () as rn
  from pages),
rules(entry, verdict) as (values {values}),
listed(entry) as (values {listed}),
best as (select u.rn, max_by(r.entry, length(r.entry)) as rule, max_by(r.verdict, length(r.entry)) as verdict
         from u join rules r on {fits.format(e='r.entry')} where u.host <> '' group by u.rn),
bad as (select distinct u.rn from u join listed l on {fits.format(e='l.entry')} where u.host <> '')
select u.page_id, coalesce(u.host, '') as host, coalesce(u.path, '') as path, best.rule as rule,
       coalesce(best.verdict, case when bad.rn is not null then 'block' else 'allow' end) as verdict
from u left join best on best.rn = u.rn left join bad on bad.rn = u.rn"""
