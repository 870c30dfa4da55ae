"""Maximal periodic runs of words by recompression.

The words of a portion of texts are numbered and laid out in one array, texts
divided by symbols that occur once.  Recompression alternates block compression (a
stretch of one symbol) and pair compression (adjacent symbols of the left and the
right half of a hashed split of the alphabet) and so builds a run-length grammar
level by level; equal stretches of text get equal symbols but for a few at their
ends.  The longest common extension (LCE) of two places, to either side, climbs
these levels while symbols agree and comes down at the first that differ.

A run of period q and length >= 4q has w[i] = w[i + q] on a stretch of at least 3q
words, which holds three neighbouring multiples of q, one of them a multiple
of 3q.  So the candidates of period q are the places g = 0, 3q, 6q, ... (a harmonic
number of places over all q) where g and two neighbours agree; the two LCEs of
(g, g + q) give the run's exact ends.  Of equal stretches the least period stays.

Cases: a null, empty or blank text has no words and no runs; a null doc_id counts
as the empty text in checksums; repeated rows are worked on each; other columns are ignored; very long
texts are read whole (their words and grammar, some 100 bytes a word, are in one task).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.bytewords import mix
from tallyspark.llm.common import portions

#: a run has at least this many words and this many periods
MIN_WORDS, MIN_PERIODS = 6, 4
#: candidates whose extensions are asked for at once
ASKED = 500_000
RUNS = "array<struct<start:long,length:long,period:long>>"


class Grammar:
    """Levels of recompressed symbols with run lengths and links between the levels' boundaries."""

    def __init__(self, words: np.ndarray, unique_from: int):
        """``words``: symbols; those from ``unique_from`` on occur once each (the array begins and ends with one)."""
        self.levels: list[tuple[np.ndarray, ...]] = []
        sym, free, rounds = words.astype(np.int64), int(words.max()) + 1, 0
        fixed = int((words >= unique_from).sum())
        while True:
            n = len(sym)
            cut = np.flatnonzero(sym[1:] != sym[:-1]) + 1
            first = np.concatenate(([0], cut))
            size = np.diff(np.concatenate((first, [n])))
            right = np.repeat(first + size, size) - np.arange(n)      # equal symbols from here to the block's end
            left = np.arange(n) - np.repeat(first, size) + 1           # and from the block's start to here
            # blocks
            made = sym[first]
            many = np.flatnonzero(size > 1)
            if len(many):
                names, inverse = np.unique((made[many] << 32) | size[many], return_inverse=True)
                made[many] = free + inverse
                free += len(names)
            # pairs
            half = (mix(made.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(rounds * 2 + 1)) >> np.uint64(63)).astype(np.int8)
            half[(made >= unique_from) & (made < unique_from + fixed)] = 2
            pair = np.flatnonzero((half[:-1] == 0) & (half[1:] == 1))
            if len(pair):
                names, inverse = np.unique((made[pair] << 32) | made[pair + 1], return_inverse=True)
                made[pair] = free + inverse
                free += len(names)
                keep = np.ones(len(made), bool)
                keep[pair + 1] = False
                made, first = made[keep], first[keep]
            rounds += 1
            if rounds > 60 or len(made) <= 2 * fixed:
                self.levels.append((sym, right, left, None, None))
                return
            up = np.full(n + 1, -1, np.int64)
            up[first] = np.arange(len(first))
            up[n] = len(first)
            self.levels.append((sym, right, left, up, np.concatenate((first, [n]))))
            sym = made

    def extend(self, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        """Words that agree from boundaries ``a`` and ``b`` on, to the right or (``back``) to the left."""
        ia, ib = a.copy(), b.copy()
        top = len(self.levels) - 1
        stopped = np.full(len(a), top)

        def step(which, sym, run):
            """Compare the next symbols of ``which``; advance the equal ones, return (equal, different)."""
            pa_, pb = ia[which] - back, ib[which] - back
            same = sym[pa_] == sym[pb]
            go = which[same]
            by = np.minimum(run[pa_[same]], run[pb[same]])
            ia[go] += -by if back else by
            ib[go] += -by if back else by
            return go, which[~same]

        live = np.arange(len(a))
        for k, (sym, right, left, up, _) in enumerate(self.levels):
            here, risen = live, []
            while len(here):
                if up is not None:
                    ua, ub = up[ia[here]], up[ib[here]]
                    both = (ua >= 0) & (ub >= 0)
                    ia[here[both]], ib[here[both]] = ua[both], ub[both]
                    risen.append(here[both])
                    here = here[~both]
                here, different = step(here, sym, left if back else right)
                stopped[different] = k
            live = np.concatenate(risen) if risen else np.zeros(0, np.int64)
        falling = np.zeros(0, np.int64)
        by_level = np.argsort(stopped, kind="stable")
        at = np.searchsorted(stopped[by_level], np.arange(top + 2))
        for k in range(top, 0, -1):
            falling = np.concatenate((falling, by_level[at[k] : at[k + 1]]))
            if not len(falling):
                continue
            sym, right, left, _, down = self.levels[k - 1]
            ia[falling], ib[falling] = down[ia[falling]], down[ib[falling]]
            here = falling
            while len(here):
                here, _ = step(here, sym, left if back else right)
        return a - ia if back else ia - a


def _candidates(w: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): multiples of three periods that agree, with two neighbouring multiples, with the word a period on."""
    n, places, periods = len(w), [], []
    for q in range(1, longest // MIN_PERIODS + 1):
        a = w[0 : n - q : 3 * q]
        hit = np.flatnonzero(a == w[q :: 3 * q][: len(a)])
        if len(hit):
            places.append(hit * (3 * q))
            periods.append(np.full(len(hit), q))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    g, q = np.concatenate(places), np.concatenate(periods)

    def agrees(x):
        inside = (x >= 0) & (x + q < n)
        return inside & (w[np.where(inside, x, 0)] == w[np.where(inside, x + q, 0)])

    low2, low, up, up2 = agrees(g - 2 * q), agrees(g - q), agrees(g + q), agrees(g + 2 * q)
    keep = (low2 & low) | (low & up) | (up & up2)
    return g[keep], q[keep]


def find_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """For each list of words its runs: rows of (start, length, period) in order of start, then period."""
    ids: dict[bytes, int] = {}
    flat = [ids.setdefault(w, len(ids)) for t in texts for w in t]
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    bounds = np.concatenate(([0], np.cumsum(sizes + 1)))                  # the divider before each text, and the last one
    w = np.empty(bounds[-1] + 1, np.int64)
    divider = np.zeros(len(w), bool)
    divider[bounds] = True
    w[~divider] = flat
    w[divider] = len(ids) + np.arange(len(bounds))
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(texts)
    g, q = _candidates(w, int(sizes.max()) if len(sizes) else 0)
    doc = np.searchsorted(bounds, g, "right") - 1
    inside = g + q < bounds[doc + 1] if len(g) else np.zeros(0, bool)      # a run crosses no divider
    g, q, doc = g[inside], q[inside], doc[inside]
    if not len(g):
        return out
    some = np.unique(doc)                                                  # the grammar covers texts with candidates
    shift = np.zeros(len(texts), np.int64)
    shift[some] = bounds[some] - np.concatenate(([0], np.cumsum(sizes[some] + 1)[:-1]))
    part = np.concatenate([w[bounds[d] : bounds[d + 1]] for d in some] + [w[-1:]])
    names, part = np.unique(part, return_inverse=True)
    grammar = Grammar(part, int(np.searchsorted(names, len(ids))))
    found = []
    for i in range(0, len(g), ASKED):
        a, p, s = g[i : i + ASKED], q[i : i + ASKED], shift[doc[i : i + ASKED]]
        ahead, behind = grammar.extend(a - s, a - s + p, False), grammar.extend(a - s, a - s + p, True)
        length = ahead + behind + p
        keep = length >= np.maximum(MIN_WORDS, MIN_PERIODS * p)
        found.append(np.unique(np.c_[a - behind, length, p][keep], axis=0))
    runs = np.unique(np.concatenate(found), axis=0)                        # by start, length, period
    runs = runs[np.concatenate(([True], (runs[1:, :2] != runs[:-1, :2]).any(1)))] if len(runs) else runs
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    of = np.searchsorted(bounds, runs[:, 0], "right") - 1
    runs[:, 0] -= bounds[of] + 1
    for d in np.unique(of):
        out[d] = runs[of == d]
    return out


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that stay when of every run only the first period is kept."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def _made_periodic(words: list[bytes], h: int) -> list[bytes]:
    """The texts of the query: one in ten repeats a stretch of its words from some word on."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def repetitions(docs: DataFrame, checksum: Column | None = None) -> DataFrame:
    """(doc_id, runs, collapsed) of every text; with ``checksum`` (long), of the texts made periodic by it.

    ``runs`` are (start, length, period) in words, by start and period; ``collapsed`` (binary, UTF-8) keeps
    of every run the first period, words joined by one space.
    """
    rows = docs.select("doc_id", (checksum if checksum is not None else F.lit(1)).cast("long").alias("h"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for b in batches:
            raw, h = b.column(2).to_pylist(), b.column(1).to_pylist()
            order = sorted(range(len(raw)), key=lambda i: len(raw[i]))      # texts of like length share a portion
            for s, e in portions([raw[i] for i in order]):
                words = [_made_periodic(raw[i].split(), h[i]) for i in order[s:e]]
                runs = find_runs(words)
                flat = np.concatenate(runs)
                at = pa.array(np.concatenate(([0], np.cumsum([len(r) for r in runs]))), pa.int32())
                lists = pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(3)], fields=list(struct)))
                ids = b.column(0).take(pa.array(order[s:e]))
                yield pa.RecordBatch.from_arrays([ids, lists, pa.array([collapse(w, r) for w, r in zip(words, runs)], pa.binary())], ["doc_id", "runs", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, runs {RUNS}, collapsed binary")


def report(found: DataFrame) -> DataFrame:
    """Number of runs, the run of greatest exponent (exactly compared), and digests of runs and collapsed text."""
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.expr(_BEST).alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return best.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("best.length * 1000 div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


#: runs come by start and period, so only a strictly greater exponent replaces the one found first
_BEST = ("aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (x, y) -> "
         "case when x is null or y.length * x.period > x.length * y.period then y else x end)")
