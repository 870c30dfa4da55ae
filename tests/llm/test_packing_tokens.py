"""op2 and op3 against plain Python over the same tokenizer."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyspark.llm import packing, tokens

CASES = [(1, "Hello world, don't   stop"), (2, ""), (3, None), (None, "a b"), (4, "x" * 50), (5, " lead and trail "), (5, " lead and trail "),
         (6, "tabs\tand\nlines \n\n mixed  spaces"), (7, "naïve café — ünïcode 漢字 🙂 <|endoftext|> it's"), (8, "long words here " * 3000), (9, "  nbsp  em")]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(tokens.vocabulary_path())        # as it comes: special tokens in a text are special


def test_encoder_equals_whole_text_encoding(tok):
    texts = [t or "" for _, t in CASES]
    got = tokens.Encoder(tokens.vocabulary_path())(texts)
    for t, g in zip(texts, got):
        assert np.frombuffer(g, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_pieces_and_places(spark, docs, tok):
    out = packing.pack(docs(CASES), capacity=64).collect()
    want = []
    for d, t in CASES:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        first, at, k = len(ids) % 64 or 64, 0, 0
        while at < len(ids):
            n = first if k == 0 else 64
            want.append((d, k, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())))
            at, k = at + n, k + 1
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r[:5]) for r in out), key=key) == sorted(want, key=key)
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seqs.values():
        end = 0
        for off, n in sorted(places):
            assert off == end
            end += n
        assert end <= 64
    total = sum(r.length for r in out)
    assert len(seqs) <= -(-total // 64) + 2
    assert packing.pack(docs([]), capacity=64).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_configuration_cover_is_exact_and_tight(seed):
    rng = np.random.default_rng(seed)
    sizes, counts = np.unique(np.minimum(1024, 1 + rng.lognormal(5, 1.2, 4000).astype(int)), return_counts=True)
    plan = packing.round_cover(sizes, counts, 1024, packing.configuration_lp(sizes, counts, 1024, rounds=60))
    held = np.zeros(len(sizes), int)
    for conf, n in plan:
        assert n > 0 and sum(int(sizes[i]) * k for i, k in conf.items()) <= 1024
        for i, k in conf.items():
            held[i] += n * k
    assert (held == counts).all()
    bound = -(-int((sizes * counts).sum()) // 1024)
    assert sum(n for _, n in plan) <= bound * 1.01 + 2


def test_token_counts(spark, docs, tok):
    lens = [len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in CASES]
    h = tokens.histogram(docs(CASES))
    rows = {r.context_limit: r for r in tokens.context_limits(h, block=8).collect()}
    assert sorted(rows) == sorted(set(lens))
    for k, r in rows.items():
        assert r.docs == lens.count(k) and r.docs_fit == sum(x <= k for x in lens) and r.docs_over == sum(x > k for x in lens)
        assert r.tokens_fit == sum(x for x in lens if x <= k) and r.tokens_kept == sum(min(x, k) for x in lens)
        assert r.tokens_total == sum(lens) and r.quantile == pytest.approx(sum(x <= k for x in lens) / len(lens))
    q = {r.q: r.n_tokens for r in tokens.quantiles(tokens.context_limits(h), [0.5, 1.0]).collect()}
    assert q[1.0] == max(lens) and q[0.5] == sorted(lens)[(len(lens) + 1) // 2 - 1]
    assert tokens.context_limits(tokens.histogram(docs([]))).count() == 0


def test_cuts_put_together_equal_whole_encoding(tok):
    """Random texts of letters, points, line ends and spaces in every order."""
    import random

    rng = random.Random(6)
    parts = ["the", "Éclair", "don't", "x1", ",", ".", "!!", "&&&", "\n", "\n\n", " ", "  ", "\t", "'s", "ñ", "²", "-", "a.b", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    enc = tokens.Encoder(tokens.vocabulary_path())
    for s in range(0, len(texts), 500):
        for t, g in zip(texts[s : s + 500], enc(texts[s : s + 500])):
            assert np.frombuffer(g, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_special_tokens_as_the_tokenizer_gives_them():
    from tokenizers import Tokenizer

    from tallyspark.llm.tokens import Encoder, vocabulary_path
    texts = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>b  <|endoftext|>", " <|endoftext|> <|endoftext|>x ", "<|endo ftext|>", "no. special"]
    plain = Tokenizer.from_file(vocabulary_path())
    assert [list(memoryview(x).cast("I")) for x in Encoder(vocabulary_path())(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_counts_encode_a_document_once(spark):
    """The plan reads a saved histogram: no Python is left in it, however often it is used."""
    from tallyspark.llm.queries import op3_token_counts
    plan = op3_token_counts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Scan parquet" in plan


def test_encoder_keeps_runs_not_their_combinations(tok):
    """Cuts such as ``one,two`` are made from their runs each time: the cache grows with words, not with pairs of words."""
    names = ["".join(p) for p in zip("abcdefghijklmnopqrst", "tsrqponmlkjihgfedcba")]
    texts = ["go " + " ".join(f"{x}.\n{y}" for y in names) + " 4.0.\nx A1,b" for x in names]
    enc = tokens.Encoder(tokens.vocabulary_path())
    enc.state["first"].clear()
    enc.state["rest"].clear()
    for got in (enc(texts), enc(texts[::-1])[::-1]):
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(enc.state["first"]) + len(enc.state["rest"]) <= 2 * len(names) + 10


def test_next_job_gets_the_memory_of_the_last_ones_cache():
    """Freed blocks below one that stays would otherwise remain with the process."""
    import os
    import subprocess
    import sys

    code = """
from tallyspark.llm.common import worker_cache
held = lambda: int(next(x for x in open("/proc/self/status") if x.startswith("VmRSS")).split()[1]) // 1024
first = worker_cache("one")
first.update({i: b"x" * 60_000 for i in range(3000)})
stays = [b"y" * 60_000 for _ in range(3)]
full = held()
assert worker_cache("one") is first and len(first) == 3000
worker_cache("two")
assert not first and full - held() > 100, (full, held())
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], check=True, env={**os.environ, "PYTHONPATH": root}, timeout=120)
