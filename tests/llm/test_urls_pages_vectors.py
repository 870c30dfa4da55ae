"""op4, op9 and op10 against plain Python, and their odd cases."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import htmltext, topk, urlfilter


def judge(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for e, v in urlfilter.RULES:
        h, p = e.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(e) > len(best[0])):
            best = (e, v)
    listed = any(host == h or host.endswith("." + h) for h in urlfilter.BLOCKED)
    return host, path, best and best[0], best[1] if best else "block" if listed else "allow"


URLS = [None, "", "no scheme", "http://", "http://com", "http://com/", "https://EXAMPLE.com/en/x?q#f", "https://www.example.com/en/", "https://a.b.www.Example.com/en/1",
        "http://x.net/es/", "http://net/fr/a", "http://x.net/es", "http://xnet/es/", "ftp://free-bets.example.net/en/", "http://m.free-bets.example.net", "http://free-bets.example.net/fr/1",
        "http://notfree-bets.example.net/en/", "http://ads-track.example.com/a", "http://a.com?x://y", "http://a.com#://b.net/es/", "x://y://z.net/es/", "http://h.org/p\nq?r", "http://ÄB.com/en/"]


def test_urls(spark):
    rng = random.Random(1)
    for _ in range(200):
        host = ".".join(rng.choice(["www", "m", "example", "com", "net", "free-bets", "org"]) for _ in range(rng.randint(1, 4)))
        URLS.append(f"https://{host}{rng.choice(['', '/', '/en/', '/es/', '/fr/x', '/e'])}{rng.choice(['', '?a=/b', '#c'])}")
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(0, URLS[6], "x", "y"), (None, URLS[7], "x", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    out = urlfilter.url_filter(df).collect()
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out), key=str)
    assert got == sorted(((i, *judge(u)) for i, u, _, _ in rows), key=str)
    assert urlfilter.url_filter(df.limit(0)).count() == 0


def test_digest_array_confirms_strings(tmp_path):
    path = tmp_path / "d.bin"
    path.write_bytes(urlfilter.digest_array({f"h{i}.com/a/": 1 + i % 2 for i in range(500)}))
    t = urlfilter.DigestArray(str(path))
    assert t.probe([f"h{i}.com/a/" for i in range(500)]).tolist() == [1 + i % 2 for i in range(500)]
    assert not t.probe(["h1.com/", "", "h500.com/a/"]).any()
    t.keys = np.zeros(500, np.uint64)  # every key collides: only the stored string decides
    import xxhash
    old, xxhash.xxh64_intdigest = xxhash.xxh64_intdigest, lambda s: 0
    try:
        first, absent = t.probe(["h7.com/a/", "absent"])
    finally:
        xxhash.xxh64_intdigest = old
    assert first == 2 and absent == 0


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(0, 0.3, 8), 2)], 1.0) for i in range(400)]
    rows += [(1000 + i, [0.25] * 8, 1.0) for i in range(60)]  # ties
    rows += [(50, None, 1.0), (600, [], 1.0), (601, [1.0, None], 1.0), (602, [float("nan")] * 8, 1.0), (603, [float("inf")] * 8, 1.0), (604, [1.0] * 3, 1.0), (None, [1.0] * 8, 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5, shard=100, block=3).collect())
    vec = {i: np.floor(256.0 * np.float32(v).astype(float)).astype(int) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in vec:
        if q % 50 == 0:
            s = sorted((-int(vec[q] @ v), i) for i, v in vec.items() if i != q and len(v) == len(vec[q]))[:5]
            want += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    assert got == sorted(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_only_the_query_row_itself_is_left_out(spark):
    """Copies of the query and other vectors of its id are candidates; every row of a repeated query id has its own ranks."""
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(0, 0.3, 6), 2)]) for i in range(120)]
    rows += [rows[50], rows[50], rows[7], (100, [0.9] * 6), (100, [-0.9] * 6), (7, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5, shard=30, block=2).collect())
    vec = [(i, np.floor(256.0 * np.float32(v).astype(float)).astype(int)) for i, v in rows]
    want = []
    for a, (q, x) in enumerate(vec):
        if q % 50 == 0:
            s = sorted((-int(x @ v), i) for b, (i, v) in enumerate(vec) if b != a)[:5]
            want += [(q, r + 1, i, -y) for r, (y, i) in enumerate(s)]
    assert got == sorted(want) and len(got) == 5 * 7


def test_approximation_bounds_hold_for_any_integers():
    rng = np.random.default_rng(4)
    c = rng.integers(-5000, 5000, (300, 6))
    q = rng.integers(-5000, 5000, (20, 6))
    ids = np.arange(300)
    for i, pos, score in topk.certain_top(c, ids, q, np.full(20, -1), 7):
        exact = c @ q[i]
        assert [(-s, p) for s, p in zip(score.tolist(), pos.tolist())] == sorted((-int(s), p) for p, s in enumerate(exact))[:7]


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><script>var a="</p>";</script><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/x">menu</a></ul></nav><!-- c --><div class="cookie-notice">We use cookies</div>
<article><header><h1>Head&nbsp;line &lt;1&gt;</h1></header><p><b>First   para.<br>same block<p>Second <i>one</i>.</p><div class="ad">buy</div><aside>side</aside>
<form><input>q</form><blockquote>quoted &#233;</blockquote><section id="comments"><p>me too</p></section></article><div class="sidebar">more</div><footer>&copy;</footer></body></html>"""


def test_article_markup():
    inside, _, found = htmltext.blocks(PAGE)
    assert found and inside == ["Head line <1>", "First para. same block", "Second one.", "quoted é"]


@pytest.mark.parametrize("page,want", [("", ([], False)), ("plain", ([], False)), ("<article>a<script>x", (["a"], True)), ("<article>a<!-- b", (["a"], True)),
                                       ("<article><nav>m<article>b</article>", (["b"], True)), ("<article>1 < 2 & 3</article>", (["1 < 2 & 3"], True)), ("<main><p>x</main><p>y", (["x"], True))])
def test_broken_pages(page, want):
    inside, _, found = htmltext.blocks(page)
    assert (inside, found) == want


def test_host_runs_without_article_markup(spark):
    rng = random.Random(3)
    word = lambda: "w%d" % rng.randrange(10**6)
    menu = " ".join(f"menu{i}" for i in range(12))
    foot = " ".join(f"foot{i}" for i in range(9))
    rows, want = [], {}
    for i in range(40):
        paras = [" ".join(word() for _ in range(20)) for _ in range(3)]
        rows.append((i, "http://h.org/a", f"<body><div>{menu}</div><p>{paras[0]}</p><p>{paras[1]}</p><p>{paras[2]}</p><div>{foot}</div>", "t"))
        want[i] = "\n\n".join(paras)
    rows += [(100, "http://h.org/a", rows[0][2], "t"), (101, None, None, "t"), (102, "http://one.org/", "<p>only page", "t"), (103, "http://one.org/", "", "t")]
    want |= {100: want[0], 101: "", 102: "only page", 103: ""}
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = {r.page_id: r for r in htmltext.main_text(df, shard=25).collect()}
    assert {i: r.text for i, r in out.items()} == want
    assert all(r.n_chars == len(r.text) for r in out.values())
    assert htmltext.main_text(df.limit(0)).count() == 0


def test_host_runs_over_pages_with_and_without_article_markup(spark):
    """Every page counts in its host's runs: a menu known from marked pages goes, a print version's article stays."""
    rng = random.Random(8)
    menu = " ".join(f"menu{i}" for i in range(14))
    para = lambda: " ".join("w%d" % rng.randrange(10**6) for _ in range(18))
    arts = [para() for _ in range(6)]
    rows = [(i, "http://h.org/a", f"<div>{menu}</div><article><p>{a}</p><p>{arts[0]}</p></article><div>{para()}</div>", "t") for i, a in enumerate(arts)]
    plain = para()
    rows += [(10, "http://h.org/b", f"<div>{menu}</div><p>{plain}</p>", "t"), (11, "http://h.org/print", f"<div>{menu}</div><p>{arts[3]}</p>", "t")]
    rows += [(12, "http://other.org/b", f"<div>{menu}</div><p>{plain}</p>", "t")]
    out = {r.page_id: r.text for r in htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert out == {i: f"{a}\n\n{arts[0]}" for i, a in enumerate(arts)} | {10: plain, 11: arts[3], 12: f"{menu}\n\n{plain}"}


def test_covered_blocks_equal_brute_force():
    rng = random.Random(5)
    streams = [[" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 14))) for _ in range(rng.randint(0, 4))] for _ in range(12)]
    run = 4
    got = htmltext.covered_blocks(streams, run=run, share=0.0)
    tokens = [[t for b in bs for t in ["|", *b.split()]] + ["|"] for bs in streams]
    seen = {}
    for i, t in enumerate(tokens):
        for k in range(len(t) - run + 1):
            seen.setdefault(tuple(t[k : k + run]), set()).add(tuple(streams[i]))
    for i, t in enumerate(tokens):
        mark = [False] * len(t)
        for k in range(len(t) - run + 1):
            if len(seen[tuple(t[k : k + run])]) >= 2:
                mark[k : k + run] = [True] * run
        at = 0
        for j, b in enumerate(streams[i]):
            n = 1 + len(b.split())
            assert got[i][j] == pytest.approx(sum(mark[at : at + n]) / n)
            at += n
