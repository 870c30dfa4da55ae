"""op13: held-out accuracy, compressed sizes against plain zstandard, and the odd cases."""

import random

import pytest
import zstandard
from pyspark.sql import functions as F

from tallyspark.llm import quality
from tallyspark.llm.common import crc_mod

SYL = "th er on an re he in ed nd ha ou ti".split()


def corpus(n=400, seed=4):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice(SYL) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(30, 200))]
        bad = i % 3 == 0
        if bad:
            w = [x + rng.choice(["$$$", "###", "%%%"]) if j > len(w) // 4 else x for j, x in enumerate(w)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(not bad), 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_labels(spark, docs):
    rows, labels = corpus()
    held = crc_mod("doc_id", 5) == 0
    got = {r.doc_id: r for r in quality.quality(docs(rows), spark.createDataFrame(labels, LABELS), ~held, held).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert sum(got[i].predicted != q for i, q, _ in labels if got[i].held_out) <= 0.03 * len(rows) / 5
    good, bad = ([got[i].score for i, q, _ in labels if q == c] for c in (1, 0))
    assert sum(good) / len(good) > 0.9 and sum(bad) / len(bad) < 0.1


def test_held_out_labels_are_not_read(spark, docs):
    """Turning the held-out labels round changes no score; nor do lang, source or the order of the rows."""
    rows, labels = corpus(120)
    held = crc_mod("doc_id", 5) == 0
    ids = {r.doc_id for r in docs(rows).where(held).collect()}
    turned = [(i, 1 - q if i in ids else q, t) for i, q, t in labels]
    a, b = (sorted(map(tuple, quality.quality(d, spark.createDataFrame(x, LABELS), ~held, held).collect()))
            for d, x in ((docs(rows), labels), (docs(rows[::-1]).withColumn("lang", F.lit("zz")), turned)))
    assert a == b


def test_differences_against_plain_compression(spark, docs):
    rows, _ = corpus(60)
    rows += [(1000, "x" * 300_000), (1001, ""), (1002, None), (1003, "é" * 255 + "é"), (1003, "é" * 255 + "é")]
    made = {c: [("".join(t for _, t in rows[c:40:2] if t)).encode()[k * 100 : k * 100 + 9000] for k in range(2)] for c in (0, 1)}
    for r in quality.differences(docs(rows), made, {"doc_id": "long", "text": "string"}).collect():
        t, size = (r.text or "").encode(), {0: 0.0, 1: 0.0}
        for c in made:
            for d in made[c]:
                z = zstandard.ZstdCompressor(level=1, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False)
                size[c] += sum(len(z.compress(t[i : i + 512])) for i in range(0, len(t), 512)) / 2
        assert r.bytes == len(t) and r.difference == pytest.approx((size[0] - size[1]) / max(len(t), 1))


@pytest.mark.parametrize("labels, expected", [([], 0.5), ([(1, 1, 0), (2, 1, 0), (3, None, 0), (99, 0, 0)], 1.0), ([(1, 0, 0), (1, 0, 1)], 0.0)])
def test_missing_classes(spark, docs, labels, expected):
    d = docs([(i, "some words " * i) for i in range(1, 30)] + [(None, "words"), (40, None), (41, "")])
    known = [(i, q, t) for i, q, t in labels for _ in (0,)]
    many = [(i, known[0][1], 0) for i in range(1, 30)] + known if known else []
    got = [r.score for r in quality.quality(d, spark.createDataFrame(many, LABELS), F.lit(True)).collect()]
    assert len(got) == 32 and all(abs(s - expected) < 1e-3 for s in got)


def test_empty_texts_get_the_share_of_good_labels(spark, docs):
    rows, labels = corpus(200)
    fitted = quality.fit(docs(rows), spark.createDataFrame(labels, LABELS))
    got = quality.score(docs([(1, ""), (2, None), (2, None)]), fitted, {"doc_id": "long"}).collect()
    assert len(got) == 3 and {r.score for r in got} == {fitted["share"]} and 0.5 < fitted["share"] < 0.85


def test_no_documents(spark, docs):
    none = docs([(1, "a")]).where("doc_id = 2")
    assert quality.quality(none, spark.createDataFrame([], LABELS), F.lit(True)).collect() == []
