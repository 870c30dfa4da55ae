"""Daily totals from file heads: the same cells whatever the head's size, the line ends and the file's length."""

import pytest

from tallyspark.sources import csv_reports as C

FILES = {
    "plain": (b"a,b,c,d,e,f\nd,x,y,5,7,z\nmore\n", (6, "5", "7")),
    "crlf": (b"a,b,c,d,e\r\nd,x,y,5,7\r\nmore,\r\n", (5, "5", "7")),
    "cr": (b"a,b,c,d,e\rd,x,y,5,7\rmore", (5, "5", "7")),
    "no end": (b"a,b,c,d,e\nd,x,y,5,7", (5, "5", "7")),
    "ends with it": (b"a,b,c,d,e\nd,x,y,5,7\n", (5, "5", "7")),
    "ends with crlf": (b"a,b,c,d,e\r\nd,x,y,5,7\r\n", (5, "5", "7")),
    "short row": (b"a,b\nd\n", (2, "", "")),
    "empty row": (b"a,b,c\n\nx,y,z", (3, "", "")),
    "quotes": (b'"a,a",b\n"d,d",x,y,"5","7,0"\n', (2, "5", "7,0")),
    "bom": ("﻿日,b\n犬,x,y,1,2\n".encode(), (2, "1", "2")),
    "long header": (b",".join(b"column%d" % i for i in range(400)) + b"\nd,x,y,8,9\n" + b"m\n" * 5000, (400, "8", "9")),
    "only header": (b"a,b,c\n", None), "nothing": (b"", None), "one line": (b"a,b", None),
}


@pytest.mark.parametrize("head_bytes", [1, 9, 10, 11, 20, 21, 22, 64, 1 << 16])
def test_heads(spark, head_bytes):
    df = spark.createDataFrame([(k, bytearray(v[0])) for k, v in FILES.items()], "path string, content binary")
    got = {r.path: (r.n_cols, r.clicks_text, r.cost_text) for r in C.daily_totals_from_heads(df, "UTF-8", head_bytes).collect()}
    assert got == {k: v[1] for k, v in FILES.items() if v[1]}


def test_lines_are_not_exploded(spark):
    """One generator, over the array that holds a file's first lines once."""
    df = spark.createDataFrame([("p", bytearray(b"a\nb\n"))], "path string, content binary")
    plan = C.daily_totals_from_heads(df, "UTF-8")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1 and "Exchange" not in plan and "posexplode" not in plan
