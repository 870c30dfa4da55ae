"""Column cleaning (P1-P4), catalog helpers (K6, K7, S15) and the append sink (K1)."""

import pytest

from tallyspark.functions.text import clean_column_name, sanitize_columns
from tallyspark.sources import catalog as CAT
from tallyspark.sources.sinks import append_raw


@pytest.mark.parametrize("raw,clean", [
    ("CTR(%)", "CTR"), ("CTR（%）", "CTR"), ("受注番号(確定後)", "受注番号確定後"),
    ("CVR（転換率）-合計-", "CVR転換率_合計"), ("CVR(合計12時間)(%)", "CVR合計12時間pct"),
    ("CVR(合記12時間)(%)", "CVR合記12時間"), ("売上件数(合計720時間)", "売上件数合計720時間"), ("a b/c", "ab_c"),
])
def test_clean_names(raw, clean):
    assert clean_column_name(raw) == clean


def test_corrected_spelling_is_opt_in():
    assert clean_column_name("CVR(合計12時間)(%)", fix_spellings=True) == "CVR合計12時間"


def test_sanitize_drops_blank_and_refuses_collisions(spark):
    df = spark.createDataFrame([("1", "2", "3")], "`CTR(%)` string, `()` string, x string")
    assert sanitize_columns(df).columns == ["CTR", "x"]
    dup = spark.createDataFrame([("1", "2")], "`CTR(%)` string, `CTR（%）` string")
    with pytest.raises(ValueError):
        sanitize_columns(dup)


def test_catalog_helpers(spark):
    spark.createDataFrame([("a", "1")], "sku string, v string").write.saveAsTable("orders_t")
    assert CAT.add_column_if_missing(spark, "orders_t", "注文時間")
    assert not CAT.add_column_if_missing(spark, "orders_t", "注文時間")
    assert spark.table("orders_t").columns == ["sku", "v", "注文時間"]
    CAT.create_or_replace_view(spark, "orders_v", "orders_t")
    CAT.create_or_replace_view(spark, "orders_v", "orders_t")
    assert spark.table("orders_v").count() == 1
    empty = CAT.table_or_empty(spark, "no_such_table", "k string")
    assert empty.count() == 0 and empty.columns == ["k"]


def test_append_narrows_to_target_and_blanks(spark, tmpdir_path):
    path = f"{tmpdir_path}/raw_item"
    first = spark.createDataFrame([("2026-07-13", "a", None)], "`対象日` string, `商品管理番号` string, `CTR(%)` string")
    append_raw(spark, first, path, "対象日")
    second = spark.createDataFrame([("2026-07-14", "b", "nan", "new")],
                                   "`対象日` string, `商品管理番号` string, `CTR(%)` string, extra string")
    append_raw(spark, second, path, "対象日")
    t = spark.read.parquet(path)
    assert sorted(c for c in t.columns if c != "pdate") == ["CTR", "商品管理番号", "対象日"]   # new column dropped
    assert sorted((r["対象日"], r.CTR) for r in t.collect()) == [("2026-07-13", ""), ("2026-07-14", "")]
    assert append_raw(spark, second.where("false"), path, "対象日") == {"written": 0}


def test_ustrip_matches_python_strip(spark):
    from tallyspark.functions.text import ustrip
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()] + ["​", "﻿"]   # last two: not spaces
    texts = [f"{w}a b{w}" for w in spaces] + [f"{w}{w}x{w}" for w in spaces]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: r.x for r in df.select("i", ustrip("s").alias("x")).collect()}
    assert all(got[i] == t.strip() for i, t in enumerate(texts))
