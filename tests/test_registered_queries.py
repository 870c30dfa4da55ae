"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tallyspark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _rows(pdf):
    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        if isinstance(v, float):
            return repr(round(v, 6))
        return str(v.item() if hasattr(v, "item") else v)
    cols = sorted(pdf.columns)
    return sorted("|".join(norm(r[c]) for c in cols) for r in pdf.to_dict("records"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["sku", "sku_system", "first_order_date", "last_order_date", "total_sales", "total_qty"]
    df.collect()


def test_oracle_coverage():
    assert not set(QUERIES) - set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    want = con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
