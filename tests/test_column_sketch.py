"""The one-scan profile: samples by hash, approximate distinct counts, no exploded cells."""

import hashlib

from pyspark.sql import functions as F

from tallyspark.operators.profile import column_profile, column_sketch


def test_sketch_against_exact(spark):
    n = 20_000
    df = spark.range(n).select(F.col("id"), (F.col("id") % 700).cast("string").alias("k"), F.when(F.col("id") % 3 == 0, F.lit(" ")).alias("blank"),
                               F.when(F.col("id") % 3 == 1, F.lit("hot")).otherwise(F.concat(F.lit("x "), F.col("id").cast("string"))).alias("skewed"))
    got = {r.column: r for r in column_sketch(df).collect()}
    exact = {r.column: r for r in column_profile(df).collect()}
    for c, e in exact.items():
        g = got[c]
        assert (g.type, g.rows, g.non_blank, g.numeric, g.min_value, g.max_value) == (e.type, e.rows, e.non_blank, e.numeric, e.min_value, e.max_value)
        assert abs(g.approx_distinct - e.distinct_values) <= 0.06 * max(e.distinct_values, 1)
        values = {r[0] for r in df.select(F.col(c).cast("string")).distinct().collect() if r[0] is not None}
        least = {}
        for h, v in sorted((hashlib.md5(v.encode()).hexdigest(), v) for v in values):
            least.setdefault(int(h[0], 16) // 2, v)
        assert g.samples == [least[k] for k in sorted(least)]


def test_nothing_is_exploded_or_sent_by_value(spark):
    plan = column_sketch(spark.range(10).withColumn("v", F.lit("a")))._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Aggregate", 1)[1]
    assert "Exchange hashpartitioning" not in plan and "Generate" not in below


def test_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a"), (None, None)], "n int, `a.b` string").toDF("n", "s")
    got = {r.column: (r.rows, r.non_blank, r.approx_distinct, r.samples) for r in column_sketch(df).collect()}
    assert got == {"n": (2, 0, 0, []), "s": (2, 1, 1, ["a"])}
    assert column_sketch(df.where("false")).collect() == []
