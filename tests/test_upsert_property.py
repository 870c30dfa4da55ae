"""Property: replace-by-date leaves every non-target day untouched and puts
exactly the staged rows on target days, whatever spelling the target uses."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyspark.operators import upsert as U

DAYS = ["2026-07-0%d" % i for i in range(1, 8)]


def spell(day, jp):
    y, m, d = day.split("-")
    one = f"{y}年{m}月{d}日"
    return f"{one}～{one}" if jp else day


target_rows = st.lists(st.tuples(st.sampled_from(DAYS), st.booleans(), st.integers(0, 99)), max_size=25)
staged_rows = st.lists(st.tuples(st.sampled_from(DAYS), st.integers(100, 199)), max_size=10)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target_rows, staged_rows)
def test_replace_by_date_property(spark, trows, srows):
    schema = "`日付` string, v string"
    target = spark.createDataFrame([(spell(d, jp), str(v)) for d, jp, v in trows] + [("壊れた", "x")], schema)
    staged = spark.createDataFrame([(d, str(v)) for d, v in srows], schema)
    new, rejected = U.replace_by_date(target, staged)
    got = Counter((r["日付"], r.v) for r in new.collect())
    staged_days = {d for d, _ in srows}
    want = Counter([(spell(d, jp), str(v)) for d, jp, v in trows if d not in staged_days] + [("壊れた", "x")]
                   + [(d, str(v)) for d, v in srows])
    assert got == want and rejected.count() == 0
