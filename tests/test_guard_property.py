"""Property: prices made from known numbers, written in many ways, are blanked exactly at the stated thresholds."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyspark.operators import guard as G

SKU, KW, GUIDE, DATE = "商品管理番号", "キーワード", "目安CPC", "日付"

# ways to write an integer that all read as that number on the new side
WRITE = (str, lambda n: f"{n:,}", lambda n: f"  {n} ", lambda n: f"{n}.0", lambda n: f"{n}e0", lambda n: f"+{n}")
# texts that are no number, or not a number: never blanked
NOT_PRICES = ("", "abc", "nan", "--5", "1 2", "12円")

# prior, distance from the exact limit of a spike, way to write it; limit: three times the prior and 150 above it
boundary = st.tuples(st.integers(40, 900), st.integers(-40, 40), st.sampled_from(range(len(WRITE))))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(boundary, min_size=80, max_size=80))
def test_blanked_only_beyond_both_limits(spark, batch):
    hist = [(f"s{i}", "k", str(p), "2026-07-13") for i, (p, _, _) in enumerate(batch)]
    # the limit is the larger of the two thresholds; a price on the limit stays
    new = [(f"s{i}", "k", WRITE[w](max(3 * p, p + 150) + off), "2026-07-14") for i, (p, off, w) in enumerate(batch)]
    schema = f"`{SKU}` string, `{KW}` string, `{GUIDE}` string, `{DATE}` string"
    out, _ = G.spike_guard(spark.createDataFrame(new, schema), spark.createDataFrame(hist, schema), "2026-07-15")
    got = {r[SKU]: r[GUIDE] for r in out.collect()}
    for i, ((p, off, _), row) in enumerate(zip(batch, new)):
        assert got[f"s{i}"] == ("" if off > 0 else row[2]), (p, row)


def test_no_price_and_small_prior_are_kept(spark):
    schema = f"`{SKU}` string, `{KW}` string, `{GUIDE}` string, `{DATE}` string"
    hist = [("a", "k", "50", "2026-07-13"), ("small", "k", "39", "2026-07-13"), ("nan", "k", "nan", "2026-07-13")]
    new = [("a", "k", t, "2026-07-14") for t in NOT_PRICES] + [(s, "k", "99999", "2026-07-14") for s in ("small", "nan", "unknown")]
    out, _ = G.spike_guard(spark.createDataFrame(new, schema), spark.createDataFrame(hist, schema), "2026-07-15")
    assert sorted((r[SKU], r[GUIDE]) for r in out.collect()) == sorted((r[0], r[2]) for r in new)
