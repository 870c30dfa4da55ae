"""Property: a generated calendar date in a generated spelling normalizes to that date, and to nothing in the other formats."""

import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyspark.functions import dates as D

FORMATS = ("rpp_range", "jp_range", "datetime_jp", "simple")
WIDE = str.maketrans("0123456789", "０１２３４５６７８９")

# spelling -> (text of a date, the formats that read it)
SPELLINGS = {
    "padded": (lambda d: f"{d.year}年{d.month:02d}月{d.day:02d}日", {"rpp_range", "jp_range"}),
    "range": (lambda d: f"{d.year}年{d.month:02d}月{d.day:02d}日～2030年01月01日", {"rpp_range", "jp_range"}),
    "wordy": (lambda d: f"期間 {d.year}年{d.month:02d}月{d.day:02d}日 まで", {"rpp_range", "jp_range"}),
    "slash": (lambda d: f"{d.year}/{d.month}/{d.day} 9:05", {"datetime_jp"}),
    "iso": (lambda d: d.isoformat(), {"simple"}),
    "iso_time": (lambda d: d.isoformat() + " 00:00:00", set()),
    "none": (lambda d: "合計", set()),
    "blank": (lambda d: "  ", set()),
}

dates = st.dates(datetime.date(2000, 1, 1), datetime.date(2039, 12, 31))
cases = st.lists(st.tuples(dates, st.sampled_from(sorted(SPELLINGS))), min_size=60, max_size=60)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cases)
def test_known_dates_come_back(spark, batch):
    df = spark.createDataFrame([(i, SPELLINGS[k][0](d)) for i, (d, k) in enumerate(batch)], "i int, s string")
    got = {r.i: r for r in df.select("i", *[D.normalize_date("s", f).alias(f) for f in FORMATS]).collect()}
    for i, (d, k) in enumerate(batch):
        for f in FORMATS:
            assert got[i][f] == (d.isoformat() if f in SPELLINGS[k][1] else None), (d, k, f)


def test_unpadded_and_full_width_spellings(spark):
    texts = {"2026年7月3日": (None, "2026-07-03", None, None), "2026年13月45日": ("2026-13-45", "2026-13-45", None, None),
             "2026年7月3日".translate(WIDE): (None, "２０２６-0７-0３", None, None), "": (None,) * 4}
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select("s", *[D.normalize_date("s", f).alias(f) for f in FORMATS])
    assert {r.s: tuple(r)[1:] for r in rows.collect()} == texts
