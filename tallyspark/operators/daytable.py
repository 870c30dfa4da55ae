"""Values per report day as a lookup inside the scan stage.

"Is this row's day loaded already", "which file has this day" and "is this day replaced" need one value
per day.  Days are few (a calendar), rows are many: so the days become a map year -> array indexed by
month and day, a scalar subquery that every task gets, and rows are tested where they are read -- no
join, no exchange of the rows by date, no hot day.

Its size is checked, not assumed: a year takes 10,000 cells (impossible days such as ``2026-13-45`` have
their cell too, as report text is compared unchecked), at most ``MAX_YEARS`` years, and texts that
are no ASCII day (full-width digits) go to a side map of at most ``MAX_ODD``.  Beyond either bound
``day_table`` gives None and the callers join.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.session import materialized

MAX_YEARS, MAX_ODD = 400, 1000


def _cell(text: Column) -> Column:
    """(year, month and day as one number, text) of a normalized day; no year if it is not ``YYYY-MM-DD`` in ASCII digits."""
    y, md = F.substring(text, 1, 4).try_cast("int"), F.concat(F.substring(text, 6, 2), F.substring(text, 9, 2)).try_cast("int")
    plain = (F.length(text) == 10) & y.isNotNull() & md.isNotNull()
    return F.struct(F.when(plain, y).alias("y"), F.when(plain, md).alias("md"), text.alias("t"))


def _with_cell(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``__day``; a generator, so the text is computed once whatever refers to it later."""
    return df.select("*", F.explode(F.transform(F.array(text), _cell)).alias("__day"))


class DayTable(NamedTuple):
    years: Column       # map: year -> array of values, at month * 100 + day
    odd: Column         # map: other text -> value

    def rows(self, df: DataFrame, text: Column | str, keep) -> DataFrame:
        """Rows of ``df`` for whose day (normalized text) ``keep`` of its value holds; the value is NULL for a day without one."""
        t = F.col(text) if isinstance(text, str) else text
        day = F.col("__day")
        value = F.when(day["y"].isNull(), F.try_element_at(self.odd, day["t"])).otherwise(F.get(F.try_element_at(self.years, day["y"]), day["md"]))
        return _with_cell(df, t).where(keep(value)).drop("__day")


def day_table(days: DataFrame, text: str, value: Column | str | None = None) -> DayTable | None:
    """Table of ``days`` (one row a day: normalized text and a value, 1 if not given); None when it is too big to hand out."""
    v = F.lit(1).cast("bigint") if value is None else value if isinstance(value, Column) else F.col(value)
    t = F.col(text)
    days = materialized(_with_cell(days.where(t.isNotNull()), t).select("__day.*", v.alias("v")))
    kind = days.schema["v"].dataType.simpleString()
    years, odd = days.agg(F.count_distinct("y"), F.count_if(F.col("y").isNull())).first()
    if years > MAX_YEARS or odd > MAX_ODD:
        return None
    plain = days.where("y is not null")
    cells = plain.select("y", "md", "v").unionAll(plain.select("y").distinct().select("y", F.explode(F.sequence(F.lit(0), F.lit(9999))).alias("md"), F.lit(None).cast(kind)))
    cells = cells.groupBy("y", "md").agg(F.max("v").alias("v"))
    rows = cells.groupBy("y").agg(F.transform(F.sort_array(F.collect_list(F.struct("md", "v"))), lambda x: x["v"]).alias("a"))
    empty_years, empty_odd = F.create_map().cast(f"map<int,array<{kind}>>"), F.create_map().cast(f"map<string,{kind}>")
    return DayTable(rows.agg(F.coalesce(F.map_from_entries(F.collect_list(F.struct("y", "a"))), empty_years)).scalar(),
                    days.where("y is null").agg(F.coalesce(F.map_from_entries(F.collect_list(F.struct("t", "v"))), empty_odd)).scalar())
