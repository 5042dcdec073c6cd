"""Range (theta) joins against the calendar, rewritten as explode + equi join.

A predicate such as ``cal.date BETWEEN t.start AND t.due`` plans as a
nested-loop join in Spark. Each row's window is instead clipped to the
calendar bounds and exploded into one row per day. That is a narrow
operator (no shuffle), produces exactly the rows the range join would keep,
and lets the day rows meet the calendar and other day-keyed tables through
ordinary equi joins.

A bound may be a date or a datetime. A calendar day is midnight, so the
first day of a window that starts after midnight is the next day, and the
last day is the day of its end.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_day(start) -> Column:
    """First calendar day that is not before ``start``."""
    at = _c(start).cast("timestamp_ntz")
    day = at.cast("date")
    return F.when(day.cast("timestamp_ntz") < at, F.date_add(day, 1)).otherwise(day)


def last_day(end) -> Column:
    """Last calendar day that is not after ``end``."""
    return _c(end).cast("timestamp_ntz").cast("date")


def window_index(start, end, lo: date, hi: date) -> tuple[Column, Column]:
    """Positions (from 0) of the first and last calendar day of a window; the last is smaller when it has none."""
    first = F.greatest(F.datediff(first_day(start), F.lit(lo)), F.lit(0))
    last = F.least(F.datediff(last_day(end), F.lit(lo)), F.lit((hi - lo).days))
    known = _c(start).isNotNull() & _c(end).isNotNull()
    return F.when(known, first).otherwise(F.lit(0)), F.when(known, last).otherwise(F.lit(-1))


def clipped_days(start, end, lo: date, hi: date) -> Column:
    """Array of the days in [start, end] ∩ [lo, hi]; NULL when empty or a bound is NULL."""
    s, e = first_day(start), last_day(end)
    cs = F.greatest(s, F.lit(lo))
    ce = F.least(e, F.lit(hi))
    ok = s.isNotNull() & e.isNotNull() & (cs <= ce)
    return F.when(ok, F.sequence(cs, ce, F.expr("INTERVAL 1 DAY")))


def explode_days(df: DataFrame, start, end, lo: date, hi: date, out: str = "date") -> DataFrame:
    """One row per day of each row's window inside the calendar (rows with no such day vanish)."""
    return df.withColumn(out, F.explode(clipped_days(start, end, lo, hi)))
