"""Per-person lookups with a fixed bound, shaped for joining before days are exploded.

Working weekdays (7 per person) and monthly sheet values (at most one per
calendar month) are folded into one row per person: an array indexed by
weekday, or by month number. Joined once per task (or once per person for
the staff grid), the days read them by position instead of joining on
(staff, weekday) or (staff, month), so the large day-level data is not
shuffled for these lookups. The arrays are bounded by 7 and by the number of
calendar months, never by the data size.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import first_per_key
from .sparse import spread

WEEKDAYS = tuple(range(1, 8))  # Sunday = 1


def working_weekday_mask(workable_days: DataFrame, out: str = "_ww_mask") -> DataFrame:
    """(``_ww_staff``, mask): weekday k works if any sheet row for it says TRUE (an EXISTS rule)."""
    dow = F.col("day_of_week").cast("int")
    works = F.col("working_day") == True  # noqa: E712
    return workable_days.groupBy(F.col("staffname").alias("_ww_staff")).agg(
        F.array(*[F.coalesce(F.max(F.when((dow == k) & works, F.lit(True))), F.lit(False)) for k in WEEKDAYS]).alias(out)
    )


def weekday_arrays(workable_days: DataFrame, payload: Sequence[str], prefix: str = "_wk_") -> DataFrame:
    """(``_wk_staff``, one 7-element array per payload column): the first sheet row per (staff, weekday)."""
    src = workable_days.select("staffname", F.col("day_of_week").cast("int").alias("day_of_week"), *payload)
    first = first_per_key(src, ["staffname", "day_of_week"], list(payload))
    dow = F.col("day_of_week")
    return first.groupBy(F.col("staffname").alias(f"{prefix}staff")).agg(
        *[F.array(*[F.max(F.when(dow == k, F.col(c))) for k in WEEKDAYS]).alias(f"{prefix}{c}") for c in payload]
    )


def _sheet_rows(df: DataFrame, staff_col: str, month_col: str, payload: Sequence[str]) -> DataFrame:
    """(``_mm_staff``, ``_mm_on``, payload): the first sheet row per (staff, date)."""
    src = df.select(F.col(staff_col).alias("_mm_staff"), F.col(month_col).cast("date").alias("_mm_on"), *payload)
    return first_per_key(src.where(F.col("_mm_on").isNotNull()), ["_mm_staff", "_mm_on"], list(payload))


def month_number(on: Column, lo: date) -> Column:
    """Number of a day's month, from 0 for the month of ``lo``."""
    return (F.year(on) * 12 + F.month(on) - (lo.year * 12 + lo.month)).cast("int")


def month_array(df: DataFrame, staff_col: str, month_col: str, payload: Sequence[str], lo: date, hi: date,
                out: str) -> DataFrame:
    """(``_mm_staff``, array of struct(payload) by month number): the sheet row dated on each month's first day, or NULL."""
    at = month_number(F.col("_mm_on"), lo)
    last = (hi.year - lo.year) * 12 + hi.month - lo.month
    rows = _sheet_rows(df, staff_col, month_col, payload).where(
        (F.dayofmonth("_mm_on") == 1) & F.col("_mm_on").between(F.lit(lo.replace(day=1)), F.lit(hi)))
    listed = rows.groupBy("_mm_staff").agg(F.array_sort(F.collect_list(F.struct(at.alias("i"), F.struct(*payload).alias("x")))).alias("_s"))
    empty = F.lit(None).cast(rows.select(F.struct(*payload)).schema[0].dataType)
    return listed.select("_mm_staff", spread(F.col("_s"), F.lit(0), F.lit(last), lambda s: s["x"], lambda i: empty).alias(out))


def day_list(df: DataFrame, staff_col: str, day_col: str, payload: Sequence[str], lo: date, hi: date, out: str) -> DataFrame:
    """(``_mm_staff``, array of struct(i, x struct(payload)) in day order): the sheet rows by calendar position of their date."""
    at = F.datediff("_mm_on", F.lit(lo)).alias("i")
    rows = _sheet_rows(df, staff_col, day_col, payload).where(F.col("_mm_on").between(F.lit(lo), F.lit(hi)))
    return rows.groupBy("_mm_staff").agg(F.array_sort(F.collect_list(F.struct(at, F.struct(*payload).alias("x")))).alias(out))


def at_weekday(array_col: str, weekday: Column) -> Column:
    return F.try_element_at(F.col(array_col), weekday)

