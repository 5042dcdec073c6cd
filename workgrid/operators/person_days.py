"""Per-person day arrays over the calendar with running counts, joined once per task.

One row per person and calendar day meets the leave rows once, on (staff, day).
Running sums in day order then count the person's work days without leave and
with partial leave up to every day, and fold into one array per person, whose
length is the number of calendar days. A task joins its person's array once;
a count over its window is the difference of two elements.

An element packs the day's position, the two counts and the day's leave code
into a long, so sorting the array puts it in day order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Params
from .staff_lookups import working_weekday_mask

#: Leave codes of a day: bits for partial and for full-day leave.
PARTIAL, FULL = 1, 2
_CODE_BITS, _COUNT_BITS = 2, 20


def person_days(cal: DataFrame, workable_days: DataFrame, leave: DataFrame, params: Params) -> DataFrame:
    """(``_pd_staff``, ``_pd_days``, ``_pd_partial``) per person with a working-day sheet or leave.

    ``_pd_days``: per calendar day the packed position, counts and leave code.
    ``_pd_partial``: leave hours of the work days with partial leave, in day order.
    A work day is a working weekday of the person that is no holiday and has
    no full-day leave; a person without a sheet has none.
    """
    at = F.datediff("date", F.lit(params.calendar_start)).cast("int")
    lv = leave.where(F.col("staff_name").isNotNull()).select(
        F.col("staff_name").alias("_lv_staff"), at.alias("_lv_i"), "is_full_day", "has_partial_leave", "partial_leave_hrs_per_day")
    names = lv.select("_lv_staff").distinct()
    people = working_weekday_mask(workable_days).where(F.col("_ww_staff").isNotNull()).join(
        names, F.col("_ww_staff") == F.col("_lv_staff"), "full_outer"
    ).select(F.coalesce("_ww_staff", "_lv_staff").alias("_pd_staff"), "_ww_mask")
    dow = F.when(F.col("weekend") | F.col("public_holiday"), F.lit(0)).otherwise(F.col("weekday").cast("int"))
    weekdays = cal.select(at.alias("_c_i"), dow.alias("_dow"))
    grid = people.select("*", F.explode(F.sequence(F.lit(0), F.lit(params.calendar_days - 1))).alias("i"))
    days = grid.join(F.broadcast(weekdays), F.col("i") == F.col("_c_i")).join(
        lv, (F.col("_pd_staff") == F.col("_lv_staff")) & (F.col("i") == F.col("_lv_i")), "left")
    full, part = F.coalesce("is_full_day", F.lit(False)), F.coalesce("has_partial_leave", F.lit(False))
    works = (F.col("_dow") > 0) & F.coalesce(F.get("_ww_mask", F.greatest(F.col("_dow") - 1, F.lit(0))), F.lit(False))
    days = days.select("_pd_staff", "i", (works & ~full).alias("_free"), part.alias("_part"),
                       (part.cast("int") * PARTIAL + full.cast("int") * FULL).alias("_code"), "partial_leave_hrs_per_day")
    so_far = Window.partitionBy("_pd_staff").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    count = lambda c: F.sum(c.cast("int")).over(so_far)
    days = days.select("*", count(F.col("_free") & ~F.col("_part")).alias("_plain"), count(F.col("_free") & F.col("_part")).alias("_partly"))
    packed = F.col("i").cast("bigint")
    for c, bits in (("_plain", _COUNT_BITS), ("_partly", _COUNT_BITS), ("_code", _CODE_BITS)):
        packed = F.shiftleft(packed, bits) + F.col(c)
    hours = F.when(F.col("_free") & F.col("_part"), F.struct("i", F.col("partial_leave_hrs_per_day").alias("hours")))
    return days.groupBy("_pd_staff").agg(
        F.sort_array(F.collect_list(packed)).alias("_pd_days"),
        F.transform(F.sort_array(F.collect_list(hours)), lambda x: x["hours"]).alias("_pd_partial"),
    )


def leave_code(i: Column) -> Column:
    """Leave code of the calendar day at position ``i``; NULL for a person without days."""
    return F.get("_pd_days", i).bitwiseAND(F.lit((1 << _CODE_BITS) - 1)).cast("int")


def _until(i: Column, shift: int) -> Column:
    count = F.shiftright(F.get("_pd_days", F.greatest(i, F.lit(0))), shift).bitwiseAND(F.lit((1 << _COUNT_BITS) - 1))
    return F.when(i < 0, F.lit(0).cast("bigint")).otherwise(F.coalesce(count, F.lit(0).cast("bigint")))


def _between(first: Column, last: Column, shift: int) -> Column:
    return F.when(last >= first, _until(last, shift) - _until(first - 1, shift)).otherwise(F.lit(0).cast("bigint"))


def plain_days(first: Column, last: Column) -> Column:
    """Work days without leave from position ``first`` to ``last``."""
    return _between(first, last, _CODE_BITS + _COUNT_BITS)


def partial_days(first: Column, last: Column) -> Column:
    """Work days with partial leave from position ``first`` to ``last``."""
    return _between(first, last, _CODE_BITS)


def partial_hours(first: Column, last: Column) -> Column:
    """Leave hours of the work days with partial leave from position ``first`` to ``last``."""
    start = _until(first - 1, _CODE_BITS).cast("int") + 1
    hours = F.slice("_pd_partial", start, partial_days(first, last).cast("int"))
    return F.coalesce(F.aggregate(hours, F.lit(0.0), lambda s, h: s + F.coalesce(h, F.lit(0.0))), F.lit(0.0))
