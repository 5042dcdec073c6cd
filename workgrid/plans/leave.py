"""Leave status per staff member and day (full-day / partial leave)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import FULL_DAY_MINUTES, Params
from ..functions.rules import is_leave_name, window_end, window_start
from ..operators.ranges import window_index
from ..operators.staff_lookups import WEEKDAYS, working_weekday_mask

LEAVE_COLUMNS = ("staff_name", "date", "is_full_day", "has_partial_leave", "partial_leave_hrs_per_day")
#: Type in which leave hours are added up and taken back.
HOURS_SUM = "decimal(38,20)"


def leave_rows(jobtask: DataFrame, jobtaskassignee: DataFrame, jobdetails: DataFrame) -> DataFrame:
    """Leave task x assignee rows with allocated minutes and the leave window."""
    lt = jobtask.where((F.col("is_deleted") == False) & is_leave_name("name")).select(  # noqa: E712
        F.col("remote_id").alias("_lt_id"), F.col("job_remote_id").alias("_lt_job"),
        F.col("start_date").alias("_lt_start"), F.col("due_date").alias("_lt_due"),
    )
    a = jobtaskassignee.where(F.col("allocated_minutes") > 0).select(
        F.col("job_task_id").alias("_a_task"), F.col("name").alias("staff_name"), "allocated_minutes"
    )
    jd = jobdetails.select(
        F.col("remote_id").alias("_jd_id"), F.col("start_date").alias("_jd_start"),
        F.col("due_date").alias("_jd_due"), F.col("completed_date").alias("_jd_done"),
    )
    return (
        lt.join(a, F.col("_a_task") == F.col("_lt_id"))
        .join(jd, F.col("_jd_id") == F.col("_lt_job"), "left")
        .select(
            "staff_name",
            "allocated_minutes",
            window_start("_lt_start", "_jd_start").alias("win_start"),
            window_end("_lt_due", "_jd_done", "_jd_due").alias("win_end"),
        )
    )


def weekday_counts(cal: DataFrame, params: Params) -> DataFrame:
    """(``_wc_i``, ``_wc_counts``) per calendar day: days up to it that are neither weekend nor holiday, by weekday.

    Its size is fixed by the date range.
    """
    i = F.datediff("date", F.lit(params.calendar_start)).cast("int").alias("_wc_i")
    days = cal.select(i, F.when(~F.col("weekend") & ~F.col("public_holiday"), F.col("weekday").cast("int")).alias("_dow"), F.lit(0).alias("_one"))
    so_far = Window.partitionBy("_one").orderBy("_wc_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.select("_wc_i", F.array(*[F.count_if(F.col("_dow") == k).over(so_far) for k in WEEKDAYS]).alias("_wc_counts"))


def with_workable_days(rows: DataFrame, workable_days: DataFrame, cal: DataFrame, params: Params) -> DataFrame:
    """Add ``_n_workable``: days from position ``_first`` to ``_last`` that the person works, as a difference of counts.

    Workable = no weekend, no public holiday, and a working weekday in the
    person's sheet (with duplicate sheet rows any TRUE counts, unlike the
    first-row lookup used for display columns).
    """
    counts = weekday_counts(cal, params)
    before = F.broadcast(counts.select((F.col("_wc_i") + 1).alias("_at_first"), F.col("_wc_counts").alias("_before")))
    until = F.broadcast(counts.select(F.col("_wc_i").alias("_at_last"), F.col("_wc_counts").alias("_until")))
    joined = (
        rows.join(working_weekday_mask(workable_days), F.col("staff_name") == F.col("_ww_staff"), "left")
        .join(before, F.col("_first") == F.col("_at_first"), "left")
        .join(until, F.col("_last") == F.col("_at_last"), "left")
    )
    zero = F.lit(0).cast("bigint")
    total = zero
    for k in range(len(WEEKDAYS)):
        days = F.get("_until", F.lit(k)) - F.coalesce(F.get("_before", F.lit(k)), zero)
        total = total + F.when(F.get("_ww_mask", F.lit(k)), days).otherwise(zero)
    return joined.withColumn("_n_workable", total).drop(
        "_ww_staff", "_ww_mask", "_at_first", "_at_last", "_before", "_until")


def leave_status(jobtask: DataFrame, jobtaskassignee: DataFrame, jobdetails: DataFrame, workable_days: DataFrame,
                 cal: DataFrame, params: Params) -> DataFrame:
    """Per (staff_name, date): any full-day leave, any partial leave, partial leave hours.

    minutes per day = allocated minutes / workable days of the leave window.

    A sweep over differences: every leave task adds its rate where its window
    starts and takes it back after its end, the running sums in day order are
    the state of the days up to the next change. What is shuffled are two rows
    per leave task; the days are exploded after it. Hours are added up as
    decimals, so that what is taken back is exactly what was added.
    """
    lo, hi = params.calendar_start, params.calendar_end
    rows = leave_rows(jobtask, jobtaskassignee, jobdetails)
    first, last = window_index("win_start", "win_end", lo, hi)
    windows = rows.select("staff_name", "allocated_minutes", first.alias("_first"), last.alias("_last")).where(F.col("_last") >= F.col("_first"))
    rated = with_workable_days(windows, workable_days, cal, params).withColumn(
        "mpd", F.col("allocated_minutes").cast("double") / F.nullif(F.col("_n_workable"), F.lit(0)).cast("double")
    )
    mpd = F.col("mpd")
    full = F.coalesce(mpd == FULL_DAY_MINUTES, F.lit(False))
    part = F.coalesce(mpd != FULL_DAY_MINUTES, F.lit(False))
    hours = F.when(part, (mpd / F.lit(60.0)).cast(HOURS_SUM)).otherwise(F.lit(0).cast(HOURS_SUM))

    def change(at, sign: int):
        return F.struct(
            at.alias("i"), F.lit(sign).alias("active"), (full.cast("int") * sign).alias("full"),
            (part.cast("int") * sign).alias("part"), (hours * sign).cast(HOURS_SUM).alias("hours"),
        )

    changes = rated.select("staff_name", F.explode(F.array(change(F.col("_first"), 1), change(F.col("_last") + 1, -1))).alias("c"))
    sums = [F.sum(f"c.{c}").cast(HOURS_SUM if c == "hours" else "bigint").alias(c) for c in ("active", "full", "part", "hours")]
    by_day = changes.groupBy("staff_name", F.col("c.i").alias("i")).agg(*sums)
    order = Window.partitionBy("staff_name").orderBy("i")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = by_day.select(
        "staff_name", "i", F.lead("i").over(order).alias("_next"),
        *[F.sum(c).over(so_far).alias(c) for c in ("active", "full", "part", "hours")],
    ).where(F.col("active") > 0)
    total = F.when(F.col("part") > 1, F.round(F.col("hours"), 12)).otherwise(F.col("hours")).cast("double")
    days = state.select("*", F.explode(F.sequence(F.col("i"), F.col("_next") - 1)).alias("_day"))
    return days.select(
        "staff_name", F.date_add(F.lit(lo), F.col("_day")).alias("date"),
        (F.col("full") > 0).alias("is_full_day"),
        (F.col("part") > 0).alias("has_partial_leave"),
        F.when(F.col("part") > 0, total).otherwise(F.lit(0.0)).alias("partial_leave_hrs_per_day"),
    )
