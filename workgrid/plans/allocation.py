"""Key table of task assignees and the allocation-by-day table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BILLABLE, CATEGORY_BILLABLE, JOB_COMPLETED_STATE, NOT_BILLABLE, Params
from ..functions.rules import task_category
from ..operators.lookup import first_per_key
from ..operators.person_days import leave_code
from ..operators.ranges import window_index
from ..operators.sparse import inside, spread
from ..operators.staff_lookups import at_weekday, weekday_arrays
from .dims import CALENDAR_COLUMNS, first_contained_type

KEY_COLUMNS = (
    "job_task_staff_id", "job_id", "staff_name", "task_name", "client_name", "job_name", "task_category", "task_type1",
)

# Columns of the task details that the day rows read.
DETAIL_COLUMNS = (
    "job_task_staff_id", "start_date_adjusted", "due_date_adjusted", "is_task_a_leave", "initial_avg_mins_per_work_day",
    "avg_mins_per_work_day_without_leave", "avg_mins_per_work_day_with_leaves",
    "avg_remain_mins_per_remain_workday_without_leave", "avg_worked_mins_per_prior_days_with_leave",
    "avg_worked_mins_per_prior_days_without_leave", "is_task_within_allo_time_imp",
)

ALLOCATION_COLUMNS = CALENDAR_COLUMNS + KEY_COLUMNS + (
    "is_client", "is_billable", "billable_selector", "start_date_adjusted", "due_date_adjusted", "is_workable_day",
    "is_date_between_task_days", "is_date_between_today_and_due", "is_date_between_start_and_today",
    "is_task_a_leave", "is_full_day_leave", "admin_task_to_be_removed", "is_staff_workable_day_of_week",
    "is_day_with_a_leave", "initial_allo_hrs_per_work_day_kpi01", "allo_hrs_per_workday_without_leave_kpi02",
    "allo_hrs_per_workday_with_leave_kpi03", "allo_hrs_per_remaining_work_day_with_leave_kpi04",
    "allo_hrs_per_remaining_work_day_without_leave_kpi05", "initial_allo_hrs_per_prior_work_days_with_leave",
    "act_allo_hrs_per_prior_work_days_with_leave_kpi06", "act_allo_hrs_per_prior_work_days_without_leave_kpi07",
    "is_task_within_allo_time", "is_job_complete", "recorded_task_hours", "allo_hrs_per_work_day_leave",
    "allo_hrs_per_work_day_adj_leaves_remain_days_fin02", "allo_hrs_per_work_day_adj_leaves_prior_days_fin03",
    "allo_hrs_per_work_day_adj_leaves_fin01", "allo_hrs_per_workable_day_final_output",
)


def key_rows(details: DataFrame, keys_time: DataFrame, jobs: DataFrame, type_pairs: DataFrame,
             params: Params, details_unique: bool = False) -> DataFrame:
    """Every (task assignee id, job, staff) seen in task details or timesheets, with labels and the job's state.

    Task name comes from task details, client and job name from the one-row-
    per-job lookup, and the first contained task type from the containment
    pairs of the distinct task names. Keys are dealt by their job once, for
    their DISTINCT and the job lookup; the id comes last, so that readers who
    join on it find the rows dealt by it.
    """
    keys = (
        details.select("job_task_staff_id", "job_id", "staff_name")
        .unionByName(keys_time.select("job_task_staff_id", "job_id", "staff_name"))
        .repartition("job_id")
        .distinct()
    )
    jt_src = details.select("job_task_staff_id", "task_name") if details_unique else first_per_key(
        details, ["job_task_staff_id"], ["task_name"])
    t1 = first_contained_type(type_pairs).select(F.col("task_name").alias("_t1_name"), "task_type1")
    jt = jt_src.join(t1, F.col("_t1_name") == F.col("task_name"), "left").select(
        F.col("job_task_staff_id").alias("_jt_id"), "task_name", "task_type1"
    )
    j = jobs.select(F.col("job_id").alias("_j_id"), "client_name", "job_name", "job_state")
    df = keys.join(j, F.col("_j_id") == F.col("job_id"), "left").join(
        jt, F.col("_jt_id") == F.col("job_task_staff_id"), "left"
    )
    return df.select(
        "job_task_staff_id", "job_id", "staff_name", "task_name", "client_name", "job_name",
        task_category(F.col("task_name"), F.col("client_name"), params).alias("task_category"),
        F.coalesce(F.col("task_type1"), F.col("task_name")).alias("task_type1"),
        "job_state",
    )


def job_task_staff(details: DataFrame, keys_time: DataFrame, jobs: DataFrame, type_pairs: DataFrame,
                   params: Params, details_unique: bool = False) -> DataFrame:
    """The key table: ``key_rows`` without the job's state."""
    return key_rows(details, keys_time, jobs, type_pairs, params, details_unique).select(*KEY_COLUMNS)


def recorded_task_hours(ts: DataFrame) -> DataFrame:
    """Recorded hours per (task assignee id, date)."""
    return ts.groupBy("job_task_staff_id", F.col("date").cast("date").alias("date")).agg(
        (F.sum("recorded_minutes").cast("double") / F.lit(60.0)).alias("recorded_hrs")
    )


def hours_by_task(task_hours: DataFrame, lo, hi) -> DataFrame:
    """(``_th_id``, array of calendar position and recorded hours in day order) for the calendar's days.

    Recorded days per task are sparse and bounded by the calendar length, so
    they travel with the task row and are merged with its window instead of
    joining on (task, date).
    """
    th = task_hours.where(F.col("date").between(F.lit(lo), F.lit(hi)) & F.col("recorded_hrs").isNotNull())
    at = F.datediff("date", F.lit(lo)).alias("i")
    return th.groupBy(F.col("job_task_staff_id").alias("_th_id")).agg(
        F.sort_array(F.collect_list(F.struct(at, F.col("recorded_hrs").alias("hours")))).alias("_th_hours")
    )


def allocation_by_day(keys: DataFrame, details: DataFrame, cal: DataFrame, workable_days: DataFrame,
                      person_days: DataFrame, jobs: DataFrame, task_hours: DataFrame, params: Params,
                      by_month: bool = False) -> DataFrame:
    """One row per task assignee and calendar day of its window, with the day's KPIs.

    ``keys`` may carry the job's state (``key_rows``), else it is looked up.

    Per-task lookups (task details, job state, the person's weekday flags)
    join once per task; the window is then exploded per task (narrow; output
    size = total window days, never tasks x days), the calendar is a bounded
    broadcast, recorded hours come as a per-task list in day order and leave
    status as the person's per-day array; both are merged with the window's
    days, position by position, before it is exploded: no day row is shuffled.
    ``by_month`` deals the task rows by the month in which their window starts,
    so that a task writes day rows of few months; a large month is split.
    """
    lo, hi = params.calendar_start, params.calendar_end
    jt = details.select(*DETAIL_COLUMNS).withColumnsRenamed({"job_task_staff_id": "_jt_id", "is_task_a_leave": "_jt_leave"})
    # Per-task lookups (task details, job state) join before the days are
    # exploded: the shuffle moves one row per task, not one per task-day.
    # Lookups on one key stand together, so the rows are dealt by it once.
    # The person's weekday flags (first sheet row per weekday) as one array.
    if "job_state" not in keys.columns:
        j6 = jobs.select(F.col("job_id").alias("_j6_id"), "job_state")
        keys = keys.join(j6, F.col("_j6_id") == F.col("job_id"), "left")
    wk = weekday_arrays(workable_days, ["working_day"])
    kt = (
        keys.join(jt, F.col("_jt_id") == F.col("job_task_staff_id"))
        .where(F.col("start_date_adjusted").isNotNull())
        .join(hours_by_task(task_hours, lo, hi), F.col("_th_id") == F.col("job_task_staff_id"), "left")
        .join(wk, F.col("_wk_staff") == F.col("staff_name"), "left")
    )
    kt = kt.join(person_days, F.col("_pd_staff") == F.col("staff_name"), "left")
    # The window's days are put together with their leave code and recorded
    # hours before the explode, so a day row carries scalars, not arrays.
    first, last = window_index("start_date_adjusted", "due_date_adjusted", lo, hi)

    def one_day(i, hours):
        return F.struct(F.date_add(F.lit(lo), i).alias("date"), leave_code(i).alias("leave"), hours.alias("hours"))

    none = F.lit(None).cast("double")
    own = inside(F.col("_th_hours"), first, last)
    window = spread(own, first, last, lambda x: one_day(x["i"], x["hours"]), lambda i: one_day(i, none))
    if by_month:
        merged = kt.withColumn("_days", window).where(F.size("_days") > 0).drop("_pd_days", "_pd_partial", "_th_hours")
        kt = merged.withColumn("_month", F.trunc(F.get("_days", F.lit(0))["date"], "MM")).hint("rebalance", F.col("_month"))
        window = F.col("_days")
    days = kt.withColumn("_day", F.explode(window)).withColumn("date", F.col("_day.date"))
    calb = F.broadcast(cal.select(*[F.col(c).alias(f"_c_{c}") for c in CALENDAR_COLUMNS]))
    df = days.join(calb, F.col("date") == F.col("_c_date"))
    c = F.col
    d = c("date")
    as_of = F.lit(params.as_of)
    wk = c("_c_weekend")
    ph = c("_c_public_holiday")
    workable = ~wk & ~ph
    between = (d >= c("start_date_adjusted")) & (d <= c("due_date_adjusted"))
    working = F.coalesce(at_weekday("_wk_working_day", c("_c_weekday")), F.lit(False))
    code = F.coalesce(c("_day.leave"), F.lit(0))
    full, part = code >= 2, code % 2 == 1
    leave_task = F.coalesce(c("_jt_leave"), F.lit(False))
    admin = (c("task_type1") == params.admin_task) | (c("client_name") == params.admin_client)
    billable_cat = c("task_category") == CATEGORY_BILLABLE
    coach = c("task_type1") == params.coaching_type
    per_hour = lambda col: c(col) / F.lit(60.0)
    remaining_day = (d >= as_of) & billable_cat & workable & working & ~leave_task & ~full
    prior_day = (d < as_of) & billable_cat & workable & working & ~leave_task & ~full
    null_d = F.lit(None).cast("double")
    return df.select(
        d.alias("date"), *[c(f"_c_{x}").alias(x) for x in CALENDAR_COLUMNS[1:]],
        *KEY_COLUMNS,
        F.when(admin, F.lit(False)).otherwise(F.lit(True)).alias("is_client"),
        F.when(admin | coach, F.lit(False)).otherwise(F.lit(True)).alias("is_billable"),
        F.when(admin | coach, F.lit(NOT_BILLABLE)).otherwise(F.lit(BILLABLE)).alias("billable_selector"),
        "start_date_adjusted", "due_date_adjusted",
        workable.alias("is_workable_day"),
        between.alias("is_date_between_task_days"),
        (d >= as_of).alias("is_date_between_today_and_due"),
        (d < as_of).alias("is_date_between_start_and_today"),
        leave_task.alias("is_task_a_leave"),
        full.alias("is_full_day_leave"),
        ((c("task_name") == params.admin_task) & (d >= F.lit(params.admin_cutoff))).alias("admin_task_to_be_removed"),
        working.alias("is_staff_workable_day_of_week"),
        part.alias("is_day_with_a_leave"),
        F.when(workable & between & working & ~full & ~admin, per_hour("initial_avg_mins_per_work_day")).alias(
            "initial_allo_hrs_per_work_day_kpi01"),
        F.when(workable & between & working & ~part & ~leave_task & ~full & ~admin,
               per_hour("avg_mins_per_work_day_without_leave")).alias("allo_hrs_per_workday_without_leave_kpi02"),
        F.when(workable & between & working & part & ~leave_task & ~full & ~admin,
               per_hour("avg_mins_per_work_day_with_leaves")).alias("allo_hrs_per_workday_with_leave_kpi03"),
        F.when(remaining_day & part, per_hour("avg_mins_per_work_day_with_leaves")).alias(
            "allo_hrs_per_remaining_work_day_with_leave_kpi04"),
        F.when(remaining_day & ~part, per_hour("avg_remain_mins_per_remain_workday_without_leave")).alias(
            "allo_hrs_per_remaining_work_day_without_leave_kpi05"),
        F.when(prior_day & part, per_hour("avg_mins_per_work_day_with_leaves")).alias(
            "initial_allo_hrs_per_prior_work_days_with_leave"),
        F.when(prior_day & part, per_hour("avg_worked_mins_per_prior_days_with_leave")).alias(
            "act_allo_hrs_per_prior_work_days_with_leave_kpi06"),
        F.when(prior_day & ~part, per_hour("avg_worked_mins_per_prior_days_without_leave")).alias(
            "act_allo_hrs_per_prior_work_days_without_leave_kpi07"),
        c("is_task_within_allo_time_imp").alias("is_task_within_allo_time"),
        (F.coalesce(c("job_state"), F.lit("")) == JOB_COMPLETED_STATE).alias("is_job_complete"),
        c("_day.hours").alias("recorded_task_hours"),
        F.when(leave_task & workable & working, per_hour("initial_avg_mins_per_work_day")).alias(
            "allo_hrs_per_work_day_leave"),
        null_d.alias("allo_hrs_per_work_day_adj_leaves_remain_days_fin02"),
        null_d.alias("allo_hrs_per_work_day_adj_leaves_prior_days_fin03"),
        null_d.alias("allo_hrs_per_work_day_adj_leaves_fin01"),
        null_d.alias("allo_hrs_per_workable_day_final_output"),
    )


def billable_selectors(alloc: DataFrame) -> DataFrame:
    return alloc.select("billable_selector").distinct()
