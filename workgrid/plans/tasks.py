"""Job-task details per task assignee (allocations, workable days, leave, recorded time)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FULL_DAY_MINUTES, HOURS_PER_DAY, Params
from ..functions.keys import composite_id
from ..functions.rules import is_admin, is_leave_name, window_end, window_start
from ..operators.lookup import left_join_sparse
from ..operators.person_days import partial_days, partial_hours, plain_days
from ..operators.ranges import window_index

COUNT_COLUMNS = ("wdb_cnt", "tlh_hrs", "ttl_cnt", "wdl_cnt", "arwd_cnt", "rttl_cnt", "pwdl_cnt", "pttl_cnt")


def task_base(jobtask: DataFrame, jobtaskassignee: DataFrame, jobdetails: DataFrame, clientdetails: DataFrame,
              task_names: DataFrame, params: Params) -> DataFrame:
    """Task x assignee rows that are not deleted and have a named, non-excluded assignee."""
    jt = jobtask.where(F.col("is_deleted") == False).select(  # noqa: E712
        F.col("remote_id").alias("_jt_rid"), F.col("job_remote_id").alias("job_id"), F.col("uuid").alias("task_uuid"),
        F.col("name").alias("task_name"), "estimated_minutes", "actual_minutes",
        F.col("billable").alias("task_billable"), F.col("completed").alias("task_completed"),
        F.col("start_date"), F.col("due_date"),
    )
    n = F.col("name")
    keep = n.isNotNull()
    if params.excluded_task_staff:
        keep = keep & ~n.isin(*params.excluded_task_staff)
    jta = jobtaskassignee.where(keep).select(
        F.col("job_task_id").alias("_jta_task"), F.col("uuid").alias("staff_uuid"), F.col("name").alias("staff_name"),
        F.col("allocated_minutes").alias("task_allocated_mins"),
    )
    jd = jobdetails.select(
        F.col("remote_id").alias("_jd_id"), F.col("client_uuid").alias("_jd_client"),
        F.col("start_date").alias("_jd_start"), F.col("due_date").alias("_jd_due"),
        F.col("completed_date").alias("_jd_done"),
    )
    cd = clientdetails.select(F.col("uuid").alias("_cd_uuid"), F.col("name").alias("client_name"))
    tn = task_names.select(F.col("task_name").alias("_tn_name"), "task_type")
    # A job meets its client before the task rows meet the job: the client's name costs no shuffle of the tasks.
    jobs = left_join_sparse(jd, cd, "_jd_client", "_cd_uuid", "_jd_id")
    return (
        jt.join(jta, F.col("_jta_task") == F.col("_jt_rid"))
        .join(jobs, F.col("_jd_id") == F.col("job_id"), "left")
        .join(tn, F.col("_tn_name") == F.col("task_name"), "left")
        .select(
            composite_id("job_id", "task_uuid", "staff_uuid").alias("job_task_staff_id"),
            "job_id", "task_uuid", "task_name", "estimated_minutes", "actual_minutes", "task_billable",
            "task_completed", "staff_uuid", "staff_name", "client_name", "start_date", "due_date",
            "task_allocated_mins", "task_type",
            window_start("start_date", "_jd_start").alias("start_date_adjusted"),
            window_end("due_date", "_jd_done", "_jd_due").alias("due_date_adjusted"),
            is_leave_name("task_name").alias("is_task_a_leave"),
        )
    )


def with_calendar_counts(base: DataFrame, person_days: DataFrame, params: Params) -> DataFrame:
    """``base`` with eight day counts per task over its workable days, without a task-day row.

    The person's running counts (one element per calendar day) join once per
    task; every count is the difference of two elements: at the ends of the
    task's window, cut at the reporting date for the remaining and prior
    counts, and before the admin cut-off for the leave-free counts of admin
    tasks. Persons without a working-day sheet, and windows without a
    calendar day, give zeros.
    """
    lo, hi = params.calendar_start, params.calendar_end
    at = lambda d: (d - lo).days
    rows = base.join(person_days, F.col("_pd_staff") == F.col("staff_name"), "left")
    first, last = window_index("start_date_adjusted", "due_date_adjusted", lo, hi)
    # NULL names fall under the cut-off too, as in three-valued SQL.
    admin = F.coalesce(F.col("task_name") == params.admin_task, F.lit(True))
    rows = rows.select(
        *base.columns, "_pd_days", "_pd_partial", first.alias("_first"), last.alias("_last"),
        F.when(admin, F.least(last, F.lit(at(params.admin_cutoff) - 1))).otherwise(last).alias("_free_last"),
    )
    first, last, free_last, as_of = F.col("_first"), F.col("_last"), F.col("_free_last"), F.lit(at(params.as_of))
    from_as_of = F.greatest(first, as_of)
    counts = {
        "wdb_cnt": plain_days(first, last) + partial_days(first, last),
        "tlh_hrs": partial_hours(first, last),
        "ttl_cnt": plain_days(first, free_last),
        "wdl_cnt": partial_days(first, last),
        "arwd_cnt": partial_days(from_as_of, last),
        "rttl_cnt": plain_days(from_as_of, free_last),
        "pwdl_cnt": partial_days(first, F.least(last, as_of)),
        "pttl_cnt": plain_days(first, F.least(free_last, as_of)),
    }
    return rows.select(*base.columns, *[counts[c].alias(c) for c in COUNT_COLUMNS])


def calendar_counts(base: DataFrame, person_days: DataFrame, params: Params) -> DataFrame:
    """``job_task_staff_id`` and the eight day counts of every task."""
    rows = base.select("job_task_staff_id", "staff_name", "task_name", "start_date_adjusted", "due_date_adjusted")
    return with_calendar_counts(rows, person_days, params).select("job_task_staff_id", *COUNT_COLUMNS)


def minutes_by_task(time_entries: DataFrame, params: Params) -> DataFrame:
    """Minutes recorded since the cut-off per (job, task, staff), keyed like the task rows."""
    return (
        time_entries.where(F.col("date") >= F.lit(params.timesheet_cutoff))
        .groupBy(F.col("job_id").alias("_t_job"), F.col("task_uuid").alias("_t_task"), F.col("staff_uuid").alias("_t_staff"))
        .agg(F.sum("minutes").alias("_rec"))
    )


def _with_minutes(rows: DataFrame, minutes: DataFrame) -> DataFrame:
    """Left join on the three columns (not the concatenated id); 0 when nothing was recorded."""
    cond = (F.col("job_id") == F.col("_t_job")) & (F.col("task_uuid") == F.col("_t_task")) & (
        F.col("staff_uuid") == F.col("_t_staff"))
    return rows.join(minutes, cond, "left").withColumn(
        "recorded_mins", F.coalesce(F.col("_rec"), F.lit(0).cast("bigint"))
    ).drop("_t_job", "_t_task", "_t_staff", "_rec")


def recorded_minutes(base: DataFrame, time_entries: DataFrame, params: Params) -> DataFrame:
    """Minutes recorded against each task assignee since the timesheet cut-off (0 when none)."""
    rows = base.select("job_task_staff_id", "job_id", "task_uuid", "staff_uuid")
    return _with_minutes(rows, minutes_by_task(time_entries, params)).select("job_task_staff_id", "recorded_mins")


def _nl(leave: Column, value: Column) -> Column:
    """Value only for tasks that are not leave (NULL otherwise, as SQL CASE without ELSE)."""
    return F.when(~leave, value)


def job_task_details(base: DataFrame, person_days: DataFrame, minutes: DataFrame, params: Params) -> DataFrame:
    """The 46-column task details table.

    ``minutes`` is ``minutes_by_task``: it joins the task rows directly on
    their three key columns, so the task rows are shuffled once for it and
    once, on the person, for the day counts.
    """
    # What other columns of the row give is put in after the last shuffle.
    narrow = base.drop("job_task_staff_id", "is_task_a_leave")
    df = with_calendar_counts(_with_minutes(narrow, minutes), person_days, params).select(
        composite_id("job_id", "task_uuid", "staff_uuid").alias("job_task_staff_id"), "*",
        is_leave_name("task_name").alias("is_task_a_leave"))
    c = F.col
    L = c("is_task_a_leave")
    A = is_admin(c("task_name"), c("client_name"), params)
    alloc = c("task_allocated_mins").cast("double")
    alloc_i = c("task_allocated_mins")
    wdb, tlh, ttl, wdl = c("wdb_cnt"), c("tlh_hrs"), c("ttl_cnt"), c("wdl_cnt")
    arwd, rttl, pwdl, pttl = c("arwd_cnt"), c("rttl_cnt"), c("pwdl_cnt"), c("pttl_cnt")
    r = c("recorded_mins")
    dbl = lambda x: x.cast("double")
    nz = lambda x: F.nullif(x, F.lit(0)).cast("double")

    rev = (dbl(wdb * HOURS_PER_DAY) - F.coalesce(tlh, F.lit(0.0))) / F.lit(8.0)
    ttl_mins = dbl(ttl) * alloc / nz(rev)
    remaining = alloc - ttl_mins
    avg_wl = remaining / nz(wdl)
    arwd_mins = dbl(arwd) * remaining / nz(wdl)
    remain_raw = F.greatest(F.lit(0).cast("bigint"), alloc_i - r)
    remain = dbl(remain_raw) - F.when(~A, F.coalesce(arwd_mins, F.lit(0.0))).otherwise(F.lit(0.0))
    as_of = F.lit(params.as_of)
    due_over = c("due_date_adjusted") < as_of
    twa = F.when((r > alloc_i) | due_over, alloc_i.cast("bigint")).otherwise(r)
    pam = F.when(~A, dbl(pwdl) * remaining / nz(wdl))

    # Shared sub-expressions are projected once so later columns reuse them.
    df = df.select(
        "*",
        rev.alias("_rev"), ttl_mins.alias("_ttl_mins"), remaining.alias("_remaining"), avg_wl.alias("_avg_wl"),
        arwd_mins.alias("_arwd_mins"), remain.alias("_remain"), twa.alias("_twa"), pam.alias("_pam"),
    )
    rev, ttl_mins, remaining, avg_wl = c("_rev"), c("_ttl_mins"), c("_remaining"), c("_avg_wl")
    arwd_mins, remain, twa, pam = c("_arwd_mins"), c("_remain"), c("_twa"), c("_pam")
    aw = F.when(pam > dbl(twa), dbl(twa)).otherwise(pam)

    return df.select(
        "job_task_staff_id", "job_id", "task_uuid", "task_name", "estimated_minutes", "actual_minutes",
        "task_billable", "task_completed", "staff_uuid", "staff_name", "client_name", "start_date", "due_date",
        "task_allocated_mins", "task_type", "start_date_adjusted", "due_date_adjusted", "is_task_a_leave",
        wdb.alias("workable_days_between_task"),
        (wdb * HOURS_PER_DAY).alias("workable_hrs_between_task"),
        (alloc / nz(wdb)).alias("initial_avg_mins_per_work_day"),
        _nl(L, tlh).alias("total_leave_hrs_between_workable_days"),
        _nl(L, rev).alias("rev_workable_days_between_task"),
        _nl(L, alloc / nz(rev)).alias("avg_mins_per_work_day_without_leave"),
        _nl(L, ttl_mins).alias("total_task_mins_work_days_without_leave"),
        _nl(L, remaining).alias("remaining_allocated_task_mins"),
        _nl(L, wdl).alias("work_days_with_leaves_between_task"),
        _nl(L, avg_wl).alias("avg_mins_per_work_day_with_leaves"),
        _nl(L, r).alias("task_mins_worked_till_date"),
        _nl(L, r > alloc_i).alias("is_task_mins_worked_gt_allocated"),
        _nl(L, F.greatest(F.lit(0).cast("bigint"), alloc_i - r)).alias("task_mins_remain_until_due"),
        _nl(L, F.when(~A, arwd_mins)).alias("allo_mins_during_remaining_work_days_with_leave"),
        _nl(L, remain).alias("remain_mins_allo_to_remain_work_days_without_leave"),
        _nl(L, rttl).alias("remain_work_days_without_leave"),
        _nl(L, remain / nz(rttl)).alias("avg_remain_mins_per_remain_workday_without_leave"),
        _nl(L, F.when(remain > 0, (rttl >= 1) & (remain / nz(rttl) <= FULL_DAY_MINUTES)).otherwise(F.lit(True))).alias(
            "is_task_within_allo_time_imp"
        ),
        _nl(L, due_over).alias("is_task_due_date_over"),
        _nl(L, twa).alias("task_mins_worked_adjusted"),
        _nl(L, pwdl).alias("prior_work_days_with_leave"),
        _nl(L, pttl).alias("prior_work_days_without_leave"),
        _nl(L, pam).alias("allo_mins_during_prior_work_days_with_leave"),
        _nl(L, pam > dbl(twa)).alias("is_mins_prior_work_days_with_leave_gt_task_mins_worked"),
        _nl(L, aw).alias("adj_worked_mins_prior_work_days_with_leave"),
        _nl(L, dbl(twa) - aw).alias("adj_worked_mins_prior_work_days_without_leave"),
        _nl(L, aw / nz(pwdl)).alias("avg_worked_mins_per_prior_days_with_leave"),
        _nl(L, (dbl(twa) - aw) / nz(pttl)).alias("avg_worked_mins_per_prior_days_without_leave"),
    )
