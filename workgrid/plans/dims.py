"""Dimension tables (calendar, metrics, staff, task types and names, jobs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (
    DISPLAY_METRICS,
    METRIC_NAME_PREFIX,
    ONLINE_TASK_NAMES,
    TARGET_METRIC_ALLOCATED,
    TARGET_METRIC_INVOICED,
    TARGET_METRIC_RECORDED,
    Params,
)
from ..operators.containment import containment_pairs
from ..operators.lookup import first_per_key, left_join_sparse

CALENDAR_COLUMNS = (
    "date", "public_holiday", "weekday", "weekend", "start_of_month", "end_of_month", "is_range_for_invoicing",
)


def calendar(spark: SparkSession, params: Params, public_holidays: DataFrame) -> DataFrame:
    """One row per day from calendar_start to the end of the third month after as_of's month.

    The day list is generated from parameters; its size is fixed by the date
    range, so joining the holiday list (clipped to that range) is a bounded
    broadcast.
    """
    lo, hi = params.calendar_start, params.calendar_end
    days = spark.range(1).select(F.explode(F.sequence(F.lit(lo), F.lit(hi), F.expr("INTERVAL 1 DAY"))).alias("date"))
    hol = (
        public_holidays.select(F.col("date").cast("date").alias("_h"))
        .where(F.col("_h").between(F.lit(lo), F.lit(hi)))
        .distinct()
    )
    d = F.col("date")
    eom = F.last_day(d)
    return days.join(F.broadcast(hol), d == F.col("_h"), "left").select(
        d,
        F.col("_h").isNotNull().alias("public_holiday"),
        F.dayofweek(d).alias("weekday"),
        F.dayofweek(d).isin(1, 7).alias("weekend"),
        F.trunc(d, "MM").alias("start_of_month"),
        eom.alias("end_of_month"),
        ((eom <= F.lit(params.as_of_month_end)) & (eom > F.lit(params.invoicing_floor))).alias("is_range_for_invoicing"),
    )


def workday_calendar(cal: DataFrame) -> DataFrame:
    """Calendar days that are neither weekend nor public holiday."""
    return cal.where(~F.col("weekend") & ~F.col("public_holiday"))


def metric_display(spark: SparkSession) -> DataFrame:
    """The six incentive display metrics with their label and target metric."""
    m = F.col("metric")
    target = (
        F.when(m.isin(DISPLAY_METRICS[0], DISPLAY_METRICS[3]), F.lit(TARGET_METRIC_ALLOCATED))
        .when(m.isin(DISPLAY_METRICS[1], DISPLAY_METRICS[4]), F.lit(TARGET_METRIC_RECORDED))
        .otherwise(F.lit(TARGET_METRIC_INVOICED))
    )
    lits = F.array(*[F.lit(x) for x in DISPLAY_METRICS])
    return spark.range(1).select(F.explode(lits).alias("metric")).select(
        m, F.concat(F.lit(METRIC_NAME_PREFIX), F.expr("substring(metric, 4)")).alias("name"), target.alias("target_metric")
    )


def staff(jobtaskassignee: DataFrame, params: Params) -> DataFrame:
    """One staff id per distinct non-NULL, non-excluded assignee name (smallest id wins)."""
    n = F.col("name")
    src = jobtaskassignee.where(n.isNotNull() & ~n.isin(*params.excluded_staff) if params.excluded_staff else n.isNotNull())
    return first_per_key(src.select("name", "staff_id"), ["name"], ["staff_id"]).select(
        F.col("staff_id").alias("staff_uuid"), F.col("name").alias("staff_name")
    )


def task_type(task: DataFrame) -> DataFrame:
    return task.select(F.col("uuid").alias("tasktype_uuid"), F.col("name"))


def names(jobtask: DataFrame) -> DataFrame:
    """The distinct task names."""
    return jobtask.select(F.col("name").alias("task_name")).distinct()


def type_pairs(names: DataFrame, task_types: DataFrame) -> DataFrame:
    """(task_name, type_name): every type row whose name a distinct task name contains."""
    return containment_pairs(names, "task_name", task_types.select(F.col("name").alias("type_name")), "type_name")


def task_name(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """Distinct task names with every contained type name (sorted, space-joined)."""
    joined = pairs.groupBy("task_name").agg(
        F.array_join(F.array_sort(F.collect_list("type_name")), " ").alias("_types")
    )
    t1 = F.coalesce(F.nullif(F.trim(F.col("_types")), F.lit("")), F.col("task_name"))
    tn = F.col("task_name")
    return (
        names.join(joined, "task_name", "left")
        .select(tn, t1.alias("task_type1"))
        .select(
            tn,
            "task_type1",
            F.when(tn.isin(*ONLINE_TASK_NAMES), tn).otherwise(F.col("task_type1")).alias("task_type"),
        )
    )


def first_contained_type(pairs: DataFrame) -> DataFrame:
    """(task_name, task_type1): the smallest contained type name of the names that have one."""
    return pairs.groupBy("task_name").agg(F.min("type_name").alias("task_type1"))


def job(jobdetails: DataFrame, clientdetails: DataFrame, jobassignee: DataFrame) -> DataFrame:
    """Job table: one row per job assignee (jobs without assignees keep one row)."""
    cd = clientdetails.select(F.col("uuid").alias("_cd_uuid"), F.col("name").alias("client_name"))
    ja = jobassignee.select(F.col("uuid").alias("staff_uuid"), F.col("name").alias("staff_name"), F.col("job_id").alias("_ja_job"))
    jd = left_join_sparse(jobdetails, cd, "client_uuid", "_cd_uuid", "uuid").withColumnsRenamed(
        {c: f"_jd_{c}" for c in jobdetails.columns})
    return (
        jd.join(ja, F.col("_ja_job") == F.col("_jd_remote_id"), "left")
        .select(
            F.col("_jd_uuid").alias("job_uuid"),
            F.col("_jd_id").alias("job_id"),
            F.col("_jd_name").alias("job_name"),
            F.col("_jd_description").alias("job_description"),
            F.col("_jd_client_uuid").alias("client_uuid"),
            "client_name",
            "staff_uuid",
            "staff_name",
            F.col("_jd_state").alias("job_state"),
            F.col("_jd_start_date").alias("start_date"),
            F.col("_jd_due_date").alias("due_date"),
            F.col("_jd_completed_date").alias("completed_date"),
        )
    )


def job_lookup(jobdetails: DataFrame, clientdetails: DataFrame) -> DataFrame:
    """One row per job id: name, client name, state.

    The job table repeats a job once per assignee, and every repeat carries
    the same job columns; looking them up from the job and client tables
    directly gives the same values without building the repeats first.
    """
    cd = clientdetails.select(F.col("uuid").alias("_cd_uuid"), F.col("name").alias("client_name"))
    rows = left_join_sparse(jobdetails.select("id", "name", "state", "client_uuid"), cd, "client_uuid", "_cd_uuid", "id").select(
        F.col("id").alias("job_id"), F.col("name").alias("job_name"), "client_name", F.col("state").alias("job_state")
    )
    return first_per_key(rows, ["job_id"], ["job_name", "client_name", "job_state"])
