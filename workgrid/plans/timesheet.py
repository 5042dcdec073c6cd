"""Timesheet table: recorded time with task, client, invoicing and timing labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (
    BILLABLE,
    INVOICED,
    NOT_BILLABLE,
    TIMING_FOLLOWING,
    TIMING_FOURTH_PLUS,
    TIMING_SAME,
    TIMING_THIRD,
    TIMING_UN_INVOICED,
    UN_INVOICED,
    Params,
)
from ..functions.keys import composite_id
from ..functions.rules import is_admin, is_leave_name, task_category
from ..operators.lookup import first_per_key, left_join_sparse

TIMESHEET_COLUMNS = (
    "row_id", "job_task_staff_id", "timesheet_uuid", "job_id", "task_id", "staff_id", "staff_name",
    "timesheet_notes", "billable", "invoice_id", "invoice_task_id", "date", "recorded_minutes", "task_name",
    "client_name", "task_type", "task_completed", "is_client", "invoiced_time", "is_billable",
    "billable_selector", "task_category", "invoice_number", "month_time_recorded", "month_time_invoiced",
    "invoiced_minutes", "month_invoiced_on", "recorded_hours_invoiced", "job_name",
)


def invoice_lookup(invoicetask: DataFrame, invoice: DataFrame) -> DataFrame:
    """Per invoice task id: the invoice number and invoice date (deleted rows excluded)."""
    it = invoicetask.where(F.col("is_deleted") == False).select(  # noqa: E712
        F.col("uuid").alias("_it_uuid"), F.col("invoice_id").alias("invoice_number")
    )
    inv = invoice.where(F.col("is_deleted") == False).select(  # noqa: E712
        F.col("id").alias("_inv_id"), F.col("date").alias("_inv_date")
    )
    return it.join(inv, F.col("_inv_id") == F.col("invoice_number"), "left").drop("_inv_id")


def month_invoiced_on(invoice_number, rec_month, inv_month):
    """Months from recording to invoicing, 1 = same month; a month early also counts as 1."""
    diff = ((F.year(inv_month) - F.year(rec_month)) * 12 + F.month(inv_month) - F.month(rec_month)).cast("int")
    return F.when(F.col(invoice_number).isNull(), F.lit(None).cast("int")).when(diff == -1, F.lit(1)).otherwise(diff + 1)


def timesheet(time_entries: DataFrame, staff_dim: DataFrame, details: DataFrame, sheet_hours: DataFrame,
              invoicetask: DataFrame, invoice: DataFrame, jobs: DataFrame, params: Params,
              details_unique: bool = False) -> DataFrame:
    """One row per time entry since the cut-off whose staff member is known.

    Lookups are equi joins against one-row-per-key frames: task details per
    id, sheet hours per timesheet id, invoice per invoice task, job per job
    id. The job lookup is one row per job (the job table itself repeats a
    job per assignee and would multiply timesheet rows). ``details_unique``
    says the task details were checked unique on their id, so they are read
    directly instead of deduplicated.
    """
    t = time_entries.where(F.col("date") >= F.lit(params.timesheet_cutoff)).select(
        F.col("uuid").alias("timesheet_uuid"),
        "job_id",
        F.col("task_uuid").alias("task_id"),
        F.col("staff_uuid").alias("staff_id"),
        F.col("note").alias("timesheet_notes"),
        "billable",
        F.col("invoice_uuid").alias("invoice_id"),
        F.col("invoice_task_uuid").alias("invoice_task_id"),
        "date",
        F.col("minutes").alias("recorded_minutes"),
    )
    s = staff_dim.select(F.col("staff_uuid").alias("_s_uuid"), "staff_name")
    jt_cols = ["task_name", "client_name", "task_type", "task_completed"]
    jt_src = details.select("job_task_staff_id", *jt_cols) if details_unique else first_per_key(
        details, ["job_task_staff_id"], jt_cols)
    jt = jt_src.select(
        F.col("job_task_staff_id").alias("_jt_id"), F.col("task_name").alias("_jt_name"),
        F.col("client_name").alias("_jt_client"), F.col("task_type").alias("_jt_type"), "task_completed",
    )
    e = first_per_key(sheet_hours, ["timesheet_uuid"], ["task", "client", "invoiced_mins"]).select(
        F.col("timesheet_uuid").alias("_e_uuid"), F.col("task").alias("_e_task"), F.col("client").alias("_e_client"),
        F.col("invoiced_mins").alias("invoiced_minutes"),
    )
    inv = invoice_lookup(invoicetask, invoice)
    j = jobs.select(F.col("job_id").alias("_j_id"), "job_name")

    # Narrow lookups come first, the task's names last: they, and the id made of three columns that the
    # rows hold anyway, do not travel through the shuffles of the others.
    df = (
        left_join_sparse(t, inv, "invoice_task_id", "_it_uuid", "timesheet_uuid")
        .join(e, F.col("_e_uuid") == F.col("timesheet_uuid"), "left")
        .join(j, F.col("_j_id") == F.col("job_id"), "left")
        .join(s, F.col("staff_id") == F.col("_s_uuid"))
        .withColumn("job_task_staff_id", composite_id("job_id", "task_id", "staff_id"))
        .join(jt, F.col("_jt_id") == F.col("job_task_staff_id"), "left")
    )
    name = F.coalesce(F.col("_jt_name"), F.col("_e_task"))
    client = F.coalesce(F.col("_jt_client"), F.col("_e_client"))
    ttype = F.coalesce(F.col("_jt_type"), F.col("_e_task"))
    df = df.select("*", name.alias("task_name"), client.alias("client_name"), ttype.alias("task_type"))
    name, client, ttype = F.col("task_name"), F.col("client_name"), F.col("task_type")
    is_client = ~((client == params.admin_client) | (ttype == params.admin_task))
    no_inv_task = F.col("invoice_task_id").isNull()
    rec_m = F.trunc(F.col("date"), "MM")
    inv_m = F.trunc(F.col("_inv_date"), "MM")
    df = df.select(
        "*",
        is_client.alias("is_client"),
        rec_m.alias("month_time_recorded"),
        inv_m.alias("month_time_invoiced"),
        month_invoiced_on("invoice_number", rec_m, inv_m).alias("month_invoiced_on"),
    )
    is_client = F.col("is_client")
    billable_task = ~(is_leave_name(name) | is_admin(name, client, params))
    mto = F.col("month_invoiced_on")
    timing = (
        F.when(no_inv_task & is_client, F.lit(TIMING_UN_INVOICED))
        .when(mto == 1, F.lit(TIMING_SAME))
        .when(mto == 2, F.lit(TIMING_FOLLOWING))
        .when(mto == 3, F.lit(TIMING_THIRD))
        .otherwise(F.lit(TIMING_FOURTH_PLUS))
    )
    billable_flag = is_client & (ttype != params.coaching_type)
    return df.select(
        F.xxhash64("timesheet_uuid").alias("row_id"),
        "job_task_staff_id", "timesheet_uuid", "job_id", "task_id", "staff_id", "staff_name", "timesheet_notes",
        "billable", "invoice_id", "invoice_task_id", "date", "recorded_minutes", "task_name", "client_name",
        "task_type", "task_completed", "is_client",
        F.when(no_inv_task & is_client, F.lit(UN_INVOICED))
        .when(no_inv_task, F.lit(params.internal_time_label))
        .otherwise(F.lit(INVOICED))
        .alias("invoiced_time"),
        billable_flag.alias("is_billable"),
        F.when(billable_flag, F.lit(BILLABLE)).otherwise(F.lit(NOT_BILLABLE)).alias("billable_selector"),
        task_category(name, client, params).alias("task_category"),
        "invoice_number", "month_time_recorded", "month_time_invoiced", "invoiced_minutes", "month_invoiced_on",
        F.when(billable_task, timing).alias("recorded_hours_invoiced"),
        "job_name",
    )


def keys_time(ts: DataFrame) -> DataFrame:
    return ts.select("job_task_staff_id", "job_id", "task_id", "staff_name", F.col("staff_id").alias("staff_uuid"))
