"""Staff performance per person and calendar day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CATEGORY_ADMIN, CATEGORY_BILLABLE, HOURS_PER_DAY, INVOICED, UN_INVOICED, Params
from ..functions.rules import is_holiday_name, is_other_leave_name, week_of_month
from ..operators.lookup import first_per_key
from ..operators.sparse import spread
from ..operators.staff_lookups import at_weekday, day_list, month_array, month_number, weekday_arrays
from .dims import CALENDAR_COLUMNS

TARGET_COLUMNS = (
    "target_billable_hours", "target_recorded_2_billable_hrs", "target_allocated_2_billable_hrs",
    "target_invoiced_2_billable_hrs",
)

PERFORMANCE_COLUMNS = CALENDAR_COLUMNS + ("staff_uuid", "staff_name") + (
    "is_workable_day", "is_staff_workable_day_of_week", "adjustment_factor_by_month", "week_of_month",
    "overall_recordable_hours", "allocated_holiday_hours", "allocated_other_leave_hours",
    "non_leave_recordable_hours", "allocated_admin_hours", "available_billable_hours",
    "allocated_billable_hours_original", "allocated_billable_hours_capacity_planning", "target_billable_hours",
    "target_non_leave_hours", "m2date_overall_recordable_hours", "m2date_target_billable_hours",
    "annual_leave_hours_recorded", "other_leave_hours_recorded", "admin_hours_recorded",
    "billable_hours_recorded", "overall_hours_recorded", "billable_hours_invoiced",
    "billable_hours_to_be_invoiced", "m2date_overall_hours_recorded",
    "allocated_non_leave_hours_capacity_planning_check_variables", "adjustment_factor_by_day",
    "is_current_month", "target_hours_to_be_recorded", "target_hours_to_be_allocated",
    "target_hours_to_be_invoiced", "target_billable_percent", "target_recordable_percent",
    "target_allocation_percent", "target_invoice_percent",
)


# Tasks of the staff grid per core of the cluster.
GRID_TASKS_PER_CORE = 2


def allocation_hours_agg(alloc: DataFrame) -> DataFrame:
    """Allocated hours per (staff, date) by leave kind and task category, one pass."""
    name, cat = F.col("task_name"), F.col("task_category")
    fin = F.col("allo_hrs_per_workable_day_final_output")
    return alloc.groupBy("staff_name", "date").agg(
        F.sum(F.when(is_holiday_name(name), F.col("allo_hrs_per_work_day_leave"))).alias("hol_hrs"),
        F.sum(F.when(is_other_leave_name(name), F.col("allo_hrs_per_work_day_leave"))).alias("lvl_hrs"),
        F.sum(F.when(cat == CATEGORY_ADMIN, fin)).alias("adm_hrs"),
        F.sum(F.when(cat == CATEGORY_BILLABLE, F.col("allo_hrs_per_work_day_adj_leaves_fin01"))).alias("bil_orig_hrs"),
        F.sum(F.when(cat == CATEGORY_BILLABLE, fin)).alias("bil_cap_hrs"),
        F.sum(F.when(cat.isin(CATEGORY_ADMIN, CATEGORY_BILLABLE), fin)).alias("anl_hrs"),
    )


ALLOCATION_SUMMED = (
    "allo_hrs_per_work_day_leave", "allo_hrs_per_workable_day_final_output", "allo_hrs_per_work_day_adj_leaves_fin01",
)


def contributing_rows(alloc: DataFrame) -> DataFrame:
    """Allocation rows with at least one non-NULL summed value.

    A (staff, date) group whose inputs are all NULL has only NULL sums, which
    a left join reads exactly like a missing group, so dropping such rows
    before the aggregate changes no staff-performance value. The predicate
    reaches the Parquet scan of a stored allocation table. Leave hours stand on
    leave tasks only: saying so takes other tasks out before their days are
    exploded, where the other two values are NULL throughout.
    """
    cond = None
    for c in ALLOCATION_SUMMED:
        term = F.col(c).isNotNull()
        if c == "allo_hrs_per_work_day_leave":
            term = term & F.col("is_task_a_leave")
        cond = term if cond is None else cond | term
    return alloc.where(cond)


def timesheet_hours_agg(ts: DataFrame) -> DataFrame:
    """Recorded and invoiced minutes per (staff, date) by leave kind, category and invoicing, one pass."""
    name, cat, it = F.col("task_name"), F.col("task_category"), F.col("invoiced_time")
    m = F.col("recorded_minutes")
    bill = cat == CATEGORY_BILLABLE
    return ts.groupBy("staff_name", F.col("date").cast("date").alias("date")).agg(
        F.sum(F.when(is_holiday_name(name), m)).alias("alr_mins"),
        F.sum(F.when(is_other_leave_name(name), m)).alias("olr_mins"),
        F.sum(F.when(cat == CATEGORY_ADMIN, m)).alias("dar_mins"),
        F.sum(F.when(bill, m)).alias("bhr_mins"),
        F.sum(F.when((it == INVOICED) & bill, F.col("invoiced_minutes"))).alias("bhi_mins"),
        F.sum(F.when((it == UN_INVOICED) & bill, m)).alias("btu_mins"),
    )


def targets_lookup(incentive_targets: DataFrame) -> DataFrame:
    t = incentive_targets.select(F.col("staff_name"), F.col("month_year").cast("date").alias("month_date"), *TARGET_COLUMNS)
    return first_per_key(t, ["staff_name", "month_date"], list(TARGET_COLUMNS))


def staff_performance(staff_dim: DataFrame, cal: DataFrame, leave: DataFrame, workable_days: DataFrame,
                      staff_adjustment: DataFrame, incentive_targets: DataFrame, alloc_agg: DataFrame,
                      ts_agg: DataFrame, params: Params) -> DataFrame:
    """Staff x calendar grid with capacity, recorded, invoiced and target hours.

    The grid is each staff row exploded over the calendar's days (a
    generator, not a cross join; the day list is fixed by the date range).
    Weekday and monthly sheet values arrive as per-person arrays joined
    before the explode; only the day-keyed inputs (leave status and
    the two per-day aggregates, reduced before the join) meet the grid in
    equi joins on (staff, date).
    """
    lo, hi = params.calendar_start, params.calendar_end
    # Per-person lookups bounded by 7 weekdays or by the calendar's months
    # join once per person, before the grid exists.
    wk = weekday_arrays(workable_days, ["working_day", "adjustment_factor"])
    adj = month_array(staff_adjustment, "staffname", "month", ["adjustmentfactor"], lo, hi, "_adj_months")
    tg = month_array(incentive_targets, "staff_name", "month_year", list(TARGET_COLUMNS), lo, hi, "_tg_months")
    td = day_list(incentive_targets, "staff_name", "month_year", list(TARGET_COLUMNS), lo, hi, "_tg_days")
    people = staff_dim.join(wk, F.col("_wk_staff") == F.col("staff_name"), "left")
    for sheet, key in ((adj, "_adj_staff"), (tg, "_tg_staff"), (td, "_td_staff")):
        people = people.join(sheet.withColumnRenamed("_mm_staff", key), F.col(key) == F.col("staff_name"), "left")
    # Every person has exactly one row per calendar day, so partitioning the
    # (small) per-person rows before exploding gives evenly sized grid
    # partitions without shuffling the grid itself. The number of buckets is
    # explicit and the key a hash expression: a repartition on the bare name
    # would merge with the staff aggregate's own shuffle, which AQE coalesces
    # to one partition for a small staff list, and one task would explode the grid.
    n = staff_dim.sparkSession.sparkContext.defaultParallelism * GRID_TASKS_PER_CORE
    # A day is put together with its month's sheet rows, and with the one dated
    # on it, before the explode: one struct per day, no search per column.
    targets = people.select(F.get("_tg_months", F.lit(0))).schema[0].dataType

    def one_day(i, dated):
        on = F.date_add(F.lit(lo), i)
        month = month_number(on, lo)
        return F.struct(on.alias("date"), F.get("_adj_months", month).alias("adj"), F.get("_tg_months", month).alias("it"), dated.alias("pt"))

    none = F.lit(None).cast(targets)
    window = spread(F.col("_tg_days"), F.lit(0), F.lit(params.calendar_days - 1),
                    lambda x: one_day(x["i"], x["x"]), lambda i: one_day(i, none))
    grid = people.repartition(n, F.xxhash64("staff_name")).select(
        "staff_uuid", "staff_name", "_wk_working_day", "_wk_adjustment_factor", F.explode(window).alias("_g")
    ).withColumn("_g_date", F.col("_g.date"))
    calb = F.broadcast(cal)
    lv = leave.select(F.col("staff_name").alias("_lv_staff"), F.col("date").alias("_lv_date"), "is_full_day")
    aa = alloc_agg.withColumnRenamed("staff_name", "_aa_staff").withColumnRenamed("date", "_aa_date")
    ta = ts_agg.withColumnRenamed("staff_name", "_ta_staff").withColumnRenamed("date", "_ta_date")
    c = F.col
    s, d = c("staff_name"), c("date")
    df = (
        grid.join(calb, c("_g_date") == d)
        .join(lv, (s == c("_lv_staff")) & (d == c("_lv_date")), "left")
        .join(aa, (s == c("_aa_staff")) & (d == c("_aa_date")), "left")
        .join(ta, (s == c("_ta_staff")) & (d == c("_ta_date")), "left")
    )
    df = df.select(
        "*",
        at_weekday("_wk_working_day", c("weekday")).alias("_wd_working"),
        at_weekday("_wk_adjustment_factor", c("weekday")).alias("_wd_factor"),
        c("_g.adj.adjustmentfactor").alias("adjustmentfactor"),
        *[c(f"_g.it.{x}").alias(f"_it_{x}") for x in TARGET_COLUMNS],
        *[c(f"_g.pt.{x}").alias(f"_pt_{x}") for x in TARGET_COLUMNS],
    )
    as_of = F.lit(params.as_of)
    full = F.coalesce(c("is_full_day"), F.lit(False))
    factor = F.coalesce(c("adjustmentfactor"), F.lit(0.0))
    orh = F.when(~c("public_holiday") & ~c("weekend") & ~full & F.coalesce(c("_wd_working"), F.lit(False)),
                 F.rint(F.lit(float(HOURS_PER_DAY)) * factor)).otherwise(F.lit(0.0))
    df = df.select("*", orh.alias("_orh"))
    orh = c("_orh")
    hol, lvl, adm = F.coalesce(c("hol_hrs"), F.lit(0.0)), F.coalesce(c("lvl_hrs"), F.lit(0.0)), F.coalesce(c("adm_hrs"), F.lit(0.0))
    zero = orh == 0
    nlr = F.when(zero, F.lit(0.0)).otherwise(orh - hol - lvl)
    avb = F.when(zero, F.lit(0.0)).otherwise(orh - hol - lvl - adm)
    tbh = c("_it_target_billable_hours")
    tb = F.when(zero, F.lit(0.0)).otherwise(avb * tbh)
    pos = lambda v: F.when(v <= 0, F.lit(None).cast("double")).otherwise(v)
    hrs = lambda m: c(m).cast("double") / F.lit(60.0)
    overall_rec = (F.coalesce(c("alr_mins"), F.lit(0)).cast("double") / F.lit(60.0)
                   + F.coalesce(c("olr_mins"), F.lit(0)).cast("double") / F.lit(60.0)
                   + F.coalesce(c("bhr_mins"), F.lit(0)).cast("double") / F.lit(60.0)
                   + F.coalesce(c("dar_mins"), F.lit(0)).cast("double") / F.lit(60.0))
    future = d >= as_of
    null_d = F.lit(None).cast("double")
    return df.select(
        *CALENDAR_COLUMNS, "staff_uuid", "staff_name",
        (~c("public_holiday") & ~c("weekend") & ~full).alias("is_workable_day"),
        c("_wd_working").alias("is_staff_workable_day_of_week"),
        factor.alias("adjustment_factor_by_month"),
        week_of_month(d).alias("week_of_month"),
        orh.alias("overall_recordable_hours"),
        F.when(zero, null_d).otherwise(-hol).alias("allocated_holiday_hours"),
        F.when(zero, null_d).otherwise(-lvl).alias("allocated_other_leave_hours"),
        nlr.alias("non_leave_recordable_hours"),
        F.when(zero, null_d).otherwise(c("adm_hrs")).alias("allocated_admin_hours"),
        avb.alias("available_billable_hours"),
        F.when(zero, null_d).otherwise(c("bil_orig_hrs")).alias("allocated_billable_hours_original"),
        F.when(zero, null_d).otherwise(c("bil_cap_hrs")).alias("allocated_billable_hours_capacity_planning"),
        tb.alias("target_billable_hours"),
        pos(nlr * tbh).alias("target_non_leave_hours"),
        F.when(future, null_d).otherwise(orh).alias("m2date_overall_recordable_hours"),
        F.when(future, null_d).otherwise(tb).alias("m2date_target_billable_hours"),
        (-hrs("alr_mins")).alias("annual_leave_hours_recorded"),
        (-hrs("olr_mins")).alias("other_leave_hours_recorded"),
        hrs("dar_mins").alias("admin_hours_recorded"),
        hrs("bhr_mins").alias("billable_hours_recorded"),
        overall_rec.alias("overall_hours_recorded"),
        hrs("bhi_mins").alias("billable_hours_invoiced"),
        hrs("btu_mins").alias("billable_hours_to_be_invoiced"),
        F.when(future, null_d).otherwise(overall_rec).alias("m2date_overall_hours_recorded"),
        F.when(zero, null_d).otherwise(c("anl_hrs")).alias("allocated_non_leave_hours_capacity_planning_check_variables"),
        F.coalesce(c("_wd_factor"), F.lit(0.0)).alias("adjustment_factor_by_day"),
        ((F.year(d) == params.as_of.year) & (F.month(d) == params.as_of.month)).alias("is_current_month"),
        pos(tb * c("_it_target_recorded_2_billable_hrs")).alias("target_hours_to_be_recorded"),
        pos(tb * c("_it_target_allocated_2_billable_hrs")).alias("target_hours_to_be_allocated"),
        pos(tb * c("_it_target_invoiced_2_billable_hrs")).alias("target_hours_to_be_invoiced"),
        F.nullif(c("_pt_target_billable_hours"), F.lit(0.0)).alias("target_billable_percent"),
        F.nullif(c("_pt_target_recorded_2_billable_hrs"), F.lit(0.0)).alias("target_recordable_percent"),
        F.nullif(c("_pt_target_allocated_2_billable_hrs"), F.lit(0.0)).alias("target_allocation_percent"),
        F.nullif(c("_pt_target_invoiced_2_billable_hrs"), F.lit(0.0)).alias("target_invoice_percent"),
    )
