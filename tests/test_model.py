"""Model tables: unregistered dimensions against SQL, unique keys, invariants, deliberate deviations."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sqlcheck import build
from tests.conftest import SF0001
from workgrid.plans.model import MATERIALISED, UNIQUE_KEYS, GoldModel
from workgrid.sources.fixtures import FixtureTables


@pytest.fixture(scope="module")
def model(spark, params):
    return GoldModel(spark, FixtureTables(spark, SF0001, params), params)


def _rows(df):
    return Counter(tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r) for r in df.collect())


def test_calendar_matches_sql(model, duck, params):
    cal = model.calendar()
    res = duck.execute(build("SELECT * FROM o_cal", p=params))
    cols = [d[0] for d in res.description]
    assert cal.columns == cols
    assert _rows(cal) == Counter(tuple(r) for r in res.fetchall())
    assert cal.count() == params.calendar_days


def test_metric_display(model):
    rows = {r.metric: (r.name, r.target_metric) for r in model.metric_display().collect()}
    assert len(rows) == 6
    assert rows["1. Allocated Billable Hours"] == ("Selected Metric: Allocated Billable Hours",
                                                   "Target Metric: Hours to be Allocated")
    assert rows["5. % Recorded to Billable Hours"][1] == "Target Metric: Hours to be Recorded"
    assert rows["6. % Invoiced to Billable Hours"][1] == "Target Metric: Hours to be Invoiced"


@pytest.mark.parametrize("name", MATERIALISED)
def test_unique_keys(model, name):
    df = getattr(model, name)()
    key = list(UNIQUE_KEYS[name])
    assert df.groupBy(*key).count().where("count > 1").count() == 0


def test_kpi02_hours_add_up_to_task_minutes(model, params):
    """Sum of KPI02 hours x 60 equals the task's minutes on leave-free workdays.

    For tasks with a known client that are neither admin nor leave and whose
    window lies inside the calendar.
    """
    d = model.job_task_details().where(
        F.col("client_name").isNotNull() & ~F.col("is_task_a_leave")
        & ~F.col("task_name").ilike(f"%{params.admin_task}%") & (F.col("client_name") != params.admin_client)
        & (F.col("start_date_adjusted") >= F.lit(params.calendar_start))
        & (F.col("due_date_adjusted") <= F.lit(params.calendar_end))
    ).select("job_task_staff_id", "total_task_mins_work_days_without_leave")
    k = model.job_task_staff().select("job_task_staff_id", "task_type1")
    a = model.allocation_by_day().groupBy("job_task_staff_id").agg(
        (F.sum("allo_hrs_per_workday_without_leave_kpi02") * 60).alias("m"))
    j = d.join(k, "job_task_staff_id").where(
        F.col("task_type1") != params.admin_task).join(a, "job_task_staff_id", "left")
    bad = j.where(F.abs(F.coalesce("m", F.lit(0.0)) - F.coalesce("total_task_mins_work_days_without_leave",
                                                                   F.lit(0.0))) > 1e-6)
    assert j.count() > 0
    assert bad.count() == 0


def test_timesheet_joins_one_row_per_job(model, params):
    """Timesheet rows are not multiplied by the job's assignees (one row per job lookup)."""
    t = model.t["time_entries"].where(F.col("date") >= F.lit(params.timesheet_cutoff))
    staff = model.staff().select(F.col("staff_uuid").alias("_s"))
    known = t.join(staff, t.staff_uuid == staff._s, "left_semi")
    assert model.timesheet().count() == known.count()
    assert model.job().groupBy("job_id").count().where("count > 1").count() > 0


def test_full_and_partial_leave_can_both_hold(model):
    ls = model.leave_status()
    assert ls.where("is_full_day").count() > 0
    assert ls.where("has_partial_leave").count() > 0


def test_staff_performance_grid_is_staff_times_days(model, params):
    assert model.staff_performance().count() == model.staff().count() * params.calendar_days


def test_cut_lineage_chain_equals_lazy_chain(spark, params, model):
    """Writing stages (and reading checked-unique task details directly) changes no row."""
    stored = GoldModel(spark, FixtureTables(spark, SF0001, params), params, cut_lineage=True)
    for name in ("job_task_details", "timesheet", "job_task_staff", "staff_performance"):
        a = getattr(stored, name)()
        b = getattr(model, name)()
        cols = [c for c in b.columns if c != "row_id"]
        assert _rows(a.select(cols)) == _rows(b.select(cols)), name
    assert "job_task_details" in stored.unique


def _plan(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", MATERIALISED)
def test_plans_have_no_cross_products(model, name):
    """Range joins are exploded + equi joins, contained types a gram join."""
    plan = _plan(getattr(model, name)())
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_task_days_are_not_shuffled(spark, params):
    """Day counts have no row per task-day; allocation explodes after its last shuffle; leave shuffles changes, not days."""
    m = GoldModel(spark, FixtureTables(spark, SF0001, params), params, cut_lineage=True)
    m.leave_status(), m.task_base(), m.person_days(), m.job_task_staff()
    counts = _plan(m.calendar_counts())
    assert "Generate" not in counts and counts.count("_pd_days") > 0
    m.recorded_task_hours()
    m.cut_lineage = False
    plan = _plan(m.allocation_by_day())
    top = plan[: plan.index("Generate")]
    assert "Exchange hashpartitioning" not in top
    leave = _plan(GoldModel(spark, FixtureTables(spark, SF0001, params), params).leave_status())
    assert "Exchange" not in leave[: leave.index("Generate explode(sequence")]
