"""What the model's plans shuffle and write: lines are dealt once, few-column readers write no task rows, day rows stay plans."""

import re
from datetime import datetime

import pytest
from tests.test_model import SF0001, _plan

from workgrid.plans.model import GoldModel
from workgrid.sources.fixtures import FixtureTables


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def _shuffles(df) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(df))


def test_lines_are_dealt_by_order_once(spark, params, no_broadcast):
    """Entries: lines and orders. Assignees: lines, orders, parts twice, suppliers twice, and no shuffle to make them distinct."""
    fx = FixtureTables(spark, SF0001, params)
    entries = _shuffles(fx["time_entries"])
    assert sum(s.startswith("l_orderkey") for s in entries) == 1 and len(entries) == 2
    assert not any("job_task_id" in s or "allocated_minutes" in s for s in _shuffles(fx["jobtaskassignee"]))


def test_assignees_are_distinct_whatever_repeats(spark, params, tmp_path):
    """Repeated lines, orders, parts and suppliers give the rows of the plain DISTINCT."""
    day = datetime(1997, 3, 4)
    lines = [(1, 0, 13, 1, 2.0), (1, 0, 13, 1, 2.0), (1, 0, 63, 1, 1.0), (1, 50, 8, 2, 3.0), (2, 0, None, 1, 4.0),
             (None, 0, 8, 1, 1.0), (1, 0, 8, None, 5.0), (9, 0, 8, 1, 1.0), (1, 77, 8, 3, 1.0)]
    made = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"),
        "orders": ([(1, day), (1, day), (2, day), (None, day)], "o_orderkey long, o_orderdate timestamp"),
        "part": ([(0, "a", "b"), (0, "c", "d"), (50, "e", "f")], "p_partkey long, p_name string, p_type string"),
        "supplier": ([(13, "x"), (13, "y"), (63, "z"), (8, "v"), (8, "w"), (8, "v"), (None, "n")], "s_suppkey long, s_name string"),
    }
    for name, (rows, kind) in made.items():
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    got = sorted(map(tuple, FixtureTables(spark, str(tmp_path), params)["jobtaskassignee"].collect()), key=str)
    assert got == sorted([("t1-1", "s13", "s13", None, 240), ("t1-1", "s63", "s63", None, 240),
                          ("t1-2", "s8", "s8", "v", 180), ("t1-2", "s8", "s8", "w", 180)], key=str)


def test_readers_of_few_columns_write_no_task_rows(spark, params):
    m = GoldModel(spark, FixtureTables(spark, SF0001, params), params, cut_lineage=True)
    assert m.recorded_minutes().count() == m.calendar_counts().count() > 0
    assert "task_base" not in m.written
    assert m.task_base().count() == m.recorded_minutes().count()


def test_the_client_costs_no_shuffle_of_the_tasks(spark, params, no_broadcast):
    """Clients meet jobs: no row with a task's name is shuffled by its client."""
    m = GoldModel(spark, FixtureTables(spark, SF0001, params), params)
    by_client = [s for s in _shuffles(m.task_base()) if "_jd_client" in s]
    assert len(by_client) == 1
    plan = m.task_base()._jdf.queryExecution().optimizedPlan().toString()
    client = plan.index("_cd_uuid")
    assert "_jta_task" not in plan[plan.rindex("Join", 0, client):client]


def test_day_rows_of_the_queries_are_not_written(spark):
    import __spark_entry__ as entry

    model = entry._model(spark, SF0001)
    days = model.allocation_by_day()
    assert days.count() > 0 and model.is_billable().count() > 0 and model.staff_performance().count() > 0
    assert not {"allocation_by_day", "staff_performance"} & set(model.written)
    kept = GoldModel(spark, model.t, model.p, cut_lineage=True)
    assert days.exceptAll(kept.allocation_by_day()).isEmpty() and "allocation_by_day" in kept.written


def test_timesheet_names_do_not_travel(spark, params, no_broadcast):
    """The join that adds the task's names is the last one."""
    m = GoldModel(spark, FixtureTables(spark, SF0001, params), params, cut_lineage=True)
    m.job_task_details()
    m.cut_lineage = False
    shuffled = _shuffles(m.timesheet())
    assert "job_task_staff_id" in shuffled[0]


def _query_model(spark, params, tables=None):
    import __spark_entry__ as entry

    return GoldModel(spark, tables or FixtureTables(spark, SF0001, params), params, cut_lineage=True, unwritten=entry.UNWRITTEN)


@pytest.mark.parametrize("name", ["keys_time", "recorded_task_hours", "timesheet_hours_agg", "job_task_staff", "timesheet"])
def test_readers_of_few_columns_write_no_wide_stage(spark, params, name):
    """The rows are those of the chain in which every stage is written; names and day counts that nobody reads are not."""
    m = _query_model(spark, params)
    whole = GoldModel(spark, m.t, params, cut_lineage=True)
    assert getattr(m, name)().exceptAll(getattr(whole, name)()).isEmpty()
    assert getattr(m, name)().count() == getattr(whole, name)().count() > 0
    assert not {"job_task_details", "timesheet", "job_task_staff", "person_days", "leave_status"} & set(m.written)
    assert {"job_task_details", "person_days"} <= set(whole.written)


def test_keys_and_hours_leave_out_the_lookups_of_names(spark, params, no_broadcast):
    m = _query_model(spark, params)
    for df in (m.keys_time(), m.recorded_task_hours()):
        shuffled = _shuffles(df)
        assert any("invoice_task_id" in s for s in shuffled)  # an invoice task that repeats repeats the row
        assert not any("concat" in s or s.startswith(("job_id", "timesheet_uuid")) for s in shuffled)


@pytest.mark.parametrize("name", ["keys_time", "timesheet", "job_task_staff", "is_billable", "staff_performance"])
def test_repeated_task_ids_are_refused_as_before(spark, params, name):
    from workgrid.sinks.store import DuplicateKeyError
    from workgrid.sources.fixtures import FIXTURE_TABLES

    fx = FixtureTables(spark, SF0001, params)
    tables = {n: fx[n] for n in FIXTURE_TABLES}
    tables["jobtask"] = fx["jobtask"].unionByName(fx["jobtask"].limit(40))
    with pytest.raises(DuplicateKeyError):
        getattr(_query_model(spark, params, tables), name)()


def test_only_leave_tasks_are_exploded_for_the_performance(spark, params):
    """The filter on leave tasks stands below the explode of the day rows, in the task rows."""
    plan = _query_model(spark, params).allocation_hours_nonnull()._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Generate explode(CASE WHEN"):].split("\n")
    assert any("Filter" in line and "holiday" in line.lower() for line in below)


def test_lookups_on_one_key_share_its_shuffle(spark, params, no_broadcast):
    """Keys meet their job, with its names and its state, dealt by it once (the other shuffle is the job lookup's own)."""
    shuffled = _shuffles(_query_model(spark, params).allocation_by_day())
    assert sum(s.startswith("job_id") for s in shuffled) == 2 and not any("_j6_id" in s for s in shuffled)


def test_a_written_stage_leaves_no_shuffle_files(spark, params):
    from workgrid.session import SHUFFLE_CLEANUP, dropped_shuffles

    before = spark.conf.get(SHUFFLE_CLEANUP)
    with dropped_shuffles(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP) == before
