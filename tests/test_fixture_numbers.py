"""The expected values listed in FIXTURES.md for sf0.01 (computed there with independent SQL)."""

import os

import pytest
from pyspark.sql import functions as F

from workgrid.plans.model import GoldModel
from workgrid.queries_ingest import SCD_KEYS, batch_times
from workgrid.sources import scd2
from workgrid.sources.fixtures import FixtureTables

SF001 = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF001), reason="sf0.01 tables not present")


@pytest.fixture(scope="module")
def m(spark, params):
    return GoldModel(spark, FixtureTables(spark, SF001, params), params, cut_lineage=True)


def test_leave_status_numbers(m):
    r = m.leave_status().agg(F.count(F.lit(1)).alias("n"), F.count_if("is_full_day").alias("full"),
                             F.count_if("has_partial_leave").alias("part")).first()
    assert (r.n, r.full, r.part) == (8803, 1738, 5592)


def test_day_count_sums(m):
    c = m.calendar_counts()
    r = c.agg(*[F.sum(x).alias(x) for x in ("wdb_cnt", "tlh_hrs", "ttl_cnt", "wdl_cnt", "arwd_cnt", "rttl_cnt",
                                            "pwdl_cnt", "pttl_cnt")],
              F.count_if(F.col("wdb_cnt") == 0).alias("zero"), F.count(F.lit(1)).alias("n")).first()
    assert r.n == 57442
    assert (r.wdb_cnt, r.ttl_cnt, r.wdl_cnt) == (701936, 662991, 25077)
    assert round(r.tlh_hrs, 6) == 77808.0
    assert (r.arwd_cnt, r.rttl_cnt, r.pwdl_cnt, r.pttl_cnt) == (602, 21311, 24479, 642059)
    assert r.zero == 3764


def test_window_shapes(m, params):
    b = m.task_base()
    r = b.agg(
        F.count_if(F.col("due_date_adjusted") < F.col("start_date_adjusted")).alias("reversed"),
        F.count_if(F.col("due_date_adjusted").isNull()).alias("no_due"),
        F.count_if(F.col("start_date_adjusted") > F.lit(params.calendar_end)).alias("after"),
    ).first()
    assert (r.reversed, r.no_due, r.after) == (701, 475, 0)


def test_row_counts(m):
    assert m.task_name().count() == 388
    assert m.job().count() == 59042
    assert m.job_task_staff().count() == 58056
    assert m.allocation_by_day().count() == 1202446
    assert m.staff_performance().count() == 236640


def test_timesheet_numbers(m):
    ts = m.timesheet()
    r = ts.agg(F.count(F.lit(1)).alias("n"), F.sum("recorded_minutes").alias("mins"),
               F.count_if(F.col("is_client").isNull()).alias("client_null"),
               F.count_if(F.col("task_name").isNull()).alias("name_null")).first()
    assert (r.n, r.mins, r.client_null, r.name_null) == (57620, 8778672, 1391, 401)
    inv = {x.invoiced_time: x["count"] for x in ts.groupBy("invoiced_time").count().collect()}
    assert (inv["Invoiced"], inv["Un-Invoiced"], sum(inv.values()) - inv["Invoiced"] - inv["Un-Invoiced"]) == (
        28705, 26404, 2511)
    cat = {x.task_category: x["count"] for x in ts.groupBy("task_category").count().collect()}
    assert (cat["Billable Tasks"], cat["Leave Tasks"], cat["Admin Tasks"]) == (49810, 4376, 3434)
    timing = {x.recorded_hours_invoiced: x["count"] for x in ts.groupBy("recorded_hours_invoiced").count().collect()}
    assert timing == {"1_Same Month": 7209, "2_Following Month": 5902, "3_Third Month": 5816,
                      "4_Fourth Month +": 5219, "5_Un-Invoiced": 24347, None: 9127}


def test_scd2_batch_numbers(spark, m):
    t1, _ = batch_times()
    b1, b2 = m.t["scd_batch1"], m.t["scd_batch2"]
    h1 = scd2.apply(scd2.empty_history(spark, b1.schema), b1, SCD_KEYS, t1)
    s = scd2.summary(scd2.classify(b2, h1, SCD_KEYS)).first()
    assert (s.new, s.changed, s.unchanged) == (1086, 1302, 11729)
    vanished = b1.join(b2, "o_orderkey", "left_anti").count()
    assert vanished == 815


def test_rounding_ties(m):
    ties = m.t["staff_adjustment"].where((F.col("adjustmentfactor") * 8) % 1 == 0.5).count()
    assert ties == 3429


def test_calendar_covers_the_windows_and_every_branch_has_rows(m, params):
    b = m.task_base().where(F.col("due_date_adjusted") >= F.col("start_date_adjusted"))
    outside = b.where((F.col("start_date_adjusted") < F.lit(params.calendar_start)) | (F.col("due_date_adjusted") > F.lit(params.calendar_end)))
    assert outside.count() < 0.01 * b.count()
    r = m.allocation_by_day().agg(
        F.count_if("is_date_between_today_and_due").alias("future"), F.count_if("is_date_between_start_and_today").alias("past"),
        F.count_if("is_full_day_leave").alias("full"), F.count_if(F.col("is_day_with_a_leave") & F.col("is_date_between_today_and_due")).alias("part"),
        F.count_if("admin_task_to_be_removed").alias("admin"),
    ).first()
    assert min(r) > 500
