"""Difference refresh: contents of a full rebuild, writes that follow the change, pruning by month."""

import random
from datetime import date

import pytest

from workgrid.session import scratch_path
from workgrid.sinks import difference
from workgrid.sinks.store import DuplicateKeyError, TableStore

KIND = "k string, start_of_month date, v int, w double"


def months(n):
    return [date(2000 + i // 12, i % 12 + 1, 1) for i in range(n)]


def contents(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("by", ["start_of_month", None])
def test_random_changes_equal_a_full_rebuild(spark, by):
    rng = random.Random(4)
    store = TableStore(spark, scratch_path(spark, "t_diff"))
    all_months = [*months(6), None]
    rows = {f"k{i}": (f"k{i}", rng.choice(all_months), i, i / 3) for i in range(300)}
    rows[None] = (None, all_months[0], 1, None)
    first = difference.refresh(store, "t", spark.createDataFrame(list(rows.values()), KIND), ["k"], by)
    assert first[:4] == (301, 0, 0, 0)
    for step in range(3):
        before = dict(rows)
        if step == 0:  # one row of one month
            rows["k5"] = (*rows["k5"][:2], -1, 0.5)
        elif step == 1:  # a month goes, a row moves, one comes
            rows = {k: r for k, r in rows.items() if r[1] != all_months[2]}
            mover = next(k for k, r in rows.items() if k and r[1] == all_months[1])
            rows[mover] = (mover, all_months[3], *rows[mover][2:])
            rows["x"] = ("x", None, 7, None)
        got = difference.refresh(store, "t", spark.createDataFrame(list(rows.values()), KIND), ["k"], by)
        assert contents(difference.read(store, "t")) == sorted(rows.values(), key=str)
        same = sum(before.get(k) == r for k, r in rows.items())
        gone = len(before.keys() - rows.keys())
        assert (got.new, got.gone, got.unchanged) == (len(rows.keys() - before.keys()), gone, same)
        assert got.changed == len(rows) - got.new - same
        assert got.parts_written == {0: 1, 2: 0}.get(step, got.parts_written)
    assert store.read("t").columns[:4] == ["k", "start_of_month", "v", "w"]


def test_a_month_filter_reads_only_its_folders(spark):
    store = TableStore(spark, scratch_path(spark, "t_diff"))
    some = months(24)
    df = spark.createDataFrame([(f"k{i}", some[i % 24], i, None) for i in range(480)], KIND)
    difference.refresh(store, "t", df, ["k"], "start_of_month")
    difference.refresh(store, "t", df.replace(3, 999, ["v"]), ["k"], "start_of_month")
    out = store.read("t").where("start_of_month = date '2001-03-01'")
    assert "PartitionFilters: [isnotnull(start_of_month" in out._jdf.queryExecution().toString()
    assert out.count() == 20


def test_refused_and_empty_tables(spark):
    store = TableStore(spark, scratch_path(spark, "t_diff"))
    with pytest.raises(DuplicateKeyError):
        difference.refresh(store, "t", spark.createDataFrame([("a", None, 1, 1.0), ("a", None, 2, 1.0)], KIND), ["k"])
    assert not store.exists("t")
    assert difference.refresh(store, "t", spark.createDataFrame([], KIND), ["k"]) == (0, 0, 0, 0, 0)
    assert difference.read(store, "t").collect() == []
    assert difference.refresh(store, "t", spark.createDataFrame([("a", None, 1, 1.0)], KIND), ["k"]).new == 1
    assert difference.refresh(store, "t", spark.createDataFrame([], KIND), ["k"]).gone == 1
    assert difference.read(store, "t").columns == ["k", "start_of_month", "v", "w"] and difference.read(store, "t").isEmpty()


def test_a_refreshed_chain_writes_touched_months_only(spark, params):
    """A chain over unchanged inputs writes no part; a changed time entry touches few parts of the stages that read it."""
    from pyspark.sql import functions as F

    from workgrid.sinks.publish import refresh_chain
    from workgrid.sources.fixtures import FIXTURE_TABLES, FixtureTables

    sf = "/root/testdata/sf0.001"
    fixtures = FixtureTables(spark, sf, params)
    tables = {n: fixtures[n] for n in FIXTURE_TABLES}
    store = TableStore(spark, scratch_path(spark, "t_diff_chain"))
    names = ("leave_status", "job_task_details", "timesheet")
    refresh_chain(spark, tables, params, store, names)
    one = tables["time_entries"].where("date >= date '1996-05-01'").agg(F.min("uuid")).first()[0]
    tables["time_entries"] = tables["time_entries"].withColumn("minutes", F.col("minutes") + F.when(F.col("uuid") == one, 1).otherwise(0))
    done = refresh_chain(spark, tables, params, store, names)
    assert [r.status for r in done.orderBy("step").collect()] == ["ok"] * 3
    parts = {}
    for n in names:
        version = store.current_version(n)
        _, folders = store.parts(n, version)
        parts[n] = sum(f"version={version}" in f for f in folders.values())
    assert parts["leave_status"] == 0 and 1 <= parts["timesheet"] <= 2 and parts["job_task_details"] <= 2
    full = refresh_chain(spark, tables, params, TableStore(spark, scratch_path(spark, "t_diff_chain")), names)
    key = lambda df: [(r.table_name, r.row_count, r.content_hash) for r in df.orderBy("step").collect()]
    assert key(done) == key(full)


def test_a_first_publish_holds_nothing_and_writes_few_files(spark):
    """No row is cached, a part is few files whatever the number of tasks, and a repeated key leaves no version."""
    store = TableStore(spark, scratch_path(spark, "t_diff"))
    rows = [(f"k{i}", m, i, i / 3) for i, m in enumerate([*months(12), None] * 40)]
    df = spark.createDataFrame(rows, KIND).repartition(16)
    held = len(spark._jsc.getPersistentRDDs())
    assert difference.refresh(store, "t", df, ["k"], "start_of_month") == (520, 0, 0, 0, 13)
    assert contents(difference.read(store, "t")) == sorted(rows, key=str)
    assert len(store.read("t").inputFiles()) < 2 * 13
    assert difference.refresh(store, "b", df, ["k"]).parts_written == len(store.read("b").inputFiles()) == difference.BUCKETS
    assert spark.conf.get(difference.OPEN_FILES) == "0" and len(spark._jsc.getPersistentRDDs()) == held
    with pytest.raises(DuplicateKeyError, match="k7"):
        difference.refresh(store, "d", df.unionByName(df.where("k = 'k7'")), ["k"], "start_of_month")
    assert not store.exists("d")


def test_allocation_rows_dealt_by_month_are_the_same_rows(spark, params):
    """Dealing task rows by the start of their window changes no day row; no day row is shuffled for it."""
    from tests.conftest import SF0001
    from workgrid.plans.model import GoldModel
    from workgrid.sources.fixtures import FixtureTables

    m = GoldModel(spark, FixtureTables(spark, SF0001, params), params, cut_lineage=True, unwritten=("allocation_by_day",))
    plain = m.allocation_by_day()
    m._memo.pop("allocation_by_day")
    m.by_month = True
    dealt = m.allocation_by_day()
    assert dealt.count() == plain.count() > 0 and dealt.exceptAll(plain).isEmpty()
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(_days") < plan.index("RebalancePartitions")
