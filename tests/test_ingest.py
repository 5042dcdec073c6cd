"""SCD2 properties, versioned store, sheet cleaning, JDBC type mapping, profile."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from workgrid.session import scratch_path
from workgrid.sinks import profile
from workgrid.sinks.store import DuplicateKeyError, TableStore, UnloggedDataError
from workgrid.sources import jdbc, scd2, sheets
from workgrid.sources.scd2_store import Scd2Table, SourceTable, sync_tables

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
SCHEMA = "id bigint, name string, amount bigint"


def _hist(spark, batches, keys=("id",)):
    first = spark.createDataFrame(batches[0][1], SCHEMA)
    h = scd2.empty_history(spark, first.schema)
    for ts, rows in batches:
        h = scd2.apply(h, spark.createDataFrame(rows, SCHEMA), keys, ts)
    return h


def test_scd2_rerun_with_same_source_changes_nothing(spark):
    rows = [(1, "a", 10), (2, "b", 20)]
    h1 = _hist(spark, [(T1, rows)])
    h2 = _hist(spark, [(T1, rows), (T2, rows)])
    assert sorted(map(tuple, h1.collect())) == sorted(map(tuple, h2.collect()))


def test_scd2_change_closes_old_version_at_new_valid_from(spark):
    h = _hist(spark, [(T1, [(1, "a", 10), (2, "b", 20)]), (T2, [(1, "a", 11), (3, "c", 30)])])
    cur = h.where("_scd_is_current")
    assert cur.groupBy("id").count().where("count > 1").count() == 0
    assert {r.id for r in cur.collect()} == {1, 2, 3}  # id 2 vanished from the source but stays current
    old = h.where("id = 1 AND NOT _scd_is_current").first()
    new = h.where("id = 1 AND _scd_is_current").first()
    assert old._scd_valid_to == new._scd_valid_from == T2
    assert new.amount == 11


def test_scd2_null_keys_match_null_safe(spark):
    h = _hist(spark, [(T1, [(None, "a", 1)]), (T2, [(None, "a", 1)])])
    assert h.count() == 1


def test_scd2_without_key_appends_every_batch(spark):
    rows = [(1, "a", 10)]
    h = _hist(spark, [(T1, rows), (T2, rows)], keys=())
    assert h.count() == 2 and h.where("_scd_is_current").count() == 2


def test_scd2_summary_counts(spark):
    h = _hist(spark, [(T1, [(1, "a", 10), (2, "b", 20)])])
    src = spark.createDataFrame([(1, "a", 10), (2, "b", 21), (3, "c", 1)], SCHEMA)
    s = scd2.summary(scd2.classify(src, h, ("id",))).first()
    assert (s.new, s.changed, s.unchanged) == (1, 1, 1)


def test_store_backed_sync_equals_pure_apply(spark):
    store = TableStore(spark, scratch_path(spark, "test-store"))
    t = Scd2Table(store, "src_dbo_items")
    b1 = [(1, "a", 10), (2, "b", 20)]
    b2 = [(1, "a", 11), (3, "c", 30)]
    b3 = [(1, "a", 12), (3, "c", 30)]
    for ts, rows in ((T1, b1), (T2, b2), (T3, b3)):
        t.sync(spark.createDataFrame(rows, SCHEMA), ("id",), ts)
    pure = _hist(spark, [(T1, b1), (T2, b2), (T3, b3)])
    cols = ["id", "name", "amount", "_scd_valid_from", "_scd_valid_to", "_scd_is_current", "_scd_source_hash"]
    assert sorted(map(tuple, t.history().select(cols).collect())) == sorted(map(tuple, pure.select(cols).collect()))


def test_multi_table_sync_isolates_failures_and_view_clash(spark):
    store = TableStore(spark, scratch_path(spark, "test-multi"))
    ok = lambda: spark.createDataFrame([(1, "a", 1)], SCHEMA)
    empty = lambda: spark.createDataFrame([], SCHEMA)

    def boom():
        raise RuntimeError("source unavailable")

    res = sync_tables(spark, store, [
        SourceTable("s_dbo_alpha", ok, ("id",)),
        SourceTable("s_dbo_broken", boom, ("id",)),
        SourceTable("s_dbo_empty", empty, ("id",)),
        SourceTable("s_other_alpha", ok, ("id",)),  # same current-view name as s_dbo_alpha
    ], T1)
    status = {r.table_name: r.status for r in res.collect()}
    assert status == {"s_dbo_alpha": "ok", "s_dbo_broken": "failed", "s_dbo_empty": "skipped",
                      "s_other_alpha": "failed"}
    assert spark.table("alpha").count() == 1


def test_store_refuses_duplicate_keys_and_keeps_old_version(spark):
    store = TableStore(spark, scratch_path(spark, "test-dup"))
    store.publish("t", spark.createDataFrame([(1, "a", 1)], SCHEMA), key=("id",))
    with pytest.raises(DuplicateKeyError):
        store.publish("t", spark.createDataFrame([(1, "a", 1), (1, "b", 2)], SCHEMA), key=("id",))
    assert store.read("t").count() == 1
    store.publish("t", spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA), key=("id",))
    assert store.read("t").count() == 2


def test_clean_column_names():
    got = [sheets.clean_column_name(c) for c in ("Staff Name", "2024 Target %", "", "Working?", "a__b", 7)]
    assert got == ["staff_name", "col_2024_target", "unnamed_column", "working", "a_b", "col_7"]


def test_clean_sheet_drops_all_null_rows_and_nan(spark):
    df = spark.createDataFrame([("A", 1.0, None, True), (None, None, None, None), ("B", float("nan"), "x", False)],
                               "`Staff Name` string, `2024 Target %` double, `` string, `Working?` boolean")
    out = sheets.clean_sheet(df)
    assert out.columns == ["staff_name", "col_2024_target", "unnamed_column", "working"]
    rows = out.collect()
    assert len(rows) == 2
    assert rows[1].col_2024_target is None


def test_table_and_view_names():
    assert sheets.normalize_table_name("My Sheet-1 (v2)") == "my_sheet_1_v2"
    long = "x" * 70
    n = sheets.normalize_table_name(long)
    assert len(n) == 63 and n.startswith("x" * 54 + "_")
    assert sheets.view_name_for("excel_targets") == "targets"
    with pytest.raises(ValueError):
        sheets.view_name_for("targets")
    assert scd2.view_name("sync_dbo_jobtask") == "jobtask"


def test_source_type_mapping():
    assert jdbc.spark_type("nvarchar") == "string"
    assert jdbc.spark_type("decimal", 10, 2) == "decimal(10,2)"
    assert jdbc.spark_type("numeric") == "decimal(18,0)"
    assert jdbc.spark_type("money") == "decimal(19,4)"
    assert jdbc.spark_type("geography") == "string"


def test_typed_projection_lowercases_identifiers(spark):
    df = spark.createDataFrame([("ABC-DEF", "12")], "u string, n string")
    out = jdbc.typed_projection(df, [{"name": "u", "data_type": "uniqueidentifier"}, {"name": "n", "data_type": "int"}])
    r = out.first()
    assert (r.u, r.n) == ("abc-def", 12)


def test_profile_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    r = profile.table_profile({"t": df}).first()
    assert (r.table_name, r.row_count, r.column_count, r.null_cells) == ("t", 2, 2, 1)
    cols = profile.column_profile(spark, {"t": df}).orderBy("ordinal").collect()
    assert [(c.column_name, c.data_type) for c in cols] == [("a", "int"), ("b", "string")]
    assert profile.sample_rows(df, 1) == [["1", "NULL"]]


def test_unreadable_log_stops_the_sync_and_keeps_history(spark, monkeypatch):
    store = TableStore(spark, scratch_path(spark, "t_store"))
    table = Scd2Table(store, "t")
    table.sync(spark.createDataFrame([(1, "a", 10)], SCHEMA), ("id",), T1)
    before = sorted(map(tuple, table.history().collect()))

    monkeypatch.setattr(store, "_log_path", lambda name: f"nosuchscheme://host/{name}/_versions")
    with pytest.raises(Exception, match="nosuchscheme"):
        store.exists("t")
    with pytest.raises(Exception, match="nosuchscheme"):
        table.sync(spark.createDataFrame([(2, "b", 20)], SCHEMA), ("id",), T2)
    monkeypatch.undo()
    assert sorted(map(tuple, table.history().collect())) == before


def test_sync_never_starts_empty_over_a_filled_folder(spark, monkeypatch):
    store = TableStore(spark, scratch_path(spark, "t_store"))
    table = Scd2Table(store, "t")
    with monkeypatch.context() as m:
        m.setattr(store, "log_version", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):
            table.sync(spark.createDataFrame([(1, "a", 10)], SCHEMA), ("id",), T1)
    with pytest.raises(UnloggedDataError):
        table.sync(spark.createDataFrame([(1, "a", 10)], SCHEMA), ("id",), T1)
    assert store.discard_unlogged("t") == 1
    table.sync(spark.createDataFrame([(1, "a", 10)], SCHEMA), ("id",), T1)
    assert table.history().count() == 1


def test_expired_versions_lose_their_files_only(spark):
    store = TableStore(spark, scratch_path(spark, "t_store"))
    for k in range(4):
        store.publish("t", spark.createDataFrame([(k, "a", 10)], SCHEMA))
    assert store.expire("t", keep=2) == 2
    assert store.read("t").first().id == 3


def test_equal_source_rows_are_versioned_together(spark):
    """Rows that are equal in all columns share an id and are closed together."""
    h = _hist(spark, [(T1, [(1, "a", 10), (1, "a", 10)]), (T2, [(1, "a", 11)])])
    assert sorted((r.amount, r._scd_is_current) for r in h.collect()) == [(10, False), (10, False), (11, True)]


def test_one_stage_is_refreshed_from_published_inputs(spark, params):
    from tests.conftest import SF0001
    from workgrid.sinks.publish import refresh_chain
    from workgrid.sources.fixtures import FixtureTables

    store = TableStore(spark, scratch_path(spark, "t_chain"))
    fx = FixtureTables(spark, SF0001, params)
    first = refresh_chain(spark, fx, params, store, stages=("job_task_details",)).collect()
    assert [r.table_name for r in first] == ["leave_status", "job_task_details"]
    again = refresh_chain(spark, fx, params, store, stages=("timesheet",)).collect()
    assert [(r.table_name, r.status) for r in again] == [("timesheet", "ok")]
    assert len(store.versions("leave_status").collect()) == 1


def test_checkpoint_folder_is_needed_off_local(monkeypatch):
    from types import SimpleNamespace

    from workgrid.session import ensure_checkpoint_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def test_names_are_quoted():
    assert jdbc.literal("o'x") == "'o''x'" and jdbc.identifier('a"b') == '"a""b"'


def test_bi_views_have_report_names(spark):
    from workgrid.sinks.publish import bi_views, display_name

    assert display_name("allo_hrs_per_workday_with_leave_kpi03") == "Allo_Hrs_Per_Workday_With_Leave_KPI03"
    store = TableStore(spark, scratch_path(spark, "t_bi"))
    store.publish("t", spark.createDataFrame([(1, "a", 10)], SCHEMA))
    views = bi_views(store, ["t"], {"amount": "Amount (cents)"})
    assert spark.table("pbi_t").columns == views["pbi_t"].columns == ["ID", "Name", "Amount (cents)"]


@pytest.mark.parametrize("kind", ["string", "decimal(10,2)", "date", "bigint"])
def test_scan_predicates_are_disjoint_and_complete(spark, kind):
    """Every row, NULL keys too, meets exactly one condition; Spark's hash stands in for the source's."""
    values = {"string": ["", "a", "a", "b'c", None], "decimal(10,2)": ["1.50", "-2.25", "1.50", None],
              "date": ["2020-01-01", "1970-01-01", None], "bigint": ["-5", "0", "7", "7", "1000", None]}[kind] + [str(i) for i in range(40)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string").selectExpr("i", f"try_cast(t AS {kind}) AS `k y`")
    quoted = lambda cuts: [c.replace(jdbc.identifier("k y"), "`k y`") for c in cuts]
    cases = [jdbc.scan_predicates("k y", 5, "hash({})"), jdbc.scan_predicates(None, 5, row_hash="hash(*)")]
    if kind == "bigint":
        cases += [jdbc.range_predicates("k y", lo, hi, n) for lo, hi, n in ((-5, 1000, 4), (0, 0, 3), (0, 7, 100), (1, 2, 1))]
    for cuts in map(quoted, cases):
        found = [r.i for c in cuts for r in df.where(c).collect()]
        assert sorted(found) == list(range(len(values))), cuts
    assert max(df.where(c).count() for c in quoted(cases[0])) < len(values)


def test_report_names_are_a_contract(spark, params):
    """All six tables have exactly the contract's columns, in its order; a table that differs is refused."""
    from workgrid.plans.model import MATERIALISED, GoldModel
    from workgrid.sinks.publish import bi_views
    from workgrid.sinks.report_names import REPORT_NAMES, ContractError, report_columns
    from workgrid.sources.fixtures import FixtureTables

    model = GoldModel(spark, FixtureTables(spark, "/root/testdata/sf0.001", params), params)
    assert set(REPORT_NAMES) == set(MATERIALISED)
    for name in MATERIALISED:
        columns = getattr(model, name)().columns
        assert columns == list(REPORT_NAMES[name]), name
        assert len(set(report_columns(name, columns))) == len(columns)
    assert report_columns("job_task_staff", list(REPORT_NAMES["job_task_staff"]), {"job_id": "Job No."})[1] == "Job No."
    store = TableStore(spark, scratch_path(spark, "t_bi"))
    store.publish("leave_status", spark.createDataFrame([("a", 1)], "staff_name string, other int"))
    with pytest.raises(ContractError, match="date.*other"):
        bi_views(store, ["leave_status"])


def test_a_sync_writes_what_changed(spark):
    store = TableStore(spark, scratch_path(spark, "t_store"))
    table = Scd2Table(store, "t")
    rows = [(i, f"n{i}", i) for i in range(2000)]
    table.sync(spark.createDataFrame(rows, SCHEMA), ("id",), T1)
    r = table.sync(spark.createDataFrame([*rows[:-2], (1998, "x", 1), (5000, "y", 2)], SCHEMA), ("id",), T2).first()
    assert (r.new, r.changed, r.unchanged) == (1, 1, 1998)
    assert [x["rows"] for x in store.versions("t").orderBy("version").collect()] == [2000, 2]
    assert table.history().count() == 2002 and table.current_versions().count() == 2001
    before = sorted(map(tuple, table.history().collect()), key=str)
    table.compact()
    assert sorted(map(tuple, table.history().collect()), key=str) == before
    r = table.sync(spark.createDataFrame([(1998, "z", 1)], SCHEMA), ("id",), T3).first()
    assert (r.new, r.changed, r.unchanged) == (0, 1, 0)
    closed = table.history().where("id = 1998").orderBy("_scd_valid_from").collect()
    assert [(x.name, x._scd_valid_to, x._scd_is_current) for x in closed] == [("n1998", T2, False), ("x", T3, False), ("z", None, True)]
