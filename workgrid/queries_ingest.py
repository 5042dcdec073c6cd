"""Registered queries for the ingest and publish operators.

Each reads the driver tables (through the fixture derivations) and writes
only under the session's checkpoint folder. Batch times are parameters
(``as_of`` and the day after), so results repeat run to run.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import fixture_params
from .functions.keys import content_hash
from .plans.model import CONTENT_COLUMNS, MATERIALISED
from .session import scratch_path
from .sinks import profile, publish, schema_profile
from .sinks.report_names import REPORT_NAMES
from .sinks.store import TableStore
from .sources import scd2, scd2_store, sheets
from .sources.driver import DRIVER_TABLES, read_table
from .sources.fixtures import FixtureTables

SCD_KEYS = ("o_orderkey",)


def batch_times() -> tuple[datetime, datetime]:
    p = fixture_params()
    t1 = datetime(p.as_of.year, p.as_of.month, p.as_of.day)
    return t1, t1 + timedelta(days=1)


def _fx(spark: SparkSession, sf_dir: str) -> FixtureTables:
    return FixtureTables(spark, sf_dir, fixture_params())


def _history1(spark: SparkSession, fx: FixtureTables) -> DataFrame:
    t1, _ = batch_times()
    b1 = fx["scd_batch1"]
    return scd2.apply(scd2.empty_history(spark, b1.schema), b1, SCD_KEYS, t1)


def q_row_hash(spark, sf_dir):
    return scd2.with_row_hash(_fx(spark, sf_dir)["scd_batch1"])


def q_scd2_classify(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return scd2.classify(fx["scd_batch2"], _history1(spark, fx), SCD_KEYS)


def _history2(spark, sf_dir, keys=SCD_KEYS):
    fx = _fx(spark, sf_dir)
    t1, t2 = batch_times()
    b1, b2 = fx["scd_batch1"], fx["scd_batch2"]
    h1 = scd2.apply(scd2.empty_history(spark, b1.schema), b1, keys, t1)
    return scd2.apply(h1, b2, keys, t2)


def q_scd2_apply(spark, sf_dir):
    return _history2(spark, sf_dir)


def q_scd2_no_key(spark, sf_dir):
    return _history2(spark, sf_dir, keys=())


def q_scd2_current(spark, sf_dir):
    return scd2.current(_history2(spark, sf_dir))


def q_scd2_summary(spark, sf_dir):
    return scd2.summary(q_scd2_classify(spark, sf_dir))


#: Columns of the stored histories that the checksum covers.
SYNCED_CONTENT = {
    "sync_dbo_ordersnap": ("o_orderkey", "o_custkey", "o_orderstatus", "cents", "_scd_is_current", "_scd_source_hash"),
    "sync_dbo_customersnap": ("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "_scd_is_current"),
    "sync_dbo_suppliersnap": ("s_suppkey", "s_name", "s_nationkey", "_scd_is_current"),
    "sync_dbo_nationsnap": ("n_nationkey", "n_name", "n_regionkey", "_scd_is_current"),
}


def q_multi_table_sync(spark, sf_dir):
    """Two syncs of four tables into a fresh store; one row per table and batch, with the stored history's checksum."""
    fx = _fx(spark, sf_dir)
    store = TableStore(spark, scratch_path(spark, "sync"))
    t1, t2 = batch_times()
    cust = lambda: read_table(spark, sf_dir, "customer")
    sup = lambda: read_table(spark, sf_dir, "supplier")
    nat = lambda: read_table(spark, sf_dir, "nation")

    def tables(orders_batch):
        return [
            scd2_store.SourceTable("sync_dbo_ordersnap", lambda: fx[orders_batch], SCD_KEYS),
            scd2_store.SourceTable("sync_dbo_customersnap", cust, ("c_custkey",)),
            scd2_store.SourceTable("sync_dbo_suppliersnap", sup, None),
            scd2_store.SourceTable("sync_dbo_nationsnap", nat, ("n_nationkey",)),
        ]

    r1 = scd2_store.sync_tables(spark, store, tables("scd_batch1"), t1).withColumn("batch", F.lit(1))
    r2 = scd2_store.sync_tables(spark, store, tables("scd_batch2"), t2).withColumn("batch", F.lit(2))
    kept = None
    for name, columns in SYNCED_CONTENT.items():
        history = scd2_store.Scd2Table(store, name).history()
        one = history.agg(
            F.lit(name).alias("_name"), F.count(F.lit(1)).alias("history_rows"),
            F.count_if("_scd_is_current").alias("current_rows"), content_hash(columns).alias("content_hash"),
        )
        kept = one if kept is None else kept.unionByName(one)
    return r1.unionByName(r2).join(kept, F.col("table_name") == F.col("_name")).drop("_name")


SHEET_HEADERS = {"staffname": "Staff Name", "day_of_week": "Day of Week", "working_day": "Working Day?",
                 "adjustment_factor": "Adjustment Factor"}


def _export_csv(spark: SparkSession, df: DataFrame, tag: str) -> str:
    path = scratch_path(spark, "sheets", tag)
    df.write.option("header", True).csv(path)
    return path


def q_sheet_clean(spark, sf_dir):
    """The workable-days sheet exported with display headers and blank rows, read back and cleaned."""
    wd = _fx(spark, sf_dir)["workable_days"]
    exported = wd.select(*[F.col(c).alias(h) for c, h in SHEET_HEADERS.items()])
    blanks = wd.where(F.col("day_of_week") == 1).select(
        *[F.lit(None).cast(exported.schema[h].dataType).alias(h) for h in SHEET_HEADERS.values()]
    )
    path = _export_csv(spark, exported.unionByName(blanks), "workable_days")
    return sheets.clean_sheet(sheets.read_sheet(spark, path, "csv"))


#: Sheets of the full refresh, with the columns that the checksum of the stored table covers.
SHEET_CONTENT = {
    "workable_days": ("staffname", "day_of_week", "working_day"),
    "staff_adjustment": ("staffname", "month"),
    "incentive_targets": ("staff_name", "month_year"),
}
FULL_REFRESH_SHEETS = tuple(SHEET_CONTENT)


def q_full_refresh(spark, sf_dir):
    """Three sheets loaded by full refresh into a fresh store (twice: the second load replaces the first)."""
    fx = _fx(spark, sf_dir)
    files = [sheets.SheetFile(_export_csv(spark, fx[n], n), n) for n in FULL_REFRESH_SHEETS]
    store = TableStore(spark, scratch_path(spark, "sheetstore"))
    sheets.sync_sheet_files(spark, store, files)
    loaded = sheets.sync_sheet_files(spark, store, files).drop("file")
    kept = None
    for name, columns in SHEET_CONTENT.items():
        one = store.read(f"{sheets.SHEET_PREFIX}{name}").agg(F.lit(name).alias("_name"), content_hash(columns).alias("content_hash"))
        kept = one if kept is None else kept.unionByName(one)
    return loaded.join(kept, F.col("sheet") == F.col("_name"), "left").drop("_name")


def q_materialise_unique(spark, sf_dir):
    """Leave status published with its unique key checked, read back from the store."""
    from .plans.model import UNIQUE_KEYS, GoldModel

    p = fixture_params()
    m = GoldModel(spark, _fx(spark, sf_dir), p)
    store = TableStore(spark, scratch_path(spark, "mat"))
    return publish.materialise(store, "leave_status", m.leave_status(), UNIQUE_KEYS["leave_status"])


def q_refresh_chain(spark, sf_dir):
    """All six stored stages rebuilt in dependency order; one status row per stage."""
    store = TableStore(spark, scratch_path(spark, "refresh"))
    return publish.refresh_chain(spark, _fx(spark, sf_dir), fixture_params(), store)


def q_bi_views(spark, sf_dir):
    """pbi_ views over the published stages; row count and checksum per view."""
    store = TableStore(spark, scratch_path(spark, "bi"))
    publish.refresh_chain(spark, _fx(spark, sf_dir), fixture_params(), store)
    views = publish.bi_views(store, MATERIALISED)
    out = None
    for (view, df), name in zip(views.items(), MATERIALISED):
        names = REPORT_NAMES[name]
        one = df.agg(
            F.lit(view).alias("view_name"), F.count(F.lit(1)).alias("row_count"),
            content_hash([names[c] for c in CONTENT_COLUMNS[name]]).alias("content_hash"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def q_table_profile(spark, sf_dir):
    """Row count, column count and NULL cells of every driver table."""
    return profile.table_profile({n: read_table(spark, sf_dir, n) for n in DRIVER_TABLES})


def q_column_profile(spark, sf_dir):
    """Position, row count and NULL cells of every column of every driver table."""
    return profile.column_counts({n: read_table(spark, sf_dir, n) for n in DRIVER_TABLES})


#: Keys of the driver tables, checked for uniqueness by the profile.
DRIVER_KEYS = {
    "region": ("r_regionkey",), "nation": ("n_nationkey",), "customer": ("c_custkey",), "supplier": ("s_suppkey",),
    "part": ("p_partkey",), "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"),
    "events": ("event_id",), "documents": ("doc_id",), "embeddings": ("vec_id",), "pages": ("page_id",),
    "benchmark": ("item_id",), "labels": ("doc_id",), "conversations": ("conv_id", "turn"),
}


def q_schema_profile(spark, sf_dir):
    """Type, nullability, key, NULL cells, extremes and sample of every column of every driver table."""
    tables = {n: read_table(spark, sf_dir, n) for n in DRIVER_TABLES}
    return schema_profile.schema_profile(tables, DRIVER_KEYS, distinct=False)


def ingest_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "row_hash": q_row_hash,
        "scd2_classify": q_scd2_classify,
        "scd2_apply": q_scd2_apply,
        "scd2_no_key": q_scd2_no_key,
        "scd2_current": q_scd2_current,
        "scd2_summary": q_scd2_summary,
        "multi_table_sync": q_multi_table_sync,
        "sheet_clean": q_sheet_clean,
        "full_refresh": q_full_refresh,
        "materialise_unique": q_materialise_unique,
        "refresh_chain": q_refresh_chain,
        "bi_views": q_bi_views,
        "table_profile": q_table_profile,
        "column_profile": q_column_profile,
        "schema_profile": q_schema_profile,
    }
