"""SCD2 tables kept in a TableStore, and the multi-table sync.

A sync appends: version ``v`` of table ``t`` holds the rows that the sync
inserted (new and changed source rows), each with the id of the version it
closes. Closing a row writes nothing but that id, so the bytes of a sync
follow the number of changed rows, not the size of the table. A row is
current while no later row closes it; the history is the inserted rows with
the time of the row that closed each.

Reading joins the inserted rows with the closing ids, both found by partition
pruning on the logged versions. ``compact`` writes the whole history as one
new base version when many small versions have piled up; readers then start
from it. A version is logged only after its files are complete, so a sync
that dies half way leaves the published history unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.store import TableStore, UnloggedDataError, new_version
from . import scd2

SYNC_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("new", T.LongType(), True),
    T.StructField("changed", T.LongType(), True),
    T.StructField("unchanged", T.LongType(), True),
    T.StructField("error", T.StringType(), True),
])


BASE_MARK = "-base"


class Scd2Table:
    def __init__(self, store: TableStore, name: str):
        self.store = store
        self.name = name

    def _inserted(self) -> DataFrame | None:
        """Every inserted row of the logged versions since the last base; None before the first sync."""
        logged = sorted(r["version"] for r in self.store.versions(self.name).select("version").collect())
        if not logged:
            return None
        base = max((i for i, v in enumerate(logged) if v.endswith(BASE_MARK)), default=0)
        folders = [self.store.version_path(self.name, v) for v in logged[base:]]
        return self.store.spark.read.parquet(*folders)

    def _state(self, rows: DataFrame) -> DataFrame:
        """Inserted rows with the time that a later row closed them."""
        closing = (
            rows.where(F.col("_scd_closes").isNotNull())
            .groupBy(F.col("_scd_closes").alias("_closed_id"))
            .agg(F.min("_scd_valid_from").alias("_closed_at"))
        )
        names = [c for c in rows.columns if c not in (*scd2.SCD_COLUMNS, "_scd_closes")]
        until = F.coalesce("_scd_valid_to", "_closed_at")
        return rows.join(closing, F.col("_scd_id") == F.col("_closed_id"), "left").select(
            *names, "_scd_id", "_scd_valid_from", until.alias("_scd_valid_to"), until.isNull().alias("_scd_is_current"),
            "_scd_source_hash",
        )

    def current_versions(self) -> DataFrame | None:
        rows = self._inserted()
        return None if rows is None else self._state(rows).where("_scd_is_current")

    def history(self) -> DataFrame:
        rows = self._inserted()
        if rows is None:
            raise KeyError(f"table {self.name!r} has no published version under {self.store.root}")
        return self._state(rows)

    def sync(self, source: DataFrame, keys: Sequence[str], batch_ts: datetime) -> DataFrame:
        """Apply one source snapshot; return its one-row summary (new, changed, unchanged).

        One pass: the counts are observed while the changed rows are written.
        """
        spark = self.store.spark
        cur = self.current_versions()
        if cur is None:
            if left := self.store.unlogged_folders(self.name):
                raise UnloggedDataError(f"{self.name}: {left} are in no version log; restore the log or discard them")
            cur = scd2.empty_history(spark, source.schema)
        version = new_version()
        change = F.col("_change")
        counts = Observation()
        classified = scd2.classify(source, cur, keys).observe(
            counts, *[F.count_if(change == c).alias(c) for c in (scd2.NEW, scd2.CHANGED, scd2.UNCHANGED)])
        inserted = classified.where(change != scd2.UNCHANGED).select(
            *source.columns,
            F.md5(F.concat_ws("|", F.lit(version), F.col("_scd_source_hash"))).alias("_scd_id"),
            scd2.batch_time(batch_ts).alias("_scd_valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("_scd_valid_to"),
            "_scd_source_hash",
            F.col("_old_id").alias("_scd_closes"),
        )
        self.store.publish(self.name, inserted, version=version)
        n = counts.get
        return spark.createDataFrame(
            [(self.name, "ok", n[scd2.NEW], n[scd2.CHANGED], n[scd2.UNCHANGED], None)], SYNC_SCHEMA
        )

    def compact(self) -> None:
        """Write the history as one base version; older versions are then no longer read."""
        rows = self.history().drop("_scd_is_current").withColumn("_scd_closes", F.lit(None).cast("string"))
        self.store.publish(self.name, rows, version=new_version() + BASE_MARK)

    def register_current_view(self, registered: dict[str, str] | None = None) -> str:
        """Register the current view under the last ``_`` segment of the table name."""
        view = scd2.view_name(self.name)
        if registered is not None:
            other = registered.get(view)
            if other is not None and other != self.name:
                raise ValueError(f"view {view!r} would serve both {other!r} and {self.name!r}")
            registered[view] = self.name
        scd2.current(self.current_versions()).createOrReplaceTempView(view)
        return view


@dataclass
class SourceTable:
    """One table to sync: a name, a loader, and its key (None: discover, fall back to ``id``)."""

    name: str
    load: Callable[[], DataFrame]
    keys: Sequence[str] | None = None


def resolve_keys(df: DataFrame, keys: Sequence[str] | None, default_key: str = "id") -> list[str]:
    if keys:
        return list(keys)
    return [default_key] if default_key in df.columns else []


def sync_tables(spark: SparkSession, store: TableStore, tables: Sequence[SourceTable], batch_ts: datetime,
                create_views: bool = True, default_key: str = "id", max_parallel: int = 4) -> DataFrame:
    """Sync several tables; one failure is recorded and the others go on.

    Tables are independent, so up to ``max_parallel`` syncs run as concurrent
    Spark jobs (the scheduler shares the executors between them). An empty
    source is reported as ``skipped``; its view is still registered when a
    version exists. Views are registered afterwards, in input order, and a
    second table mapping to an already used view name is refused.
    """

    def one(t: SourceTable):
        try:
            src = t.load()
            keys = resolve_keys(src, t.keys, default_key)
            if src.isEmpty():
                return (t.name, "skipped", 0, 0, 0, "empty source")
            r = Scd2Table(store, t.name).sync(src, keys, batch_ts).first()
            return (t.name, "ok", r["new"], r["changed"], r["unchanged"], None)
        except Exception as exc:
            return (t.name, "failed", None, None, None, f"{type(exc).__name__}: {exc}")

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        rows = list(pool.map(one, tables))
    if create_views:
        views: dict[str, str] = {}
        for i, t in enumerate(tables):
            if rows[i][1] == "failed" or not store.exists(t.name):
                continue
            try:
                Scd2Table(store, t.name).register_current_view(views)
            except Exception as exc:
                rows[i] = (t.name, "failed", None, None, None, f"{type(exc).__name__}: {exc}")
    return spark.createDataFrame(rows, SYNC_SCHEMA)
