"""Snapshot sync as a Structured Streaming job: same history as applying the snapshots in order."""

from tests.conftest import SF0001
from workgrid.queries_ingest import batch_times
from workgrid.session import scratch_path
from workgrid.sinks.store import TableStore
from workgrid.sources import scd2
from workgrid.sources.fixtures import FixtureTables
from workgrid.sources.scd2_store import Scd2Table
from workgrid.streaming.snapshot_sync import snapshot_folder, start_snapshot_sync

COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "cents", "_scd_valid_from", "_scd_valid_to", "_scd_is_current",
        "_scd_source_hash"]


def test_streamed_snapshots_equal_batch_apply(spark, params):
    fx = FixtureTables(spark, SF0001, params)
    b1, b2 = fx["scd_batch1"], fx["scd_batch2"]
    t1, t2 = batch_times()
    landing = scratch_path(spark, "landing")
    b1.write.parquet(snapshot_folder(landing, t1))
    b2.write.parquet(snapshot_folder(landing, t2))

    table = Scd2Table(TableStore(spark, scratch_path(spark, "stream-store")), "src_dbo_orders")
    q = start_snapshot_sync(spark, landing, b1.schema, table, ("o_orderkey",),
                            checkpoint=scratch_path(spark, "stream-ckpt"))
    q.awaitTermination(600)
    assert q.exception() is None

    h1 = scd2.apply(scd2.empty_history(spark, b1.schema), b1, ("o_orderkey",), t1)
    expected = scd2.apply(h1, b2, ("o_orderkey",), t2)
    got = sorted(map(tuple, table.history().select(COLS).collect()))
    assert got == sorted(map(tuple, expected.select(COLS).collect()))
