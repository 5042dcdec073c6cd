"""Bench: ingest the domain tables and refresh the gold chain at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.

Mirrors a daily run:

* ``ingest_domain_tables``: the domain tables (derived from the driver
  tables by the FIXTURES.md rules) are written once to Parquet, as the
  ingest jobs would leave them;
* one entry per gold stage: each stage is built from the stored domain
  tables and the stages before it, written to Parquet and read back (the
  materialised-view refresh of the source, timed per view);
* ``scd2_sync``: two snapshot syncs of one table into the versioned store.

``value`` is the sum. Nothing is collected to the driver except counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workgrid.config import fixture_params  # noqa: E402
from workgrid.plans.model import MATERIALISED, GoldModel  # noqa: E402
from workgrid.session import local_session, scratch_path  # noqa: E402
from workgrid.sinks.store import TableStore  # noqa: E402
from workgrid.sources.fixtures import FIXTURE_TABLES, FixtureTables  # noqa: E402
from workgrid.sources.scd2_store import Scd2Table  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="workgrid-bench")
    p = fixture_params()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    times: dict[str, float] = {}

    # Warm-up on the smallest input (JIT, class loading); not timed.
    small = sf_dir.replace(m.group(0), "sf0.001") if m and os.path.isdir(sf_dir.replace(m.group(0), "sf0.001")) else sf_dir
    GoldModel(spark, FixtureTables(spark, small, p), p).leave_status().write.format("noop").mode("overwrite").save()

    root = scratch_path(spark, "bench", "domain")
    fx = FixtureTables(spark, sf_dir, p)
    t = time.perf_counter()
    # Independent tables load as concurrent jobs, as the multi-table sync does.
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda n: fx[n].write.parquet(f"{root}/{n}"), FIXTURE_TABLES))
    times["ingest_domain_tables"] = round(time.perf_counter() - t, 3)
    tables = {n: spark.read.parquet(f"{root}/{n}") for n in FIXTURE_TABLES}

    model = GoldModel(spark, tables, p, cut_lineage=True)
    for name in MATERIALISED:
        t = time.perf_counter()
        getattr(model, name)()
        times[name] = round(time.perf_counter() - t, 3)

    store = TableStore(spark, scratch_path(spark, "bench", "store"))
    table = Scd2Table(store, "sync_dbo_orders")
    from workgrid.queries_ingest import batch_times

    t1, t2 = batch_times()
    t = time.perf_counter()
    table.sync(tables["scd_batch1"], ("o_orderkey",), t1)
    table.sync(tables["scd_batch2"], ("o_orderkey",), t2)
    times["scd2_sync"] = round(time.perf_counter() - t, 3)

    print(json.dumps({
        "metric": "gold_refresh_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
    }))


if __name__ == "__main__":
    main()
