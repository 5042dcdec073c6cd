"""Difference refresh: a published table in parts, of which a refresh writes only those with a changed row.

A part is a month (tables with a row per day) or a bucket of the key's hash.
The new rows are compared with the published ones by key and row hash; parts
in which a row is new, changed or gone are written to the new version's
folder, all others stay where an earlier version wrote them. The version then
names its folders, so readers see the old or the new table, never a mixture,
and prune by month. What a refresh writes follows the change, and the result
is that of a full rebuild.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import row_hash
from ..session import SHUFFLE_CLEANUP, settings
from .store import DuplicateKeyError, TableStore, first_duplicate, new_version

#: Hash buckets of a table without a month.
BUCKETS = 32
BUCKET_COLUMN = "_bucket"
#: Files that a task of a first publish holds open, one per part; beyond that many Spark sorts the rest by part.
OPEN_FILES, MOST_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters", 256


class Refreshed(NamedTuple):
    new: int
    changed: int
    gone: int
    unchanged: int
    parts_written: int


def _sides(rows: DataFrame, old: DataFrame, key: Sequence[str], part: str) -> DataFrame:
    """Counts per part and state; the part of a row that is gone is the one it was in."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        columns = [c for c in rows.columns if c != part or part != BUCKET_COLUMN]
        return df.select(*[F.col(c).alias(f"{tag}{i}") for i, c in enumerate(key)], F.col(part).cast("string").alias(f"{tag}part"),
                         row_hash(columns).alias(f"{tag}hash"))

    match = F.lit(True)
    for i in range(len(key)):
        match = match & F.col(f"_n{i}").eqNullSafe(F.col(f"_o{i}"))
    both = side(rows, "_n").join(side(old, "_o"), match, "full_outer")
    state = (
        F.when(F.col("_ohash").isNull(), F.lit("new")).when(F.col("_nhash").isNull(), F.lit("gone"))
        .when(F.col("_ohash") != F.col("_nhash"), F.lit("changed")).otherwise(F.lit("unchanged"))
    )
    return both.groupBy(state.alias("state"), "_npart", "_opart").count()


def _publish_first(store: TableStore, name: str, rows: DataFrame, key: Sequence[str], part: str, dealt: bool) -> Refreshed:
    """Write all rows as a version of new parts, with nothing to compare them with.

    The rows are not held. They are dealt by their part (unless they come so),
    small parts together and a large one in several tasks, and every task
    writes its rows as they come, into one open file per part, without a sort.
    The key is checked on the written files; a version with duplicates is
    never logged.
    """
    version = new_version()
    path = store.version_path(name, version)
    with settings(rows.sparkSession, {OPEN_FILES: str(MOST_OPEN_FILES), SHUFFLE_CLEANUP: "true"}):
        (rows if dealt else rows.hint("rebalance", F.col(part))).write.partitionBy(part).parquet(path)
    written = store.folders(path)
    n = 0
    if written:
        stored = rows.sparkSession.read.schema(rows.schema).option("basePath", path).parquet(*written.values())
        dup = first_duplicate(stored, key)
        if dup:
            raise DuplicateKeyError(f"{name}: key {tuple(key)} not unique, e.g. {dup.asDict()}")
        n = stored.count()
    store.log_parts(name, version, rows.schema, written)
    store.log_version(name, version, path, n)
    return Refreshed(n, 0, 0, 0, len(written))


def refresh(store: TableStore, name: str, df: DataFrame, key: Sequence[str], by: str | None = None,
            dealt: bool = False) -> Refreshed:
    """Make ``df`` the published contents of ``name``; ``by`` is its partition column (None: buckets of the key).

    ``dealt`` says that a task of ``df`` has rows of few parts only.

    Evaluated once: where there is a published version of these columns, the
    rows are held on the executors' disks while they are compared and written.
    Duplicate keys are refused, and nothing is published.
    """
    part = by or BUCKET_COLUMN
    rows = df if by else df.withColumn(part, F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int"))
    last = store.current_version(name)
    schema, held = store.parts(name, last) if last else (None, {})
    if schema is None or schema.simpleString() != rows.schema.simpleString():
        return _publish_first(store, name, rows, key, part, dealt)
    rows = rows.persist(StorageLevel.DISK_ONLY)
    try:
        dup = first_duplicate(rows, key)
        if dup:
            raise DuplicateKeyError(f"{name}: key {tuple(key)} not unique, e.g. {dup.asDict()}")
        version = new_version()
        found = _sides(rows, store.read(name), key, part).collect()  # one row per state and part
        counts = {}
        touched = set()
        for r in found:
            counts[r["state"]] = counts.get(r["state"], 0) + r["count"]
            if r["state"] != "unchanged":
                touched |= {p for s, p in (("new", r["_npart"]), ("gone", r["_opart"])) if r["state"] in (s, "changed")}
        value = F.col(part).cast("string")
        changed = rows.where(value.isin(sorted(p for p in touched if p is not None)) | (value.isNull() & F.lit(None in touched)))
        n = sum(c for s, c in counts.items() if s != "gone")
        path = store.version_path(name, version)
        # One task per part and slice of keys: a part is few files, a large one not one task's.
        slices = rows.sparkSession.sparkContext.defaultParallelism
        changed.repartition(F.col(part), F.pmod(F.xxhash64(*key), F.lit(slices))).write.partitionBy(part).parquet(path)
        written = store.folders(path)
        null = "__HIVE_DEFAULT_PARTITION__"
        gone = {null if p is None else p for p in touched}
        store.log_parts(name, version, rows.schema, {**{p: f for p, f in held.items() if p not in gone}, **written})
        store.log_version(name, version, path, n)
    finally:
        rows.unpersist()
    return Refreshed(*(counts.get(s, 0) for s in ("new", "changed", "gone", "unchanged")), len(written))


def read(store: TableStore, name: str) -> DataFrame:
    """The published rows without the bucket column."""
    return store.read(name).drop(BUCKET_COLUMN)
