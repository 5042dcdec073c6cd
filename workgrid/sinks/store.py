"""Versioned Parquet tables with an append-only version log.

Each publish writes the data to a fresh folder, then appends one row
(version, path, rows) to the table's version log. Readers take the latest
logged version, so they see either the old or the new data, never a half
written folder: the data folder is complete before its log row exists, and
the log row itself is committed by Spark's output committer. This replaces
"refresh materialized view concurrently" and works on any shared file
system the cluster names (the root defaults to ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import dropped_shuffles, ensure_checkpoint_dir

_LOG_SCHEMA = T.StructType([
    T.StructField("version", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("rows", T.LongType(), True),
    T.StructField("published_at", T.TimestampNTZType(), False),
])

#: Parts of a version that is put together from folders of several versions.
_PARTS_SCHEMA = T.StructType([
    T.StructField("version", T.StringType(), False),
    T.StructField("part", T.StringType(), True),
    T.StructField("folder", T.StringType(), True),
    T.StructField("schema", T.StringType(), False),
])


class DuplicateKeyError(ValueError):
    pass


class UnloggedDataError(RuntimeError):
    """A table folder holds data, but its version log is missing."""


def new_version() -> str:
    """Sortable, unique version id."""
    return datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (an aggregate, partial on the map side)."""
    return df.groupBy(*key).count().where(F.col("count") > 1)


def first_duplicate(df: DataFrame, key: Sequence[str]) -> Row | None:
    """A key that occurs more than once, or None.

    A key that repeats has a hash that repeats: the short hashes are grouped,
    and only where one repeats are the keys themselves.
    """
    keys = df.select(*key)
    with dropped_shuffles(df.sparkSession):
        if duplicate_keys(keys.select(F.xxhash64(*key).alias("_h")), ["_h"]).isEmpty():
            return None
        return next(iter(duplicate_keys(keys, key).limit(1).collect()), None)


class TableStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or (ensure_checkpoint_dir(spark).rstrip("/") + "/workgrid/store")).rstrip("/")

    def _log_path(self, name: str) -> str:
        return f"{self.root}/{name}/_versions"

    def _files(self, path: str):
        """The file system of ``path`` and the path in its terms."""
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def versions(self, name: str) -> DataFrame:
        """The version log; empty only if no log exists. Any failure to look or read is raised."""
        fs, at = self._files(self._log_path(name))
        if not fs.exists(at):
            return self.spark.createDataFrame([], _LOG_SCHEMA)
        return self.spark.read.schema(_LOG_SCHEMA).parquet(self._log_path(name))

    def unlogged_folders(self, name: str) -> list[str]:
        """Version folders that the log does not name (left by writes that died)."""
        fs, at = self._files(f"{self.root}/{name}")
        if not fs.exists(at):
            return []
        logged = {r["version"] for r in self.versions(name).select("version").collect()}
        found = (s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("version="))
        return sorted(p.toString() for p in found if p.getName().removeprefix("version=") not in logged)

    def discard_unlogged(self, name: str) -> int:
        """Delete the folders that no log row names; returns how many. Not while a write to the table runs."""
        folders = self.unlogged_folders(name)
        for f in folders:
            fs, at = self._files(f)
            fs.delete(at, True)
        return len(folders)

    def expire(self, name: str, keep: int = 2) -> int:
        """Delete the files of all but the newest ``keep`` logged versions of a full-refresh table; returns how many.

        Not for SCD2 tables, whose history lives in every version.
        """
        old = self.versions(name).orderBy(F.col("version").desc()).offset(max(1, keep)).collect()
        deleted = 0
        for r in old:
            fs, at = self._files(r["path"])
            deleted += bool(fs.delete(at, True))
        return deleted

    def current_path(self, name: str) -> str | None:
        row = self.versions(name).agg(F.max_by("path", "version").alias("p")).first()
        return row["p"] if row else None

    def current_version(self, name: str) -> str | None:
        row = self.versions(name).agg(F.max("version").alias("v")).first()
        return row["v"] if row else None

    def exists(self, name: str) -> bool:
        return self.current_path(name) is not None

    def read(self, name: str) -> DataFrame:
        version = self.current_version(name)
        if version is None:
            raise KeyError(f"table {name!r} has no published version under {self.root}")
        schema, folders = self.parts(name, version)
        if schema is None:
            return self.spark.read.parquet(self.current_path(name))
        if not folders:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*folders.values())
        return found.select(*schema.names)

    def parts(self, name: str, version: str) -> tuple[T.StructType | None, dict[str, str]]:
        """Schema and folders by part of a version that was published in parts; (None, {}) for any other."""
        fs, at = self._files(f"{self.root}/{name}/_parts")
        if not fs.exists(at):
            return None, {}
        found = self.spark.read.schema(_PARTS_SCHEMA).parquet(f"{self.root}/{name}/_parts").where(F.col("version") == version)
        rows = found.collect()  # one row per part
        schema = T.StructType.fromJson(json.loads(rows[0]["schema"])) if rows else None
        return schema, {r["part"]: r["folder"] for r in rows if r["folder"] is not None}

    def log_parts(self, name: str, version: str, schema: T.StructType, folders: dict[str, str]) -> None:
        """Name the folders that make up ``version``; to be called before ``log_version``."""
        text = schema.json()
        rows = [(version, p, f, text) for p, f in folders.items()] or [(version, None, None, text)]
        parts = self.spark.createDataFrame(rows, _PARTS_SCHEMA)
        parts.coalesce(1).write.mode("append").parquet(f"{self.root}/{name}/_parts")

    def folders(self, path: str) -> dict[str, str]:
        """Partition folders (``column=value``) below ``path``: value to path."""
        fs, at = self._files(path)
        found = (s.getPath() for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName())
        return {p.getName().split("=", 1)[1]: p.toString() for p in found}

    def version_path(self, name: str, version: str) -> str:
        return f"{self.root}/{name}/version={version}"

    def publish(self, name: str, df: DataFrame, key: Sequence[str] | None = None,
                partition_by: Sequence[str] | None = None, version: str | None = None) -> str:
        """Write ``df`` as the next version of ``name``.

        The data is written once; the key check then reads only the key
        columns of the written files (the plan that produced ``df`` is not
        run a second time). A version with duplicate keys is never logged,
        so readers keep seeing the previous version.
        """
        version = version or new_version()
        path = self.version_path(name, version)
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        written = self.spark.read.parquet(path)
        if key:
            dup = first_duplicate(written, key)
            if dup:
                raise DuplicateKeyError(f"{name}: key {tuple(key)} not unique, e.g. {dup.asDict()}")
        rows = written.count()
        self.log_version(name, version, path, rows)
        return path

    def log_version(self, name: str, version: str, path: str, rows: int | None) -> None:
        """Append one row to the version log; this is the publish point."""
        log = self.spark.createDataFrame(
            [(version, path, rows, datetime.now(timezone.utc).replace(tzinfo=None))], _LOG_SCHEMA
        )
        log.coalesce(1).write.mode("append").parquet(self._log_path(name))

    def register_view(self, name: str, view: str | None = None) -> DataFrame:
        df = self.read(name)
        df.createOrReplaceTempView(view or name)
        return df
