"""Slowly changing dimension, type 2: keep every version of every source row.

History = source columns + five metadata columns:

    _scd_id           string   id of the version: md5(batch | row hash)
    _scd_valid_from   timestamp (no zone) the batch that inserted the version
    _scd_valid_to     timestamp (no zone) the batch that closed it, NULL while current
    _scd_is_current   boolean
    _scd_source_hash  string   md5 of the source values joined with "|"

A sync compares a source snapshot with the current versions by key
(null-safe equality, so NULL keys match NULL keys), then rebuilds the
history as ``unionByName`` of untouched, closed and inserted rows. All rows
of one batch share one timestamp, so a closed version's ``valid_to`` equals
its successor's ``valid_from``. Rows missing from the source stay current
(deletes are not detected). Without a key every source row is inserted as a
new version each batch and nothing is closed. Equal source rows of one
batch share an id, so they are opened and closed together.

Everything is a join or a union; nothing is collected to the driver, so a
snapshot of any size is processed by the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import row_hash

SCD_COLUMNS = ("_scd_id", "_scd_valid_from", "_scd_valid_to", "_scd_is_current", "_scd_source_hash")
NEW, CHANGED, UNCHANGED = "new", "changed", "unchanged"


def scd_schema(source: T.StructType) -> T.StructType:
    return T.StructType(
        list(source.fields)
        + [
            T.StructField("_scd_id", T.StringType(), False),
            T.StructField("_scd_valid_from", T.TimestampNTZType(), False),
            T.StructField("_scd_valid_to", T.TimestampNTZType(), True),
            T.StructField("_scd_is_current", T.BooleanType(), False),
            T.StructField("_scd_source_hash", T.StringType(), True),
        ]
    )


def empty_history(spark: SparkSession, source_schema: T.StructType) -> DataFrame:
    """A history table with no versions yet."""
    return spark.createDataFrame([], scd_schema(source_schema))


def with_row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cols = list(columns or df.columns)
    return df.withColumn("_scd_source_hash", row_hash(cols))


def batch_time(batch_ts: datetime):
    """The batch's time without a zone."""
    # From text, so the wall-clock value does not depend on any time zone.
    return F.lit(batch_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def _key_match(left_prefix: str, right_prefix: str, keys: Sequence[str]):
    cond = None
    for k in keys:
        term = F.col(f"{left_prefix}{k}").eqNullSafe(F.col(f"{right_prefix}{k}"))
        cond = term if cond is None else cond & term
    return cond


def latest_current(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One current version per key: the latest (valid_from, id), as a partial aggregate."""
    cur = history.where(F.col("_scd_is_current"))
    pick = F.max(F.struct("_scd_valid_from", "_scd_id", "_scd_source_hash")).alias("_v")
    return cur.groupBy(*keys).agg(pick).select(
        *keys, F.col("_v._scd_id").alias("_old_id"), F.col("_v._scd_source_hash").alias("_old_hash")
    )


def classify(source: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows with ``_scd_source_hash``, ``_change`` (new/changed/unchanged) and ``_old_id``."""
    src_cols = source.columns
    src = with_row_hash(source)
    if not keys:
        return src.withColumn("_change", F.lit(NEW)).withColumn("_old_id", F.lit(None).cast("string"))
    cur = latest_current(history, keys).select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_old_id", "_old_hash")
    j = src.join(cur, _key_match("", "_c_", keys), "left")
    found = F.col("_old_id").isNotNull()
    change = (
        F.when(~found, F.lit(NEW))
        .when(F.col("_old_hash").eqNullSafe(F.col("_scd_source_hash")), F.lit(UNCHANGED))
        .otherwise(F.lit(CHANGED))
    )
    return j.select(*src_cols, "_scd_source_hash", change.alias("_change"),
                    F.when(found & (change == CHANGED), F.col("_old_id")).alias("_old_id"))


def summary(classified: DataFrame) -> DataFrame:
    """Counts of new / changed / unchanged source rows (all three always present)."""
    c = F.col("_change")
    return classified.agg(
        F.count_if(c == NEW).alias("new"),
        F.count_if(c == CHANGED).alias("changed"),
        F.count_if(c == UNCHANGED).alias("unchanged"),
    )


def apply(history: DataFrame, source: DataFrame, keys: Sequence[str], batch_ts: datetime,
          batch_id: str | None = None, classified: DataFrame | None = None) -> DataFrame:
    """The history after one sync of ``source`` at ``batch_ts``."""
    bid = batch_id or batch_ts.isoformat(sep=" ")
    ts = batch_time(batch_ts)
    cls = classified if classified is not None else classify(source, history, keys)
    src_cols = source.columns
    inserted = cls.where(F.col("_change") != UNCHANGED).select(
        *src_cols,
        F.md5(F.concat_ws("|", F.lit(bid), F.col("_scd_source_hash"))).alias("_scd_id"),
        ts.alias("_scd_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("_scd_valid_to"),
        F.lit(True).alias("_scd_is_current"),
        "_scd_source_hash",
    )
    if not keys:
        return history.unionByName(inserted)
    closing = cls.where(F.col("_change") == CHANGED).select(F.col("_old_id").alias("_close_id")).distinct()
    h = history.join(closing, history["_scd_id"] == closing["_close_id"], "left")
    hit = F.col("_close_id").isNotNull()
    updated = h.select(
        *src_cols,
        "_scd_id",
        "_scd_valid_from",
        F.when(hit, ts).otherwise(F.col("_scd_valid_to")).alias("_scd_valid_to"),
        F.when(hit, F.lit(False)).otherwise(F.col("_scd_is_current")).alias("_scd_is_current"),
        "_scd_source_hash",
    )
    return updated.unionByName(inserted)


def current(history: DataFrame, source_columns: Sequence[str] | None = None) -> DataFrame:
    """Source columns of the current versions."""
    cols = list(source_columns or [c for c in history.columns if c not in SCD_COLUMNS])
    return history.where(F.col("_scd_is_current")).select(*cols)


def view_name(table_name: str) -> str:
    """Current-view name: the last ``_`` segment of the table name."""
    return table_name.split("_")[-1]
