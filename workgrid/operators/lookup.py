"""Lookup-side helpers: deterministic DISTINCT ON, and left joins on keys that are often NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_SPREAD = 1024


def first_per_key(df: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row per key: the smallest payload tuple, NULL fields first.

    This is SQL ``DISTINCT ON (keys) ... ORDER BY keys, payload NULLS FIRST``
    with the tie rule made explicit. It is a plain ``groupBy`` + ``min`` over
    a struct, so Spark aggregates partially on the map side before the
    shuffle: a hot key costs one row per map task, not one row per input row.
    """
    keys, payload = list(keys), list(payload)
    agg = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in payload])).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in payload])


def left_join_sparse(left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: str) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on a key that may be NULL for many left rows.

    NULL matches nothing, but all NULL keys would shuffle to one task. Those
    rows get a second join key of ``NULL_SPREAD`` values (from ``spread_by``)
    instead, which spreads them; rows with a key have the value 0 on both
    sides. The result is that of the plain join.
    """
    spread: Column = F.when(F.col(left_key).isNotNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(spread_by), F.lit(NULL_SPREAD)).cast("int") + 1
    )
    keyed = right.withColumn("_spread_r", F.lit(0))
    same = (F.col(left_key) == F.col(right_key)) & (F.col("_spread_l") == F.col("_spread_r"))
    return left.withColumn("_spread_l", spread).join(keyed, same, "left").drop("_spread_l", "_spread_r")
