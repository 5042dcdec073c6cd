"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from workgrid.session import scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
LOWER_BYTES = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage on storage that every executor can read, so a lost
    executor costs a re-read and not a recomputation.
    """
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null is the empty text."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], names: list[str]
) -> Iterator[dict[str, np.ndarray]]:
    """Groups of rows with equal integer ``keys`` from batches sorted by them.

    A group may run over several batches. Callers bound the group size, so
    no more than one group is held beside the current batch.
    """
    held: list[dict[str, np.ndarray]] = []
    held_key: tuple | None = None

    def joined() -> dict[str, np.ndarray]:
        return {n: np.concatenate([h[n] for h in held]) for n in names}

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {n: batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in {*keys, *names}}
        change = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            change |= cols[k][1:] != cols[k][:-1]
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            key = tuple(cols[k][a] for k in keys)
            if held and key != held_key:
                yield joined()
                held = []
            held_key = key
            held.append({n: cols[n][a:b] for n in names})
    if held:
        yield joined()
