"""Benchmark decontamination: size-partitioned MinHash containment search, exact check.

A test item is contained in a document if at least ``THRESHOLD`` of the
item's distinct five-word shingles occur in it. Documents are far longer than
items, so comparing MinHash values of both sides would dilute; the search
asks instead whether minimum-hash shingles of the item occur in the document.

Items are partitioned by size (powers of two). An item's sketch holds its
``m`` smallest shingle hashes, where ``m`` exceeds the number of shingles that
an item of its partition may miss. A document that contains the item misses
fewer than ``m``, so it holds at least one sketch shingle: the candidate
search loses nothing. Candidates are then checked by exact shingle
containment.

Documents are scanned once. Two bit tables (one of sketch hashes, one of all
item hashes) are broadcast, sized by the counted hashes between ``MIN_BITS``
and ``MAX_BITS``, so that few other shingles hit a bit; a document without a
sketch bit gives no row. The tables only save rows: whatever passes them meets
the items by hash, so a benchmark that fills the largest table costs more
shuffle and loses nothing. Surviving shingles join the items salted by
document, so a passage that a third of all documents share is spread.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from math import ceil, floor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from workgrid.llm.common import stored

SHINGLE = 5
THRESHOLD = 0.8
#: Sizes of a bit table as powers of two: 1 MiB to 16 MiB; between them ``SPARSE`` bits or more for each hash.
MIN_BITS, MAX_BITS, SPARSE = 23, 27, 64
SALTS = 8

_PUNCT = bytes(c for c in range(128) if not chr(c).isalnum())
_WORDS = bytes.maketrans(_PUNCT, b" " * len(_PUNCT))


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of characters that are not ASCII punctuation, space or control."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_WORDS).split()


def shingles(found: list[bytes], n: int) -> np.ndarray:
    """Distinct hashes of all runs of ``n`` words."""
    count = len(found) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    cuts = (joined[a : b - 1] for a, b in zip([0, *ends], ends[n - 1 :]))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, cuts), np.uint64, count))


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = words(text)
            if not found:
                continue
            n = min(SHINGLE, len(found))
            h = shingles(found, n).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * h.size, batch.schema.field(0).type), pa.array(h), pa.array(np.full(h.size, n, np.int32))],
                names=["item_id", "h", "width"],
            )


def table_bits(n: int) -> int:
    """Size of the bit table for ``n`` hashes, as a power of two."""
    return min(MAX_BITS, max(MIN_BITS, (SPARSE * n - 1).bit_length()))


def _table(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bit table of the hashes' leading bits; at most ``2**bits / 64`` rows reach the driver, as Arrow columns."""
    index = F.shiftrightunsigned("h", 64 - bits)
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {64 - bits}) & 63 AS INT))")
    parts = hashes.groupBy(F.shiftrightunsigned(index, 6).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[parts["at"].to_numpy()] = parts["bits"].to_numpy().view(np.uint64)
    return table


def _in_table(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    index = h >> np.uint64(64 - (table.size * 64 - 1).bit_length())
    return (table[index >> np.uint64(6)] >> (index & np.uint64(63))) & np.uint64(1) == 1


def sketch_size(n: Column, threshold: float) -> Column:
    """Minimum hashes to keep for an item of ``n`` shingles: one more than its size partition may miss."""
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(n)))
    return F.floor(F.lit(1.0 - threshold) * upper + 1e-9) + 1


def contained_items(
    spark: SparkSession, docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """``(doc_id, row, item_id, n_shared, n_shingles, containment)``: every document that contains a test item.

    ``docs(doc_id, text)``, ``items(item_id, text)``. ``row`` is the xxhash64 of
    the text and tells rows of equal ids apart; repeated rows give one result.

    * an item of fewer than five words is one shingle of all its words and is
      looked for at that width; an item without words is in no document;
    * null and empty documents contain nothing; null ids are ids like others;
    * rows that share an item id are one item; empty tables give an empty result;
    * other columns are ignored.
    """
    kind = items.schema["item_id"].dataType.simpleString()
    raw = items.select("item_id", F.col("text").cast("string")).mapInArrow(
        _item_rows, f"item_id {kind}, h long, width int"
    )
    sized = raw.distinct().withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("item_id")))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("h"))
    shingled = stored(
        spark, sized.withColumn("sketch", rank <= sketch_size(F.col("n"), threshold)), "items"
    )
    widths = sorted(r["width"] for r in shingled.select("width").distinct().collect())  # 1 to 5
    n = shingled.agg(F.count_if("sketch").alias("sketch"), F.count(F.lit(1)).alias("every")).first()
    tables = spark.sparkContext.broadcast(  # at most 2**MAX_BITS bits each
        (_table(shingled.where("sketch"), table_bits(n["sketch"])), _table(shingled, table_bits(n["every"])))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, every = tables.value
        for batch in batches:
            at, hashes = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                found = words(text)
                h = np.concatenate([shingles(found, n) for n in widths]) if widths else np.empty(0, np.uint64)
                h = h[_in_table(every, h)]
                if h.size and _in_table(sketch, h).any():
                    at.append(np.full(h.size, i))
                    hashes.append(h)
            take = pa.array(np.concatenate(at) if at else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array((np.concatenate(hashes) if hashes else np.empty(0, np.uint64)).view(np.int64)),
                ],
                names=["doc_id", "row", "h"],
            )

    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hits = docs.select("doc_id", F.xxhash64(text).alias("row"), text.alias("text")).mapInArrow(
        run, f"doc_id {doc_kind}, row long, h long"
    )
    salted = hits.withColumn("salt", F.pmod(F.xxhash64("row", "h"), F.lit(SALTS)).cast("int"))
    spread = shingled.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    shared = (
        salted.join(spread, ["h", "salt"])
        .groupBy("doc_id", "row", "item_id")
        .agg(F.countDistinct("h").alias("n_shared"), F.max("sketch").alias("sketched"), F.max("n").alias("n_shingles"))
    )
    return (
        shared.where(F.col("sketched") & (F.col("n_shared") >= F.ceil(F.col("n_shingles") * threshold - 1e-9)))
        .select(
            "doc_id", "row", "item_id", "n_shared", "n_shingles",
            (F.col("n_shared") / F.col("n_shingles")).alias("containment"),
        )
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text contains a test item; columns and other rows unchanged."""
    found = contained_items(spark, docs, items)
    bad = found.select(F.col("doc_id").alias("_bad_id"), F.col("row").alias("_bad_row")).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    same = docs["doc_id"].eqNullSafe(F.col("_bad_id")) & (F.xxhash64(text) == F.col("_bad_row"))
    return docs.join(bad.hint("shuffle_hash"), same, "left_anti")


ORACLE = """
WITH item_words AS (
  SELECT item_id, list_filter(string_split(regexp_replace(lower(text), '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
  FROM benchmark
), item_sh AS (
  SELECT DISTINCT item_id, s FROM (
    SELECT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS s FROM item_words)
), sizes AS (SELECT item_id, count(*) AS n FROM item_sh GROUP BY item_id
), doc_words AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(lower(text), '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
  FROM documents
), doc_sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS s FROM doc_words)
)
SELECT doc_id, item_id, count(*) AS n_shared, max(n) AS n_shingles, count(*) / max(n) AS containment
FROM doc_sh JOIN item_sh USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) * 10 >= max(n) * 8
"""
