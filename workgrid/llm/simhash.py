"""SimHash near-duplicates: pigeonhole blocks, join on blocks, Hamming check.

A fingerprint of 64 bits is cut into ``max_bits + 2`` blocks. Two fingerprints
that differ in at most ``max_bits`` bits agree on at least two blocks, so they
meet under at least one pair of blocks (15 keys of about 21 bits for the
default 4 bits). Equal fingerprints are one node from the start, so copies
never meet in pairs.

A key may hold very many fingerprints (a large family of near copies). No key
is compared pair by pair in one task:

1. every member of a key is compared with three pivots of its key; these links
   already tie nearly all members of a dense family together;
2. components of these links are taken over all keys;
3. only keys that still hold several components are looked at again. Members
   outside a key's largest component are compared with all members of the key,
   in cells of bounded size spread over many tasks; a cell returns at most a
   spanning forest of component pairs.

Every pair within the distance is either compared or already in one
component, so the components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workgrid.llm.common import LOWER_BYTES, sorted_groups, stored, utf8
from workgrid.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BITS = 64
CELL = 4096
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text; a text without words gives 0.

    Words are runs of anything but ASCII white space after lower-casing A-Z;
    a text with fewer words than a shingle has one shingle of all its words.
    """
    words = utf8(text).translate(LOWER_BYTES).split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    n = len(words) - shingle + 1
    starts = [0, *ends[: n - 1]]
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, n, _CHUNK):
        hi = min(lo + _CHUNK, n)
        cuts = [joined[a : b - 1] for a, b in zip(starts[lo:hi], ends[lo + shingle - 1 : hi + shingle - 1])]
        h = np.fromiter(map(xxhash.xxh64_intdigest, cuts, repeat(SEED)), "<u8", hi - lo)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint of every row's whole text, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, fp long")


def block_masks(max_bits: int) -> list[int]:
    """Bit masks of every pair of blocks, as signed 64-bit integers."""
    blocks = max_bits + 2
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [int(np.uint64(x | y).view(np.int64)) for x, y in combinations(masks, 2)]


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _keys(nodes: DataFrame, max_bits: int) -> DataFrame:
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(block_masks(max_bits))]
    return nodes.select("rep", "fp", F.explode(F.array(*keys)).alias("key"))


def _cell_links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["key", "ub", "ab"], ["fp", "comp", "source"]):
            fp, comp, source = g["fp"].view(np.uint64), g["comp"], g["source"].astype(bool)
            root: dict[int, int] = {}

            def find(x: int) -> int:
                while (y := root.get(x, x)) != x:
                    root[x] = root.get(y, y)
                    x = y
                return x

            pairs = []
            t_fp, t_comp = fp[~source], comp[~source]
            for f, c in zip(fp[source], comp[source].tolist()):
                near = t_comp[(np.bitwise_count(t_fp ^ f) <= max_bits) & (t_comp != c)]
                for other in np.unique(near).tolist() if near.size else ():
                    if (x := find(c)) != (y := find(other)):
                        root[x] = y
                        pairs.append((c, other))
            if pairs:
                a, b = zip(*pairs)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def link_components(spark: SparkSession, nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(node, root)`` over distinct fingerprints ``nodes(rep long, fp long)``; nodes without links may be missing."""
    keys = _keys(nodes, max_bits)
    pivot = F.struct("rep", "fp")
    shared = (
        keys.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(pivot).alias("p1"),
            F.max(pivot).alias("p2"),
            F.min(F.struct(F.xxhash64("rep").alias("h"), "rep", "fp")).alias("p3"),
        )
        .where("n > 1")
        .select("key", "n", F.array("p1", "p2", F.struct(F.col("p3.rep").alias("rep"), F.col("p3.fp").alias("fp"))).alias("pivots"))
    )
    members = stored(spark, keys.join(shared, "key"), "members")
    near = F.filter("pivots", lambda p: (p["rep"] != F.col("rep")) & (_distance(p["fp"], F.col("fp")) <= max_bits))
    links = members.select("rep", F.explode(near).alias("p")).select(F.col("rep").alias("a"), F.col("p.rep").alias("b"))
    first = connected_components(spark, links)

    # Keys of two members are settled by their pivots.
    placed = stored(
        spark,
        members.where("n > 2")
        .select("key", "rep", "fp")
        .join(first, F.col("rep") == F.col("node"), "left")
        .select("key", "fp", F.coalesce("root", "rep").alias("comp")),
        "placed",
    )
    split = (
        placed.groupBy("key", "comp")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("main"))
        .where("parts > 1")
        .select(
            "key",
            F.ceil(F.col("n") / CELL).alias("cells"),
            F.ceil((F.col("n") - F.col("main.n")) / CELL).alias("ucells"),
            F.col("main.comp").alias("main"),
        )
    )
    rows = placed.join(split, "key").withColumn("h", F.xxhash64("fp"))
    to = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    targets = rows.withColumn("ab", F.pmod("h", "cells")).select(
        "key", "fp", "comp", F.lit(0).alias("source"), F.explode(to("ucells")).alias("ub"), "ab"
    )
    sources = rows.where("comp != main").withColumn("ub", F.pmod("h", "ucells")).select(
        "key", "fp", "comp", F.lit(1).alias("source"), "ub", F.explode(to("cells")).alias("ab")
    )
    more = (
        targets.unionByName(sources)
        .repartition("key", "ub", "ab")
        .sortWithinPartitions("key", "ub", "ab")
        .mapInArrow(_cell_links(max_bits), "a long, b long")
    )
    second = connected_components(spark, more).select(F.col("node").alias("root"), F.col("root").alias("last"))
    both = first.join(second, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    # A node without a first-round link is its own component there.
    return both.unionByName(
        second.join(first, second["root"] == first["node"], "left_anti").select(F.col("root").alias("node"), F.col("last").alias("root"))
    )


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs(doc_id, text, ...)``.

    * ``fingerprint``: 16 lowercase hex digits; null and empty texts have zero
      and link with each other like any others;
    * ``component_id``: the smallest ``doc_id`` reachable by links of at most
      ``max_bits`` differing bits, itself included;
    * rows that share a ``doc_id`` are one document: their texts are linked by the id;
    * a row without ``doc_id`` takes the component of its fingerprint (null if no row of
      that fingerprint has an id) and never ties others together;
    * an empty table gives an empty result; other columns are ignored.
    """
    fps = stored(spark, fingerprints(docs, shingle), "fingerprints")
    ids = fps.where(F.col("doc_id").isNotNull())
    nodes = stored(spark, ids.groupBy("fp").agg(F.min(F.col("doc_id").cast("long")).alias("rep")), "nodes")
    # Two fingerprints under one doc_id are one node: they are linked by their id.
    comps = link_components(spark, nodes, max_bits)
    by_fp = nodes.join(comps, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "rep").alias("component_id")
    )
    return fps.join(by_fp, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"), "component_id"
    )


def one_per_group(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without the rows whose id is not the smallest of its near-duplicate group; rows without an id stay."""
    found = near_duplicates(spark, docs, shingle, max_bits)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone.hint("shuffle_hash"), docs["doc_id"] == F.col("_gone"), "left_anti")
