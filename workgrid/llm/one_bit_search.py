"""Approximate nearest neighbours by randomly rotated one-bit codes.

Index. Every vector ``x`` belongs to the nearest of a few centres ``c`` (k-means on a
bounded sample). Its residual ``x - c = r * o`` is rotated by a random matrix with
orthonormal columns into ``D`` dimensions, and only the signs are kept: ``D`` packed
bits, the corners ``s`` of a cube. With ``a = <s, R o> / sqrt(D)``,

    <o, u> is estimated by <s, R u> / (a * sqrt(D))

without bias over rotations, and it is off by at most
``|u| * sqrt((1 - a * a) / (a * a)) * EPSILON / sqrt(D - 1)`` but for a small share of
rotations. So an inner product ``<x, q> = r * <o, q - c> + <x, c> - <c, c> + <c, q>`` takes the
bits, four correction scalars of the vector, and one matrix product for many
queries and vectors.

Search. Codes are dealt into groups and queries into blocks; each block meets each
group once per pass.

1. every group reranks its ``k`` best estimates; the ``k``-th exact score over all
   groups is a cutoff that the true ``k``-th nearest reaches;
2. every vector whose estimate plus error bound reaches the cutoff is reranked on
   the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from workgrid.llm.common import stored
from workgrid.llm.hard_negatives import best_per_key

#: Bits per dimension (a multiple of 64 in all), and the width of the error bound in its standard errors.
BITS = 8
EPSILON = 1.9
#: The centres are fitted on this many vectors (smallest id hashes) at most.
SAMPLE = 4096
CELLS = 64
_STEPS = 8
#: Codes of a group and queries of a block, on average; codes taken at once.
GROUP = 8192
BLOCK = 1024
_CODES = 2048
_SEED = 13

INDEX = "vec_id long, d int, cell int, code binary, factor double, shift double, base double, error double, radius double, length double"
_FOUND = "d int, g int, query_id long, v array<double>, ids array<long>"


def finite_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v array<double>)``, one row per id: no null, zero or non-finite vector."""
    def fits(c):
        c = c.cast("double")
        return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))

    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", fits)
    ok = ok & F.exists("embedding", lambda c: c != 0)
    rows = vectors.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: c.cast("double")).alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(lists: pa.Array, d: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), d)


def _array(column) -> pa.Array:
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks)


def code_bits(d: int) -> int:
    return 64 * -(-d * BITS // 64)


@lru_cache(maxsize=4)
def rotation(d: int) -> np.ndarray:
    """``(bits, d)`` with orthonormal columns, the same in every task."""
    g = np.random.default_rng([_SEED, d]).normal(size=(code_bits(d), d))
    q, r = np.linalg.qr(g)
    return np.ascontiguousarray(q * np.sign(np.diag(r)))


def _centres(sample: pa.Table) -> dict[int, np.ndarray]:
    """K-means centres by vector length."""
    out = {}
    lists = sample.column("v").to_pylist()
    for d in sorted({len(v) for v in lists}):
        x = np.array([v for v in lists if len(v) == d])
        c = x[: max(1, min(CELLS, len(x) // 16))].copy()
        for _ in range(_STEPS):
            near = nearest(x, c)
            for i in range(len(c)):
                if (near == i).any():
                    c[i] = x[near == i].mean(axis=0)
        out[d] = c
    return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin(np.einsum("ij,ij->i", centres, centres) - 2 * (x @ centres.T), axis=1)


def encode(x: np.ndarray, centres: np.ndarray) -> dict[str, np.ndarray]:
    """Codes and correction scalars of the rows of ``x``."""
    d = x.shape[1]
    bits, turn = code_bits(d), rotation(d)
    cell = nearest(x, centres)
    c = centres[cell]
    rest = x - c
    radius = np.sqrt(np.einsum("ij,ij->i", rest, rest))
    turned = (rest / np.where(radius > 0, radius, 1.0)[:, None]) @ turn.T
    positive = turned >= 0
    signs = np.where(positive, 1.0, -1.0)
    a = np.where(radius > 0, np.abs(turned).sum(axis=1) / np.sqrt(bits), 1.0)
    factor = radius / (a * np.sqrt(bits))
    return {
        "cell": cell.astype(np.int32),
        "code": np.packbits(positive, axis=1),
        "factor": factor,
        "shift": factor * np.einsum("ij,ij->i", signs, (centres @ turn.T)[cell]),
        "base": np.einsum("ij,ij->i", rest, c),
        "error": radius * np.sqrt(np.maximum(1 - a * a, 0.0)) / a * EPSILON / np.sqrt(max(bits - 1, 1)),
        "radius": radius,
        "length": np.sqrt(np.einsum("ij,ij->i", x, x)),
    }


def build_index(spark: SparkSession, members: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """A code and its correction scalars for every row of ``members(vec_id, v)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = np.diff(whole.column(1).offsets.to_numpy())
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                for part in np.array_split(at, max(1, -(-len(at) // _CODES))):
                    b = whole.take(pa.array(part))
                    with np.errstate(all="ignore"):
                        e = encode(_matrix(b.column(1), int(d)), centres.get(int(d), np.zeros((1, int(d)))))
                    cols = [b.column(0), pa.array(np.full(len(part), d, np.int32)), pa.array(e["cell"]),
                            pa.array([r.tobytes() for r in e["code"]], pa.binary()),
                            *(pa.array(e[k]) for k in ("factor", "shift", "base", "error", "radius", "length"))]
                    yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in INDEX.split(", ")])

    return members.select("vec_id", "v").mapInArrow(run, INDEX)


def estimates(t: dict[str, np.ndarray], at: slice, q: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of queries and codes, and their error bounds."""
    d = q.shape[1]
    turned = (q @ rotation(d).T).astype(np.float32)
    bits = np.unpackbits(t["code"][at], axis=1, count=code_bits(d)).astype(np.float32) * 2 - 1
    cell = t["cell"][at]
    est = (turned @ bits.T) * t["factor"][at] + (t["base"] - t["shift"])[at] + (q @ centres.T)[:, cell]
    far = q[:, None, :] - centres[None, :, :] if len(centres) * q.size <= 1 << 22 else None
    if far is None:
        far2 = np.stack([np.einsum("ij,ij->i", q - c, q - c) for c in centres], axis=1)
    else:
        far2 = np.einsum("ijk,ijk->ij", far, far)
    size = np.sqrt(np.einsum("ij,ij->i", q, q))
    # The second term covers rounding: the product is taken in single precision.
    err = np.sqrt(far2)[:, cell] * t["error"][at] + size[:, None] * (1e-5 * t["radius"] + 1e-11 * t["length"])[at]
    return est, err


def _gather(centres: dict[int, np.ndarray], k: int, with_cutoff: bool):
    """Per query and group the codes to rerank: the ``k`` best estimates, or all that may reach the cutoff."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        queries, lists = [], []
        if left.num_rows and right.num_rows:
            d = left.column("d")[0].as_py()
            qid = _array(left.column("query_id")).to_numpy()
            v = _array(left.column("v"))
            q = _matrix(v, d)
            c = centres.get(d, np.zeros((1, d)))
            t = {n: _array(right.column(n)).to_numpy(zero_copy_only=False) for n in ("vec_id", "cell", "factor", "shift", "base", "error", "radius", "length")}
            t["code"] = np.frombuffer(b"".join(right.column("code").to_pylist()), np.uint8).reshape(right.num_rows, -1)
            ids = t["vec_id"]
            low = _array(left.column("cutoff")).to_numpy(zero_copy_only=False) if with_cutoff else None
            parts = [slice(lo, lo + _CODES) for lo in range(0, len(ids), _CODES)]
            best = (np.full((len(qid), 0), -np.inf), np.empty((len(qid), 0), np.int64))
            chosen = [[] for _ in qid]
            for at in parts:
                with np.errstate(all="ignore"):
                    est, err = estimates(t, at, q, c)
                    own = qid[:, None] == ids[at][None, :]
                    if with_cutoff:
                        # What cannot be told (an overflow) is reranked.
                        take = ~(est + err < low[:, None]) & ~own
                        for i in np.flatnonzero(take.any(axis=1)):
                            chosen[i].append(ids[at][take[i]])
                    else:
                        est = np.where(own, -np.inf, est)
                        both = np.concatenate([best[0], est], axis=1)
                        which = np.concatenate([best[1], np.broadcast_to(ids[at], est.shape)], axis=1)
                        n = min(k, both.shape[1])
                        top = np.argpartition(-both, n - 1, axis=1)[:, :n]
                        best = (np.take_along_axis(both, top, axis=1), np.take_along_axis(which, top, axis=1))
            if not with_cutoff:
                chosen = [[w[w != i]] for i, w in zip(qid, best[1])]
            found = [np.concatenate(x) if x else np.empty(0, np.int64) for x in chosen]
            queries = [i for i, x in enumerate(found) if len(x)]
            lists = [found[i] for i in queries]
        n = len(queries)
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]).astype(np.int32)
        flat = np.concatenate(lists) if n else np.empty(0, np.int64)
        at = pa.array(queries, pa.int64())
        return pa.table({
            "d": left.column("d").take(at), "g": left.column("g").take(at), "query_id": left.column("query_id").take(at),
            "v": left.column("v").take(at), "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64())),
        })

    return run


def _rerank(k: int):
    """Exact scores of the chosen vectors of one group, the ``k`` best per query."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            d = left.column("d")[0].as_py()
            ids = _array(right.column("vec_id")).to_numpy()
            order = np.argsort(ids)
            ids, x = ids[order], _matrix(_array(right.column("v")), d)[order]
            q = _matrix(_array(left.column("v")), d)
            lists = _array(left.column("ids"))
            ends, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy()
            for i, qid in enumerate(_array(left.column("query_id")).to_pylist()):
                some = flat[ends[i] - ends[0] : ends[i + 1] - ends[0]]
                with np.errstate(all="ignore"):
                    score = (x[np.searchsorted(ids, some)] * q[i]).sum(axis=1)
                top = np.lexsort((some, -score))[:k]
                out[0].append(np.full(len(top), qid))
                out[1].append(some[top])
                out[2].append(score[top])
        cols = [np.concatenate(c) if c else np.empty(0, kind) for c, kind in zip(out, (np.int64, np.int64, float))]
        return pa.table(dict(zip(["query_id", "id", "score"], map(pa.array, cols))))

    return run


def nearest_neighbours(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows with the largest inner product found for every query.

    ``vectors(vec_id, embedding)``; queries are the rows where ``is_query`` (over ``vec_id``) holds, candidates all
    rows but the query's own. Scores are exact, in double precision; a true neighbour is missed only where its estimate
    is further off than its error bound.

    * ties go to the smaller ``vec_id``; fewer than ``k`` candidates give all;
    * vectors that are null, zero or hold null or non-finite components, and rows without ``vec_id``, take no part;
    * rows that share a ``vec_id`` count as one, with the smallest vector; only vectors of equal length are compared;
    * of equal vectors the ``k + 1`` smallest ids are indexed: no other can be among the ``k`` nearest of a query;
    * a vector whose estimate overflows is always reranked;
    * an empty table, or one without queries, gives an empty result; other columns are ignored, whatever their names.
    """
    rows = stored(spark, finite_vectors(vectors.select("vec_id", "embedding")), "one_bit_rows")
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    members = stored(spark, rows.withColumn("at", first).where(F.col("at") <= k + 1).drop("at"), "one_bit_members")
    sample = members.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()  # bounded
    with np.errstate(all="ignore"):
        centres = _centres(sample)
    index = stored(spark, build_index(spark, members, centres), "one_bit_index")
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("d"))
    groups, blocks = (max(1, -(-df.count() // size)) for df, size in ((index, GROUP), (queries, BLOCK)))
    group = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("g")
    codes = index.select("*", group, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    dealt = members.select("vec_id", "v", F.size("v").alias("d"), group)

    def best(some: DataFrame, with_cutoff: bool) -> DataFrame:
        block = some.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
                            F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("b"))
        chosen = block.groupBy("d", "g", "b").cogroup(codes.groupBy("d", "g", "b")).applyInArrow(
            _gather(centres, k, with_cutoff), _FOUND)
        short = chosen.groupBy("d", "g").cogroup(dealt.groupBy("d", "g")).applyInArrow(
            _rerank(k), "query_id long, id long, score double")
        return best_per_key(short, ["query_id"], k, "double")

    seen = best(queries, False).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
    low = F.when(F.col("n") == k, F.col("low")).otherwise(F.lit(float("-inf")))
    cutoff = stored(spark, seen.select(F.col("query_id").alias("cut_id"), low.alias("cutoff")), "one_bit_cutoffs")
    with_cutoff = queries.join(cutoff, F.col("query_id") == F.col("cut_id")).drop("cut_id")
    return best(with_cutoff, True).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
