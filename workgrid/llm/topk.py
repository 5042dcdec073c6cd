"""Exact top-k search by a three-phase uniform threshold.

Every vector's dimensions are cut into ``LISTS`` lists; a list scores a
candidate by the inner product of its own dimensions, and the sum over the
lists is the score. Rows are dealt into groups and queries into blocks; every
block meets every group once per pass, and a list's rows are taken in the
order of their length in that list:

1. *gather*: each list of a group names its ``k`` best partial scores per query;
   only these candidates get their other partial scores. Over all groups, the
   ``k``-th best total is a safe lower bound of the true ``k``-th score;
2. *threshold*: that bound travels with the query. A candidate that reaches it
   has a list with at least the bound divided by the number of lists (the
   uniform threshold), so each list names only the entries above it. Rows too
   short in a list to get there are not scored in it at all;
3. *resolve*: the named candidates get the partial scores of the lists that
   did not name them, and those whose total reaches the bound compete for the
   ``k`` best.

A group sends at most ``k`` rows per query and pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workgrid.llm.common import sorted_groups, stored

LISTS = 4
#: Queries of a block and rows of a group, on average.
BLOCK = 1024
GROUP = 8192
SCALE = 256.0
_ROWS = 1024
_EXACT = float(1 << 53)
_LOW = -(1 << 62)


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v array<double>)``: every component x as floor(256 * x); rows that take no part are left out."""
    ok = F.col("vec_id").isNotNull() & F.forall(
        "embedding", lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))
    )
    # floor as a double: exact for every finite component.
    scaled = F.transform("embedding", lambda x: (x.cast("double") * SCALE))
    return vectors.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"))


def _matrix(lists: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and floored components by vector length."""
    ends = lists.offsets.to_numpy()
    flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False))
    size = np.diff(ends)
    out = {}
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        at = (ends[rows] - ends[0])[:, None] + np.arange(d)
        out[int(d)] = (rows, flat[at])
    return out


def _best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best entries of every query: higher score, then smaller id; an id counts once with its best score."""
    order = np.lexsort((-score, ids, q))
    q, ids, score = q[order], ids[order], score[order]
    new = np.ones(q.size, bool)
    new[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
    q, ids, score = q[new], ids[new], score[new]
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if q.size else np.empty(0, np.int64)
    place = np.arange(q.size) - np.repeat(first, np.diff(np.r_[first, q.size]))
    return q[place < k], ids[place < k], score[place < k]


def _cuts(dims: int) -> list[slice]:
    ends = [dims * i // LISTS for i in range(LISTS + 1)]
    return [slice(a, b) for a, b in zip(ends, ends[1:])]


def _whole(queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides as plain integers where doubles could round."""
    if queries.size and rows.size and np.abs(queries).max() * np.abs(rows).max() * max(1, rows.shape[1]) * LISTS >= _EXACT:
        exact = np.vectorize(int, otypes=[object])
        return exact(queries), exact(rows)
    return queries, rows


def _length(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    return np.sqrt(np.einsum("ij,ij->i", x, x))


class Group:
    """Rows of one length, and per list their order by falling length in it."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.cuts = _cuts(rows.shape[1])
        lengths = [_length(rows[:, c]) for c in self.cuts]
        self.order = [np.argsort(-n, kind="stable") for n in lengths]
        self.lengths = [n[o] for n, o in zip(lengths, self.order)]

    def named(self, queries: np.ndarray, k: int, bound: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """``(list, query, row, partial)`` of the entries that each list names: its ``k`` + 1 best, or those over the threshold."""
        for at, (cut, order, lengths) in enumerate(zip(self.cuts, self.order, self.lengths)):
            q = queries[:, cut]
            until = len(order)
            if bound is not None:
                # No longer row is needed by any query: |q| * |row| bounds a partial score.
                need = bound / LISTS / np.maximum(_length(q), 1e-300)
                least = float(need.min(initial=np.inf)) * (1 - 1e-9) if (bound > 0).all() else -np.inf
                until = int(np.searchsorted(-lengths, -least, "right"))
            for lo in range(0, until, _ROWS):
                some = order[lo : min(lo + _ROWS, until)]
                part = q @ self.rows[some][:, cut].T
                if bound is None:
                    n = min(k + 1, some.size)  # one may be the query itself
                    top = np.argsort(part, axis=1)[:, -n:] if part.dtype == object else np.argpartition(part, some.size - n, axis=1)[:, some.size - n :]
                    i = np.repeat(np.arange(len(q)), n)
                    j = top.ravel()
                else:
                    i, j = np.nonzero((part * LISTS >= bound.astype(part.dtype)[:, None]).astype(bool))
                yield at, i, some[j], part[i, j]

    def resolved(self, queries: np.ndarray, k: int, bound: np.ndarray | None, counted: list[int] | None = None):
        """``(query, row, total)`` of every named candidate, each once: named partial scores and the missing ones."""
        n = len(self.ids)
        pairs, lists, parts = [], [], []
        for at, i, j, p in self.named(queries, k, bound):
            pairs.append(i.astype(np.int64) * n + j)
            lists.append(np.full(len(i), at))
            parts.append(p)
        if not pairs:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        pair, at, part = np.concatenate(pairs), np.concatenate(lists), np.concatenate(parts)
        each, place = np.unique(pair, return_inverse=True)
        total = np.zeros(each.size, part.dtype)
        np.add.at(total, place, part)
        have = np.zeros((LISTS, each.size), bool)
        have[at, place] = True
        q, r = each // n, each % n
        if counted is not None:
            counted[0] += each.size
        for held, cut in zip(have, self.cuts):
            missing = np.flatnonzero(~held)
            for lo in range(0, missing.size, _ROWS * 16):
                m = missing[lo : lo + _ROWS * 16]
                total[m] += (queries[q[m]][:, cut] * self.rows[r[m]][:, cut]).sum(axis=1)
        return q, r, total


def _longs(s: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in s], np.int64) if s.dtype == object else s.astype(np.int64)


def _lists_of(t: pa.Table) -> pa.Array:
    x = t.column("v").combine_chunks()
    return x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks)


def _pass(k: int, bounded: bool):
    """The ``k`` best of every query in one group: phase one, or phases two and three with the queries' bounds."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = tuple(np.empty(0, np.int64) for _ in range(3))
        if left.num_rows and right.num_rows:
            qids, ids = (t.column(c).to_numpy() for t, c in ((left, "query_id"), (right, "vec_id")))
            by_size = _matrix(_lists_of(right))
            found = []
            for d, (at, queries) in _matrix(_lists_of(left)).items():
                if d not in by_size:
                    continue
                mine, rows = by_size[d]
                queries, rows = _whole(queries, rows)
                bound = left.column("bound").to_numpy()[at] if bounded else None
                q, r, total = Group(ids[mine], rows).resolved(queries, k, bound)
                qid, rid = qids[at][q], ids[mine][r]
                take = qid != rid
                if bounded:
                    take &= (total >= bound[q].astype(total.dtype)).astype(bool)
                found.append(_best(qid[take], rid[take], _longs(total[take]), k))
            if found:
                out = tuple(np.concatenate(c) for c in zip(*found))
        return pa.table(dict(zip(["query_id", "vec_id", "score"], map(pa.array, out))))

    return run


def _merge(k: int):
    """Short lists of a query, sorted by it, merged into its ``k`` best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["query_id"], ["query_id", "vec_id", "score"]):
            q, ids, score = _best(g["query_id"], g["vec_id"], g["score"], k)
            cols = [q, np.arange(1, q.size + 1, dtype=np.int32), ids, score]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["query_id", "rank", "vec_id", "score"])

    return run


_SHORT = "query_id long, vec_id long, score long"


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 5, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest inner products of every query with all other rows.

    ``vectors(vec_id, embedding)``; queries are the rows where ``is_query`` holds. ``block`` and ``group`` are the
    queries of a block and the rows of a group, on average.

    * ties go to the smaller ``vec_id``; fewer than ``k`` candidates give all;
    * vectors that are null or hold null or non-finite components, and rows without ``vec_id``, take no part;
    * only vectors of equal length score with each other; an empty vector scores 0;
    * rows that share a ``vec_id`` are one candidate with its best score, and one query with its smallest vector;
    * scores are exact integers; one that does not fit in a long raises an error;
    * an empty table, or one without queries, gives an empty result; other columns are ignored.
    """
    rows = stored(spark, integer_vectors(vectors).distinct(), "topk_rows")
    queries = stored(spark, integer_vectors(vectors.where(is_query)).groupBy("vec_id").agg(F.min("v").alias("v")).select(
        F.col("vec_id").alias("query_id"), "v"), "topk_queries")
    groups, blocks = (max(1, -(-df.count() // size)) for df, size in ((rows, group), (queries, block)))
    dealt = rows.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups)).cast("int").alias("g"),
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))

    def best(some: DataFrame, bounded: bool) -> DataFrame:
        sent = some.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
                           F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("b"))
        short = sent.groupBy("g", "b").cogroup(dealt.groupBy("g", "b")).applyInArrow(_pass(k, bounded), _SHORT)
        return short.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(
            _merge(k), "query_id long, rank int, vec_id long, score long")

    seen = best(queries, False).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
    low = F.when(F.col("n") == k, F.col("low")).otherwise(F.lit(_LOW))
    bounds = stored(spark, seen.select(F.col("query_id").alias("bound_id"), low.alias("bound")), "topk_bounds")
    return best(queries.join(bounds, F.col("query_id") == F.col("bound_id")).drop("bound_id"), True)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
