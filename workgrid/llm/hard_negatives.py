"""Hard-negative mining by coordinate pruning in length buckets.

An anchor's positives are the rows of its label that score highest with it;
a positive's hard negatives are rows of other labels that score a little
less. Both are searches for the largest inner products, done the same way:

* rows and anchors are dealt into groups of bounded size, and every anchor
  block meets every group of rows it can use once (anchors of a label and
  rows of that label for the positives, all rows for the negatives);
* in a group the rows lie in *length buckets*, longest first, each with a sorted
  list of its unit vectors' values for every coordinate;
* an anchor that needs a score of at least ``t`` needs a cosine of at least
  ``t / (|anchor| * longest)`` in a bucket. A bucket that cannot give that is
  skipped. Otherwise each of the anchor's *focus* coordinates (its largest)
  has a feasible range of values, a slice of that coordinate's sorted list;
  the slices intersect to the candidates, and only these are scored exactly;
* ``t`` rises with the scores found in the group so far.

A group sends at most its short lists on; they are merged per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workgrid.llm.common import sorted_groups, stored

SCALE = 256.0
#: Rows of a group (on average), anchors of a block (on average), rows of a length bucket.
GROUP = 4096
ANCHORS = 1024
BUCKET = 512
#: Focus coordinates of an anchor.
FOCUS = 4
#: Hard negatives score between these hundredths of the positive's score.
LOW, HIGH = 50, 95
_EXACT = float(1 << 53)
_NONE = -(1 << 62)
_SLACK = 1e-9


def integer_rows(vectors: DataFrame, label: str = "label") -> DataFrame:
    """``(vec_id, label, x array<double>)`` with whole components floor(256 * c), one row per ``vec_id``."""
    def fits(c):
        c = c.cast("double")
        return F.coalesce(~F.isnan(c) & (F.abs(c * SCALE) < float("inf")), F.lit(False))

    ok = F.col("vec_id").isNotNull() & F.col(label).isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", fits)
    scaled = F.transform("embedding", lambda c: c.cast("double") * SCALE)
    rows = vectors.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), scaled.alias("x"))
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r"))
    return one.select("vec_id", "r.label", "r.x")


def matrix(lists: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and floored components by vector length."""
    ends = lists.offsets.to_numpy()
    flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False))
    size = np.diff(ends)
    out = {}
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        out[int(d)] = (rows, flat[(ends[rows] - ends[0])[:, None] + np.arange(d)])
    return out


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b`` as longs; an error if one does not fit."""
    most = (np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0)) * max(1, b.shape[1])
    if most < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    got = whole(a) @ whole(b).T
    return np.array([[int(v) for v in r] for r in got], np.int64).reshape(got.shape)


class Bucket:
    """Rows of similar length: exact vectors, and sorted lists of the unit vectors' values per coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, length: np.ndarray):
        self.ids, self.labels, self.x, self.longest = ids, labels, x, float(length.max())
        unit = x / np.where(length > 0, length, 1.0)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.lists = np.take_along_axis(unit, self.order, axis=0)

    def slices(self, unit: np.ndarray, focus: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) position in the list of every anchor's focus coordinates."""
        reach = np.arccos(np.clip(cosine, -1.0, 1.0))[:, None]
        angle = np.arccos(np.clip(np.take_along_axis(unit, focus, axis=1), -1.0, 1.0))
        low = np.cos(np.minimum(angle + reach, np.pi)) - _SLACK
        high = np.cos(np.maximum(angle - reach, 0.0)) + _SLACK
        first, last = np.zeros(focus.shape, np.int64), np.full(focus.shape, len(self.ids))
        for c in np.unique(focus):
            here = focus == c
            first[here] = np.searchsorted(self.lists[:, c], low[here], "left")
            last[here] = np.searchsorted(self.lists[:, c], high[here], "right")
        return first, last

    def candidates(self, unit: np.ndarray, focus: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        """For every anchor and row: in all slices of the anchor's focus coordinates?"""
        first, last = self.slices(unit, focus, cosine)
        rank = np.empty_like(self.order)
        np.put_along_axis(rank, self.order, np.broadcast_to(np.arange(len(self.ids))[:, None], rank.shape), axis=0)
        take = np.ones((len(unit), len(self.ids)), bool)
        narrow = (first > 0) | (last < len(self.ids))
        for at in range(focus.shape[1]):
            for q in np.flatnonzero(narrow[:, at]):
                place = rank[:, focus[q, at]]
                take[q] &= (place >= first[q, at]) & (place < last[q, at])
        return take


def buckets(ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> list[Bucket]:
    length = np.sqrt(np.einsum("ij,ij->i", x, x)) if x.shape[1] else np.zeros(len(x))
    order = np.lexsort((ids, -length))
    return [Bucket(ids[at], labels[at], x[at], length[at]) for at in np.split(order, range(BUCKET, len(order), BUCKET))]


def search(found: list[Bucket], anchors: np.ndarray, lowest: np.ndarray, usable, keep, scored: list[int] | None = None) -> None:
    """Feed ``keep(anchor, ids, scores)`` the exact scores of all rows that may reach the anchors' current thresholds.

    ``lowest`` holds the thresholds and is raised by ``keep``; ``usable(bucket)`` masks pairs (anchors x rows) by label and id.
    """
    length = np.sqrt(np.einsum("ij,ij->i", anchors, anchors)) if anchors.shape[1] else np.zeros(len(anchors))
    unit = anchors / np.where(length > 0, length, 1.0)[:, None]
    n = min(FOCUS, anchors.shape[1])
    focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :n]
    for b in found:
        # A threshold of zero or less, or an anchor of length zero, prunes nothing.
        top = length * b.longest
        prune = (lowest > 0) & (top > 0)
        cosine = np.where(prune, lowest / np.where(top > 0, top, 1.0), -1.0) - _SLACK
        live = np.flatnonzero((cosine <= 1.0) & ~((lowest > 0) & (top == 0)))
        if not live.size:
            continue
        take = b.candidates(unit[live], focus[live], cosine[live]) if n else np.ones((live.size, len(b.ids)), bool)
        take &= usable(b)[live]
        rows = np.flatnonzero(take.any(axis=0))
        some = np.flatnonzero(take.any(axis=1))
        if not rows.size:
            continue
        if scored is not None:
            scored[0] += int(take.sum())
        score = exact_scores(anchors[live[some]], b.x[rows])
        take = take[np.ix_(some, rows)] & (score >= lowest[live[some]][:, None])
        for at in np.flatnonzero(take.any(axis=1)):
            c = np.flatnonzero(take[at])
            keep(live[some[at]], b.ids[rows[c]], score[at, c])


def shorter(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best: higher score, then smaller id."""
    order = np.lexsort((ids, -score))[:k]
    return ids[order], score[order]


def _table(batch: pa.Table, names: list[str]) -> dict[str, np.ndarray]:
    return {n: batch.column(n).combine_chunks().to_numpy(zero_copy_only=False) for n in names}


def _lists(t: pa.Table) -> pa.Array:
    x = t.column("x").combine_chunks()
    return x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks)


def _positives(k: int):
    """Per anchor the ``k`` best rows of its label in one group."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, r = _table(left, ["vec_id"]), _table(right, ["vec_id"])
        by_size = matrix(_lists(right)) if right.num_rows else {}
        out = [[], [], []]
        for d, (at, x) in (matrix(_lists(left)) if left.num_rows and right.num_rows else {}).items():
            if d not in by_size:
                continue
            rows, y = by_size[d]
            ids = a["vec_id"][at]
            best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]
            lowest = np.full(len(ids), _NONE, np.int64)

            def keep(i, some, score):
                best[i] = shorter(np.concatenate([best[i][0], some]), np.concatenate([best[i][1], score]), k)
                if len(best[i][0]) == k:
                    lowest[i] = best[i][1][-1]

            found = buckets(r["vec_id"][rows], np.zeros(len(rows), np.int64), y)
            search(found, x, lowest, lambda b: ids[:, None] != b.ids[None, :], keep)
            for i, (got, score) in zip(ids, best):
                out[0].append(np.full(len(got), i))
                out[1].append(got)
                out[2].append(score)
        cols = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
        return pa.table(dict(zip(["anchor_id", "positive_id", "positive_score"], map(pa.array, cols))))

    return run


def _negatives(k: int, low: int, high: int):
    """Per anchor and positive the ``k`` best rows of other labels inside the positive's range, in one group."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
        out = [[] for _ in names]
        a, r = _table(left, ["vec_id", "label"]), _table(right, ["vec_id", "label"])
        positives = left.column("positives").to_pylist() if left.num_rows else []
        by_size = matrix(_lists(right)) if right.num_rows else {}
        for d, (at, x) in (matrix(_lists(left)) if left.num_rows and right.num_rows else {}).items():
            if d not in by_size:
                continue
            rows, y = by_size[d]
            ids, labels = a["vec_id"][at], a["label"][at]
            # Whole numbers: low * p <= 100 * s  <=>  s >= ceil(low * p / 100), and so on.
            lists = [[(p["positive_id"], p["positive_score"], -(-low * p["positive_score"] // 100), high * p["positive_score"] // 100)
                      for p in positives[i]] for i in at]
            best = [[(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in own] for own in lists]
            lowest = np.array([min((lo for _, _, lo, hi in own if lo <= hi), default=1 << 62) for own in lists], np.int64)

            def keep(i, some, score):
                need = 1 << 62
                for n, (_, _, lo, hi) in enumerate(lists[i]):
                    if lo > hi:
                        continue
                    fit = (score >= lo) & (score <= hi)
                    if fit.any():
                        best[i][n] = shorter(np.concatenate([best[i][n][0], some[fit]]), np.concatenate([best[i][n][1], score[fit]]), k)
                    need = min(need, int(best[i][n][1][-1]) if len(best[i][n][0]) == k else lo)
                lowest[i] = need

            found = buckets(r["vec_id"][rows], r["label"][rows], y)
            search(found, x, lowest, lambda b: labels[:, None] != b.labels[None, :], keep)
            for anchor, own, got in zip(ids, lists, best):
                for (pid, score, _, _), (nid, s) in zip(own, got):
                    for col, v in zip(out, (np.full(len(nid), anchor), np.full(len(nid), pid), nid, np.full(len(nid), score), s)):
                        col.append(v)
        cols = [np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64) for c in out]
        return pa.table(dict(zip(names, map(pa.array, cols))))

    return run


def _merge(keys: list[str], k: int):
    """Short lists of a key, sorted by it, merged into its ``k`` best."""
    names = [*keys, "id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, keys, names):
            ids, score = shorter(g["id"], g["score"], k)
            n = len(ids)
            cols = [*(np.repeat(g[c][:1], n) for c in keys), np.arange(1, n + 1, dtype=np.int32), ids, score]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[*keys, "rank", "id", "score"])

    return run


def best_per_key(short: DataFrame, keys: list[str], k: int, score: str = "long") -> DataFrame:
    """``(keys, rank, id, score)``: the ``k`` best entries of every key; a key has few entries per group of rows."""
    schema = ", ".join(f"{c} long" for c in keys) + f", rank int, id long, score {score}"
    return short.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_merge(keys, k), schema)


def _parts(count: Column, size: int) -> Column:
    return F.greatest(F.ceil(count / F.lit(size)), F.lit(1)).cast("int")


def _dealt(key: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(key), parts).cast("int")


def mine(spark: SparkSession, vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for every anchor and positive.

    ``vectors(vec_id, label, embedding)``; anchors are the rows where ``is_anchor`` (over ``vec_id``, ``label``) holds.
    A score is the integer inner product of the whole components ``floor(256 * c)``. An anchor's positives are its
    ``positives`` best other rows of the same label, a positive's negatives the ``negatives`` best rows of other labels
    whose score is between ``low`` and ``high`` hundredths of the positive's.

    * ties go to the smaller ``vec_id``; fewer rows give all; a positive without a negative gives no row;
    * rows without ``vec_id`` or label, and vectors that are null or hold null or non-finite components (or one whose
      256-fold is not finite), take no part;
    * rows that share a ``vec_id`` count as one, with the smallest label and then the smallest vector;
    * only vectors of equal length score with each other; an empty vector scores 0;
    * a positive with a negative score has an empty range; one that scores 0 has the rows that score 0;
    * scores that do not fit in a long raise an error; an empty table, or one without anchors, gives an empty result;
      other columns are ignored, whatever their names.
    """
    rows = stored(spark, integer_rows(vectors), "hard_negatives")
    anchors = rows.where(is_anchor)
    # Positives: rows and anchors of a label, the label's rows dealt into groups and its anchors into blocks.
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("m")).where("m > 0").select(
        "label", _parts(F.col("n"), GROUP).alias("groups"), _parts(F.col("m"), ANCHORS).alias("blocks"))
    side = rows.join(sizes, "label").select("vec_id", "label", "x", _dealt("vec_id", F.col("groups")).alias("g"),
                                            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"))
    block = anchors.join(sizes, "label").select("vec_id", "label", "x", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"),
                                                _dealt("vec_id", F.col("blocks")).alias("b")).toDF("vec_id", "label", "x", "g", "b")
    short = block.groupBy("label", "g", "b").cogroup(side.groupBy("label", "g", "b")).applyInArrow(
        _positives(positives), "anchor_id long, positive_id long, positive_score long")
    merged = best_per_key(short.toDF("anchor_id", "id", "score"), ["anchor_id"], positives)
    own = merged.groupBy("anchor_id").agg(
        F.collect_list(F.struct(F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))).alias("positives"))
    held = stored(spark, anchors.join(own, F.col("anchor_id") == F.col("vec_id")).select("vec_id", "label", "x", "positives"), "anchors")
    # Negatives: all rows in groups, all anchors in blocks.
    n, m = rows.count(), held.count()
    groups, blocks = max(1, -(-n // GROUP)), max(1, -(-m // ANCHORS))
    side = rows.select("vec_id", "label", "x", _dealt("vec_id", F.lit(groups)).alias("g"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    block = held.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), _dealt("vec_id", F.lit(blocks)).alias("b")).toDF(
        "vec_id", "label", "x", "positives", "g", "b")
    short = block.groupBy("g", "b").cogroup(side.groupBy("g", "b")).applyInArrow(
        _negatives(negatives, low, high),
        "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    keys = ["anchor_id", "positive_id", "positive_score"]
    merged = best_per_key(short.toDF("anchor_id", "positive_id", "id", "positive_score", "score"), keys, negatives)
    return merged.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                         F.col("score").alias("negative_score"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0
), p AS MATERIALIZED (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
