import math
import random

import numpy as np
from pyspark.sql import functions as F

from workgrid.llm import topk


def brute(rows, is_query, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in ok:
        if is_query(i):
            queries[i] = min(queries.get(i, v), v)
    out = {}
    for q, v in queries.items():
        best = {}
        for i, c in ok:
            if i != q and len(c) == len(v):
                s = sum(a * b for a, b in zip(v, c))
                best[i] = max(best.get(i, s), s)
        out[q] = sorted(((-s, i) for i, s in best.items()))[:k]
    return {(q, n + 1, i, -s) for q, found in out.items() for n, (s, i) in enumerate(found)}


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "_ROWS", 64)
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(10)]) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # one common vector
    rows += [(500, None), (510, [1.0, None]), (520, [float("nan")] * 10), (530, [float("inf")] * 10), (None, [1.0] * 10)]
    rows += [(540, [0.5, 0.5]), (550, [0.5, -0.5]), (560, []), (570, []), (10, rows[3][1]), (11, rows[11][1])]
    rows += [(600, [3e13] + [0.0] * 9), (601, [1.5, *[0.0] * 9])]
    df = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, query_id string")
    for k, block in ((5, 2048), (3, 4)):
        got = topk.top_k(spark, df, F.col("vec_id") % 10 == 0, k, block).collect()
        want = brute(rows, lambda i: i % 10 == 0, k)
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk.top_k(spark, df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert topk.top_k(spark, df, F.lit(False)).collect() == []


def test_oracle(spark, duck):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = {tuple(r) for r in topk.top_k(spark, df, F.col("vec_id") % 50 == 0).collect()}
    assert got == set(duck.sql(topk.ORACLE).fetchall())


def test_few_candidates_are_resolved():
    """The uniform threshold names all candidates that reach the bound, and far fewer than all pairs."""
    rng = np.random.default_rng(6)
    rows = np.floor(256 * rng.normal(size=(4000, 32)) * rng.uniform(0.05, 1, size=(4000, 1)))
    queries = rows[:40]
    score = queries @ rows.T
    bound = np.sort(score, axis=1)[:, -6].astype(np.int64)
    counted = [0]
    q, r, total = topk.Group(np.arange(4000), rows).resolved(queries, 5, bound, counted)
    assert (total == score[q, r]).all()
    got = set(zip(q[total >= bound[q]].tolist(), r[total >= bound[q]].tolist()))
    assert got == set(zip(*(x.tolist() for x in np.nonzero(score >= bound[:, None]))))
    assert counted[0] < 0.2 * score.size
    first = [0]
    topk.Group(np.arange(4000), rows).resolved(queries, 5, None, first)
    assert first[0] <= 40 * topk.LISTS * 6 * -(-4000 // topk._ROWS)
