import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from workgrid.llm import one_bit_search as S

SF = "/root/testdata/sf0.001"


def brute(rows, is_query, k=20):
    one = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v):
            one[i] = min(one.get(i, list(v)), list(v))
    out = {}
    for q, v in one.items():
        if is_query(q):
            score = [(-float((np.array(v) * np.array(w)).sum()), i) for i, w in one.items() if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(score)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    assert set(got) <= set(want)
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    for q, w in want.items():
        assert len(got.get(q, [])) == len(w)
        assert got.get(q, []) == sorted(got.get(q, []), key=lambda x: (-x[1], x[0]))
    return hits / max(1, sum(map(len, want.values())))


def test_odd_rows_and_copies(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP", 150)
    monkeypatch.setattr(S, "BLOCK", 16)
    rng = np.random.default_rng(13)
    centres = rng.normal(size=(5, 24))
    rows = [(i, (centres[i % 5] + 0.2 * rng.normal(size=24)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # exact copies
    rows += [(1200 + i, (centres[1] + 1e-6 * rng.normal(size=24)).tolist()) for i in range(150)]  # near copies
    rows += [(5, rows[9][1]), (20, rows[20][1]), (None, [1.0] * 24), (2000, None), (2010, [None] * 24), (2020, [math.nan] * 24),
             (2030, [math.inf] * 24), (2040, [0.0] * 24), (2050, []), (2060, [1.0, 2.0]), (2070, [2.0, -1.0]), (2080, [3.0])]
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], "vec_id long, embedding array<double>, d int, v int, g string")
    want = brute(rows, lambda i: i % 10 == 0, 6)
    got = found(S.nearest_neighbours(spark, df, F.col("vec_id") % 10 == 0, 6))
    assert recall(got, want) > 0.97
    exact = {i: dict(w) for i, w in brute(rows, lambda i: i % 10 == 0, 10**6).items()}
    for q, near in got.items():
        assert all(exact[q][i] == pytest.approx(s, rel=1e-12) for i, s in near)
    # A copy's nearest are the smallest ids of its copies where nothing scores higher.
    copies = [i for i in got if 1000 <= i < 1150]
    assert copies and all(got[i] == [(j, pytest.approx(s)) for j, s in want[i]] for i in copies)


def test_empty_and_small_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert S.nearest_neighbours(spark, spark.createDataFrame([], kind), F.lit(True)).collect() == []
    one = spark.createDataFrame([(1, [1.0, 0.0])], kind)
    assert S.nearest_neighbours(spark, one, F.lit(True)).collect() == []
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 2.0]), (3, [1e30, 1.0])], kind)
    got = found(S.nearest_neighbours(spark, two, F.col("vec_id") == 1))
    assert [i for i, _ in got[1]] == [3, 2]
    assert S.nearest_neighbours(spark, two, F.lit(False)).collect() == []


def test_error_bound_holds():
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(500, 64)), rng.normal(size=(50, 64))
    centres = x[:8]
    t = S.encode(x, centres)
    est, err = S.estimates(t, slice(0, 500), q, centres)
    off = np.abs(est - q @ x.T)
    assert (off <= err).mean() > 0.9 and off[:, :8].max() < 1e-4  # the centres themselves are exact
    assert t["code"].nbytes == 500 * S.code_bits(64) // 8


def test_recall_on_the_table(spark):
    from workgrid.llm.queries import llm_queries

    for sf in (SF, "/root/testdata/sf0.1"):
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
        want = brute(rows, lambda i: i % 20 == 0)
        assert recall(found(llm_queries()["op13_one_bit_search"](spark, sf)), want) >= 0.95
