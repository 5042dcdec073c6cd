import math
import random
from fractions import Fraction

import numpy as np
import pytest

from workgrid.llm import whitening as W

SF = "/root/testdata/sf0.001"


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute(rows):
    """n, covariance by plain exact products, and deviations by row."""
    xs = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if usable(v)]
    fit = sorted({x for _, x in xs})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(dims)]
    cov = np.array([[float(Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit), n**3)) for j in range(dims)] for i in range(dims)])
    far = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in xs]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for _, x in xs])
    return n, cov, far, centred


def check(spark, df, rows, components=4):
    got = W.whiten(spark, df, components).collect()
    n, cov, far, centred = brute(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > values[0] * 1e-13).sum()))
    assert len(got) == len(far) * k
    by = {}
    for r in got:
        assert r.n == n and 0 <= r.identity_error <= 1e-4
        by.setdefault((r.vec_id, int(r.deviation), r.component), []).append(r)
    for c in range(k):
        want = centred @ vectors[:, c] / math.sqrt(values[c])
        sign = None
        for (i, d), w in zip(far, want):
            r = by[(i, d, c + 1)][0]
            assert r.explained == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
            sign = sign or (math.copysign(1, w * r.whitened) if abs(w) > 1e-6 else None)
            assert r.whitened * (sign or 1) == pytest.approx(w, abs=1e-8)
    return got


def test_against_plain_covariance(spark):
    rng = random.Random(12)
    rows = [(i, [rng.gauss(0, 1 + j) for j in range(7)]) for i in range(200)]
    rows += [(300 + i, rows[5][1]) for i in range(90)] + [(7, rows[7][1]), (None, [0.5] * 7)]
    rows += [(500, None), (501, [1.0, None, *[0.0] * 5]), (502, [math.nan] * 7), (503, [math.inf, *[0.0] * 6])]
    odd = [(600, [1.0, 2.0]), (601, [])]
    df = spark.createDataFrame([(i, v, 1.5, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, whitened double, n string")
    check(spark, df.repartition(5), rows)


def test_large_components_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.choice((1, 9, 13)) for _ in range(3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    check(spark, df, rows, components=2)


def test_square_sums_of_every_width():
    rng = random.Random(8)
    for bits in (5, 30, 45, 61):
        s = [[rng.randrange(-(1 << bits), 1 << bits) for _ in range(3)] for _ in range(50)]
        want = [sum(r[j] ** 2 for r in s) for j in range(3)]
        assert list(W.square_sums(np.array(s, np.int64))) == want == list(W.square_sums(np.array(s, object)))
        assert list(W.column_sums(np.array(s, np.int64))) == [sum(r[j] for r in s) for j in range(3)]


def test_tables_without_a_covariance(spark):
    kind = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])]):
        assert W.whiten(spark, spark.createDataFrame(rows, kind)).collect() == []
    flat = [(i, [float(i), 1.0]) for i in range(5)]
    got = W.whiten(spark, spark.createDataFrame(flat, kind)).collect()
    assert {r.component for r in got} == {1} and len(got) == 5


def test_component_that_does_not_fit(spark):
    df = spark.createDataFrame([(1, [1e300]), (2, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        W.whiten(spark, df).collect()


def test_query_on_the_table(spark):
    from workgrid.llm.queries import llm_queries

    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = check(spark, df, rows)
    out = llm_queries()["op12_whitening"](spark, SF)
    assert dict(out.dtypes)["deviation"] == "bigint" and out.count() == len(got) == 4 * len(rows)
