import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from workgrid.llm import hard_negatives as H

SF = "/root/testdata/sf0.001"


def brute(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    one = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or not all(c is not None and math.isfinite(c) for c in v):
            continue
        x = (label, [math.floor(256 * c) for c in v])
        one[i] = min(one.get(i, x), x)
    out = set()
    for a, (la, va) in one.items():
        if not is_anchor(a):
            continue
        score = {i: (l, sum(p * q for p, q in zip(va, v))) for i, (l, v) in one.items() if i != a and len(v) == len(va)}
        own = sorted((-s, i) for i, (l, s) in score.items() if l == la)[:positives]
        for ps, p in own:
            hard = sorted((-s, i) for i, (l, s) in score.items() if l != la and low * -ps <= 100 * s <= high * -ps)[:negatives]
            out |= {(a, p, n + 1, i, -ps, -s) for n, (s, i) in enumerate(hard)}
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, l, v, 1, "x", 2.0) for i, l, v in rows],
                                 "vec_id long, label int, embedding array<double>, g int, b string, x double")


def some_rows(seed, n=400, dims=8):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c, size = rng.choice(centres), rng.uniform(0.2, 2)
        rows.append((i, rng.randrange(4), [size * (m + rng.gauss(0, 0.15)) for m in c]))
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(60)]  # a common vector, one label
    rows += [(1100 + i, i % 3, rows[6][2]) for i in range(60)]  # a common vector, several labels
    rows += [(5, 0, rows[9][2]), (10, rows[10][1], rows[10][2])]  # a shared id, a repeated row
    rows += [(2000, None, [1.0] * dims), (None, 1, [1.0] * dims), (2010, 1, None), (2020, 1, [None] * dims),
             (2030, 1, [math.nan] * dims), (2040, 1, [math.inf] * dims), (2050, 1, [0.0] * dims), (2060, 2, [0.0] * dims),
             (2070, 1, []), (2080, 1, []), (2090, 2, []), (2100, 9, [0.5] * dims), (2110, 1, [1.0, 2.0]), (2120, 2, [1.0, 1.0])]
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(H, "GROUP", 100)
    monkeypatch.setattr(H, "ANCHORS", 16)
    monkeypatch.setattr(H, "BUCKET", 32)
    rows = some_rows(11)
    for k, n in ((5, 3), (2, 1)):
        got = H.mine(spark, table(spark, rows), F.col("vec_id") % 10 == 0, k, n).collect()
        want = brute(rows, lambda i: i % 10 == 0, k, n)
        assert {tuple(r) for r in got} == want and len(got) == len(want) > 100


def test_large_scores(spark):
    rows = [(0, 1, [3e13, 1.0]), (1, 1, [3.0, 2.0]), (2, 2, [2.0, 9.0]), (3, 2, [2.5, 1.0]), (4, 2, [2.5, 1.25])]
    got = {tuple(r) for r in H.mine(spark, table(spark, rows), F.col("vec_id") == 0).collect()}
    assert got == brute(rows, lambda i: i == 0) and got


def test_empty_tables(spark):
    df = table(spark, some_rows(2, 20))
    assert H.mine(spark, df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert H.mine(spark, df, F.lit(False)).collect() == []
    alone = table(spark, [(1, 1, [1.0, 2.0])])
    assert H.mine(spark, alone, F.lit(True)).collect() == []


@pytest.mark.parametrize("spread", [0.02, 0.3])
def test_ranges_hold_all_rows_over_the_threshold(spread):
    """No row that reaches the threshold is pruned, and in concentrated data most of the others are."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    x = np.floor(256 * (centres[rng.integers(0, 20, 2000)] + spread * rng.normal(size=(2000, 16))))
    anchors = x[:40]
    score = (anchors @ x.T).astype(np.int64)
    lowest = np.sort(score, axis=1)[:, -20].copy()
    seen = [set() for _ in anchors]
    scored = [0]
    found = H.buckets(np.arange(2000), np.zeros(2000, np.int64), x)
    H.search(found, anchors, lowest, lambda b: np.ones((40, len(b.ids)), bool), lambda i, ids, s: seen[i].update(ids.tolist()), scored)
    for i in range(40):
        assert seen[i] == set(np.flatnonzero(score[i] >= lowest[i]).tolist())
    if spread < 0.1:
        assert scored[0] < 0.4 * score.size


def test_oracle(spark, duck):
    from workgrid.llm.queries import llm_queries

    got = [tuple(r) for r in llm_queries()["op11_hard_negatives"](spark, SF).collect()]
    want = duck.sql(H.ORACLE).fetchall()
    assert set(got) == set(want) and len(got) == len(want) > 0
