import random

import numpy as np
import pytest

from workgrid.llm import decontaminate as D


def brute(docs, items):
    def sh(text, n):
        w = D.words(text)
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    out = {}
    for item, text in items:
        w = D.words(text)
        if not w:
            continue
        n = min(5, len(w))
        want = sh(text, n)
        for doc, body in docs:
            shared = len(want & sh(body, n))
            if shared and shared * 10 >= 8 * len(want):
                out[doc, item] = (shared, len(want))
    return out


@pytest.mark.parametrize("bits", [None, 6])  # 6: one word, in which every bit is set
def test_against_brute_force(spark, monkeypatch, bits):
    if bits:
        monkeypatch.setattr(D, "MIN_BITS", bits)
        monkeypatch.setattr(D, "MAX_BITS", bits)
    rng = random.Random(2)
    vocab = ["w%d" % i for i in range(60)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(say(rng.randint(1, 60)))) for i in range(40)] + [(40, None), (41, "?!"), (42, "")]
    docs = []
    for d in range(150):
        body = say(rng.randint(0, 300))
        part = (items[rng.randrange(40)][1] or "").split()
        for k in range(rng.choice([0, 0, 1, 2])):  # a few changed words
            part[rng.randrange(len(part))] = "changed"
        docs.append((d, ", ".join([*body, *part, *say(20)]).upper()))
    docs += [(500, None), (501, ""), (502, "w1 w2"), (None, items[0][1]), (503, " ".join(say(50000)) + " " + items[5][1])]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, h int, item_id string")
    bench = spark.createDataFrame([(i, t, 1.0) for i, t in items], "item_id int, text string, n double")
    rows = D.contained_items(spark, df, bench).collect()
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_shingles) for r in rows}
    assert len(rows) == len(got)
    assert got == brute(docs, items)
    left = {r.doc_id for r in D.drop_contaminated(spark, df, bench).collect()}
    assert left == {i for i, _ in docs} - {d for d, _ in got}
    assert D.contained_items(spark, df.limit(0), bench).collect() == []
    assert D.contained_items(spark, df, bench.limit(0)).collect() == []
    assert D.drop_contaminated(spark, df, bench.limit(0)).count() == len(docs)


def test_tables_are_sized_by_their_hashes(spark):
    assert [D.table_bits(n) for n in (0, 1, 2**17, 2**17 + 1, 2**20, 10**9)] == [23, 23, 23, 24, 26, 27]
    hashes = np.random.default_rng(0).integers(0, 2**64, 3000, np.uint64)
    frame = spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "h long")
    other = np.random.default_rng(1).integers(0, 2**64, 20_000, np.uint64)
    for bits in (6, 12, 18, 24):
        table = D._table(frame, bits)
        assert table.size * 64 == 2**bits and D._in_table(table, hashes).all()
        assert D._in_table(table, other).mean() <= 3000 / 2**bits * 1.3 + 1e-3


def test_sketch_exceeds_what_an_item_may_miss(spark):
    rows = spark.range(1, 3000).select("id", D.sketch_size(__import__("pyspark").sql.functions.col("id"), 0.8).alias("m")).collect()
    for r in rows:
        may_miss = r.id - -(-8 * r.id // 10)
        assert may_miss < r.m


def test_oracle(spark, duck):
    sf = "/root/testdata/sf0.001"
    got = D.contained_items(spark, spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
    have = {(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in got.collect()}
    want = {r[:4] for r in duck.sql(D.ORACLE).fetchall()}
    assert have == want and have
