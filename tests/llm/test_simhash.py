import random

import xxhash

from workgrid.llm.simhash import fingerprint, link_components, near_duplicates


def brute_fingerprint(text, n=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    words, cur = [], ""
    for c in low:
        if c in " \t\n\x0b\x0c\r":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if cur:
        words.append(cur)
    if not words:
        return 0
    sh = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_matches_the_definition():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "a b c", "a b c d", "A b C\x0bd É e", "x " * 70000]
    texts += [" ".join(rng.choice("ab cd EF gh ij".split()) for _ in range(rng.randint(1, 60))) for _ in range(50)]
    for t in texts:
        assert fingerprint(t) == brute_fingerprint(t)


def test_components_of_dense_families_and_chains(spark, monkeypatch):
    import workgrid.llm.simhash as m

    monkeypatch.setattr(m, "CELL", 16)  # many cells per key
    rng = random.Random(7)
    fps = {}
    for base in (rng.getrandbits(64) for _ in range(4)):
        for _ in range(150):  # dense family around a base
            f = base
            for b in rng.sample(range(64), rng.randint(0, 5)):
                f ^= 1 << b
            fps[len(fps) * 3 + 1] = f
        f = base
        for _ in range(12):  # a chain leading away from it
            for b in rng.sample(range(64), 4):
                f ^= 1 << b
            fps[len(fps) * 3 + 1] = f
    for _ in range(200):
        fps[len(fps) * 3 + 1] = rng.getrandbits(64)
    distinct = {}
    for i, f in fps.items():
        distinct.setdefault(f, i)
    nodes = spark.createDataFrame([(i, signed(f)) for f, i in distinct.items()], "rep long, fp long")
    got = {r.node: r.root for r in link_components(spark, nodes).collect()}
    want = brute_components({i: f for f, i in distinct.items()}, 4)
    assert {i: got.get(i, i) for i in want} == want
    assert len(set(want.values())) < len(want) - 400


def test_near_duplicates_of_a_table(spark):
    rng = random.Random(3)
    words = ["w%d" % i for i in range(400)]
    long = [" ".join(rng.choice(words) for _ in range(300)) for _ in range(6)]
    texts = long + [long[0], long[1] + " tail", long[1].replace("w1 ", "w2 ", 1), "", None, "  ", "one", "ONE"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "x"), (None, long[2], "x"), (None, "alone", "x")]
    got = near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()
    assert len(got) == len(rows)
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    want = brute_components(fps, 4)
    for r in got:
        if r.doc_id is not None:
            assert r.fingerprint == format(fps[r.doc_id], "016x")
            assert r.component_id == want[r.doc_id]
    assert sorted((r.component_id is None, r.component_id or 0) for r in got if r.doc_id is None) == [(False, want[2]), (True, 0)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(spark, empty).collect() == []


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fps = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    want = brute_components(fps, 4)
    got = near_duplicates(spark, docs).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == fps
