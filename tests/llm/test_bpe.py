import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from workgrid.llm import bpe as B

PATH = P.path("byte_bpe_multi_50k.tiktoken")
ODD = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "é", "日本", "½", "²", "1", "23", "_", "-", "\x1c", "\x85", "\xa0", "​", "the", "👍", "́", "!!", "\x00"]


@pytest.fixture(scope="module")
def ours():
    return B.loaded(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={})


def test_equals_tiktoken_on_odd_texts(ours, theirs):
    rng = random.Random(0)
    for _ in range(4000):
        s = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 25)))
        assert ours.encode(s) == theirs.encode_ordinary(s)


def test_pieces_equal_plain_merging(ours):
    ranks = B.read_ranks(PATH)
    rng = random.Random(1)
    for _ in range(1500):
        s = bytes(rng.choice(b"aeinrst \xc3\xa9\xff") for _ in range(rng.randint(1, 40)))
        assert ours.encode_piece(s) == B._merge(s, ranks, len(ranks))


def test_caches_stay_bounded_and_right(ours, theirs, monkeypatch):
    monkeypatch.setattr(B, "_PIECES", 20)
    monkeypatch.setattr(B, "_PAIRS", 20)
    monkeypatch.setattr(B, "_MARKS", 2)
    text = " ".join(f"word{i % 57} x{i}{'!' * (i % 5)}" for i in range(400))
    assert ours.encode(text) == theirs.encode_ordinary(text)
    assert len(ours.fits) <= 21 and len(ours.marks) <= 3


def test_pieces_longer_than_a_window(ours, theirs):
    rng = random.Random(2)
    for alphabet in ("aeinrst", "abcdefghijklmnopqrstuvwxyz", "éèàüabc", "日本語中文"):
        for n in (ours.window - 1, ours.window, ours.window + 1, 5000):
            s = "".join(rng.choice(alphabet) for _ in range(n))
            assert ours.encode(s) == theirs.encode_ordinary(s)
    for run in ("a", "=", " ", "th", "=-"):
        assert ours.encode(run * 3000 + "x") == theirs.encode_ordinary(run * 3000 + "x")


def test_pieces_of_known_stretches(ours, theirs):
    for s in ("erat erat*** erat, erat*** erat", "a a!! !! a!!a !!a", "x  x\n x\n\n  x x"):
        ours.known.clear(), ours.marks.clear()
        assert ours.encode(s) == ours.encode(s) == theirs.encode_ordinary(s)


def test_long_piece_is_linear(ours):
    text = "ab" * 200_000
    assert ours.decode(ours.encode(text)) == text.encode()


def test_table(spark, theirs):
    rows = [(1, "Hello  world\n"), (2, ""), (3, None), (None, "x y"), (1, "Hello  world\n"), (4, "é" * 30000)]
    docs = spark.createDataFrame([(i, t, 5, "k") for i, t in rows], "doc_id long, text string, n_tokens long, ids string")
    got = B.encoding_digests(docs, PATH, P.PATTERN, keep_ids=True).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        ids = theirs.encode_ordinary(t or "")
        r = by[i]
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    encoded = B.encode_documents(docs, PATH, P.PATTERN)
    back = {r.doc_id: bytes(r.bytes).decode() for r in B.decode_documents(encoded, PATH, P.PATTERN).collect()}
    assert back == {i: t or "" for i, t in rows}
    assert B.encoding_digests(docs.limit(0), PATH, P.PATTERN).collect() == []
