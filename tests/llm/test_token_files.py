import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from workgrid.llm import range_coder as R
from workgrid.llm import token_files as T

PATH = P.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", " a", "a ", "a\n b", "a \n b\t\tc", "it's  <|endoftext|> x", "é ñ\xa0 z", "x\x1c y", "  q", "word " * 900]


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def test_round_trip_of_blocks():
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 65536, n) for n in (1, 2, 3000, 300)]
    blocks += [np.zeros(3000, int), np.array([65535] * 10), rng.zipf(1.3, 2000) % 50000, np.tile(rng.integers(0, 50000, 50), 40)]
    coded = R.encode(blocks)
    for x, y in zip(blocks, R.decode(coded)):
        assert np.array_equal(x, y)
    assert len(coded[4]) < 200 and len(coded[7]) < 400  # repetition is predicted
    for x, c in zip(blocks, coded):  # blocks are independent
        assert np.array_equal(R.decode([c])[0], x)


def test_coded_bytes_stay_the_same():
    """Files written before stay readable: the hash is that of the coder's first version."""
    rng = np.random.default_rng(3)
    blocks = [rng.zipf(1.2, n) % 65536 for n in (1, 2, 7, 900, 4096, 2500)]
    blocks += [np.tile(rng.integers(0, 65536, k), 2000 // k) for k in (1, 2, 3, 50, 700)]
    blocks += [rng.integers(0, 65536, 3000), rng.integers(0, 300, 4096)]
    coded = R.encode(blocks)
    assert hashlib.sha256(b"".join(coded)).hexdigest() == "423386e5a68e1b04afca8ca9ca1b52b8cff588e0809059b292554ee0ae1e1861"
    assert all(np.array_equal(x, y) for x, y in zip(blocks, R.decode(coded)))


def test_damage_is_noticed():
    coded = R.encode([np.arange(500) % 37])[0]
    for bad in (coded[:-2], b"XXXX" + coded[4:], coded[:40] + bytes([coded[40] ^ 1]) + coded[41:]):
        with pytest.raises(ValueError):
            R.decode([bad])


def test_parts_give_the_ids_of_whole_texts(whole):
    assert [x.tolist() for x in T.Encoder(PATH).ids(ODD)] == [whole(t) for t in ODD]


def test_parts_of_random_texts(whole):
    rng = np.random.default_rng(1)
    signs = [*"aZ '.,%\n\t1", "\r\n", "'s", " '", "  ", "\n\n", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u205f", "\u3000", "\u3001", "é", "\u00bf", "\u201c", "日", "😀", "word", "<|endoftext|>"]
    texts = ["".join(rng.choice(signs, rng.integers(0, 25))) for _ in range(20_000)]
    assert [x.tolist() for x in T.Encoder(PATH).ids(texts)] == [whole(t) for t in texts]


def test_words_are_tokenized_once_whatever_mark_follows(whole):
    encoder = T.Encoder(PATH)
    words, marks = [f"thing{a}{b}" for a in "abcdefgh" for b in "abcdefgh"], [".", ",", "!!", ".\n", ").\n"]
    texts = ["".join(f" {w}{m}" for w in words) for m in marks]
    assert [x.tolist() for x in encoder.ids(texts)] == [whole(t) for t in texts]
    assert len(encoder.known) < len(words) + 20


def test_joined_crcs_of_many_texts():
    rng = np.random.default_rng(2)
    parts = [[rng.bytes(int(n)) for n in rng.integers(1, 70_000, k)] for k in (1, 3, 1, 6, 2)]
    flat = [p for text in parts for p in text]
    first = np.cumsum([0, *map(len, parts)])[:-1]
    got = T.joined_crcs(first, np.array([*map(len, flat)]), np.array([*map(zlib.crc32, flat)]))
    assert got.tolist() == [zlib.crc32(b"".join(text)) for text in parts]


def test_joined_crc():
    data = bytes(range(256)) * 9
    for cuts in ([0, 100, 101, 2000, len(data)], [0, len(data)]):
        parts = [(b - a, zlib.crc32(data[a:b])) for a, b in zip(cuts, cuts[1:])]
        assert T.joined_crc(parts) == zlib.crc32(data)


def test_files(spark, whole, tmp_path, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD)] + [(20_000, None), (20_001, "long " * 30_000)], "doc_id long, text string")
    rows = docs.unionByName(extra)
    T.write_token_files(rows.withColumn("shard", rows["doc_id"]), PATH, str(tmp_path / "f"))
    got = T.read_token_files(spark, str(tmp_path / "f")).collect()
    texts = {r.doc_id: r.text for r in rows.collect()}
    assert len(got) == len(texts)
    start = 0
    for r in sorted(got, key=lambda r: r.doc_id):
        ids = whole(texts[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_repeated_and_null_ids(spark, tmp_path):
    rows = [(None, "x"), (3, "b b"), (3, "b b"), (1, "a"), (None, None)]
    T.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), PATH, str(tmp_path / "f"))
    got = sorted((r.start, r.n_tokens, r.doc_id) for r in T.read_token_files(spark, str(tmp_path / "f")).collect())
    assert [g[0] for g in got] == [sum(x[1] for x in got[:i]) for i in range(5)] and [g[2] for g in got] == [None, None, 1, 3, 3]
    T.write_token_files(spark.createDataFrame([], "doc_id long, text string"), PATH, str(tmp_path / "e"))
    assert T.read_token_files(spark, str(tmp_path / "e")).collect() == []
