from itertools import combinations
from zlib import crc32

import numpy as np
import pytest

from workgrid.llm import string_kernel as K
from workgrid.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def brute_features(unit):
    out = {}
    codes = [K._code(ord(c)) for c in unit]
    for i, j, k in combinations(range(len(unit)), 3):
        t = (codes[i], codes[j], codes[k])
        if K.GAP not in t:
            out[t] = out.get(t, 0) + K.DECAY ** (k - i + 1)
    return out


def brute_kernel(u, v):
    a, b = brute_features(u), brute_features(v)
    dot = sum(x * b.get(t, 0) for t, x in a.items())
    n = np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    return dot / n if n else 0.0


def test_kernel_matches_explicit_features():
    units = ["idiot", "i-d-i-o-t", "idxiot", "aabbaa", "ab", "", "moron", "\x02clown", "éàñ", "x1y2z3", "語語語語"]
    got = K.kernel(units, units)
    for i, u in enumerate(units):
        for j, v in enumerate(units):
            assert got[i, j] == pytest.approx(brute_kernel(u, v), abs=1e-9)


def test_letters_and_symbols_of_other_scripts():
    got = K.kernel(["дурак", "дурAк", "солнце", "i\u2022d\u200bi\u2013o\U0001f600t", "愚か者だ"], ["дурак", "idiot", "i-d-i-o-t", "愚か者だ"])
    assert got[0, 0] == pytest.approx(1) and got[1, 0] < 0.9 and got[2, 0] < 0.5  # words of one length or script differ
    assert got[3, 2] == pytest.approx(1) and got[3, 1] > 0.3  # symbols are gaps
    assert got[4, 3] == pytest.approx(1) and got[4, 0] < 0.5
    every = "".join(map(chr, [0x250, 0x2028, 0x3B1, 0xD800, 0xFFFF, 0x1F600, 0x10FFFF]))
    assert K.encode([every], len(every))[0].tolist() == [K._code(ord(c)) for c in every]
    model = T._fit_svm([("\x02дурак", 3.0)], ["\x02" + w for w in ("весна", "книга", "город", "домик", "школа")])
    assert model.margins(["\x02дурак"])[0] > 0 > model.margins(["\x02весна", "\x02город"]).max()


def test_collapsed_decision_equals_kernel_expansion(monkeypatch):
    rng = np.random.default_rng(0)
    words = ["\x02" + "".join(rng.choice(list("abcdeorst"), 6)) for _ in range(300)]
    positive = [("\x02moron", 3.0), ("\x02clown", 2.0)]
    solved, svm = {}, T._svm

    def kept(x, y, weight):
        solved["x"], solved["w"] = x, svm(x, y, weight)
        return solved["w"]

    monkeypatch.setattr(T, "_svm", kept)
    model = T._fit_svm(positive, words)
    units = [*(u for u, _ in positive), *(s for u, _ in positive for s in T._spellings(u)), *words]
    w, bias = solved["w"]
    # The decision from the Nyström features of every training unit, and from the table over its triples.
    assert model.margins(units) == pytest.approx(solved["x"] @ w + bias, abs=1e-9)
    assert model.margins(["\x02moron", "\x02m-o-r-o-n", "\x02clxown"]).min() > model.margins(words).max()


def test_units_cover_long_tokens():
    token = "x" * 40 + "idiot" + "y" * 40
    assert any("idiot" in u for u in T.units_of_token(token))
    assert all(len(u) <= K.WIDTH + 1 for u in T.units_of_token(token))
    assert "i d i o t" in T.tokens("you i d i o t there")


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = T.toxicity(spark, docs, labels).collect()
    return {r.doc_id: r for r in rows}, {r.doc_id: r.toxic for r in labels.collect()}, docs.count()


def test_held_out_accuracy(scored):
    rows, truth, n = scored
    assert len(rows) == n
    held = [i for i in truth if rows[i].held_out]
    assert all(rows[i].held_out == (crc32(str(i).encode()) % 5 == 0) for i in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    right = np.mean([rows[i].predicted == truth[i] for i in held])
    bad = np.array([rows[i].score for i in held if truth[i]])
    good = np.array([rows[i].score for i in held if not truth[i]])
    assert right > 0.93
    assert (bad[:, None] > good[None, :]).mean() > 0.92


def test_odd_inputs(spark):
    labels = spark.createDataFrame([(i, int(i % 3 == 0), "x") for i in range(120)] + [(None, 1, "x"), (5, None, "x")], "doc_id long, toxic int, text string")
    texts = [("you stupid moron " if i % 3 == 0 else "nice calm day ") + f"word{i % 7} here" for i in range(120)]
    rows = list(enumerate(texts)) + [(200, None), (201, ""), (202, "z " * 60000 + "m-o-r-o-n"), (None, "some text"), (0, texts[0])]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    got = T.toxicity(spark, docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[202].predicted == 1 and by[200].predicted == by[201].predicted == by[None].predicted == 0
    none = T.toxicity(spark, docs, labels.where("toxic = 0")).collect()
    assert len(none) == len(rows) and all(r.score == 0 for r in none)
    assert T.toxicity(spark, docs.limit(0), labels).collect() == []
