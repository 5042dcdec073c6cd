"""The pipeline's stages one by one against what their operators decide, over whole tables."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as C
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_line_dedup import brute as cleaned
from tests.llm.test_simhash import brute_components, brute_fingerprint
from workgrid.llm.bpe import read_ranks
from workgrid.llm.toxicity import toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Documents before the first and after every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])
    assert stages[1].count() < stages[0].count()


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bad = {r.doc_id for r in toxicity(spark, stages[0], labels).collect() if r.predicted}
    before = texts(stages[0])
    assert bad and texts(stages[1]) == {i: t for i, t in before.items() if i not in bad}


def test_repeated_lines_go(stages):
    before = texts(stages[1])
    clean, removed = cleaned(list(before.items()))
    assert texts(stages[2]) == {i: t for i, t in clean.items() if not removed[i] or t.strip(" ")}
    assert all(r.n_chars == len(r.text) for r in stages[2].collect() if removed[r.doc_id])


def test_one_of_each_group_stays(stages):
    before = texts(stages[2])
    root = brute_components({i: brute_fingerprint(t) for i, t in before.items()}, 4)
    assert texts(stages[3]) == {i: t for i, t in before.items() if root[i] == i}


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = texts(stages[3])
    bad = {d for d, _ in contaminated(list(before.items()), items)}
    assert texts(stages[4]) == {i: t for i, t in before.items() if i not in bad}


def test_tokens(stages):
    before = texts(stages[4])
    path = P.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == set(before)
    for r in rows:
        assert r.ids == enc.encode_ordinary(before[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(before[r.doc_id].encode()).hexdigest()


def test_run_equals_the_stages(spark, stages):
    got = {(r.doc_id, r.ids_sha256) for r in C.run(spark, SF).collect()}
    assert got == {(r.doc_id, r.ids_sha256) for r in stages[5].collect()}


def test_empty_and_odd_documents(spark, tmp_path):
    kinds = "doc_id long, text string, lang string, source string, n_chars int"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b", "en", "s", 3), (3, "x y z " * 20000, "en", "s", 120000), (3, "x y z " * 20000, "en", "s", 120000)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, kinds)
        for k, (_, stage) in enumerate(C.STAGES):
            docs = stage(spark, docs, SF)
            docs.write.parquet(path := str(tmp_path / f"{len(data)}_{k}"))
            docs = spark.read.parquet(path)
        assert (docs.count() == 0) == (not data)
