import random

from workgrid.llm.line_dedup import ORACLE, remove_repeated_lines


def brute(rows):
    """Cleaned texts of (id, text) rows with distinct ids."""
    lines = {i: (t or "").split("\n") for i, t in rows}
    key = lambda i: (i is not None, i if i is not None else 0)
    first, later = {}, {i: set() for i in lines}
    for i in sorted(lines, key=key):
        for p in range(len(lines[i]) - 2):
            w = tuple(x.strip(" ") for x in lines[i][p : p + 3])
            if not any(w):
                continue
            if w in first:
                later[i] |= {p, p + 1, p + 2}
            else:
                first[w] = (i, p)
    return {i: "\n".join(x for p, x in enumerate(lines[i]) if p not in later[i]) if later[i] else t for i, t in rows}, {
        i: len(later[i]) for i in lines
    }


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, "\n".join(rng.choice("abc ") * rng.randint(0, 2) for _ in range(rng.randint(0, 9)))) for i in range(200)]
    rows += [(300, None), (301, ""), (302, "\n\n\n\n"), (303, "x\ny"), (304, "q\n" * 20000), (None, "a\nb\nc\nnew"), (305, "a\n b \nc")]
    docs = spark.createDataFrame([(i, t, 7, "z") for i, t in rows], "doc_id long, text string, pos int, h1 string")
    got = remove_repeated_lines(docs).collect()
    assert len(got) == len(rows)
    texts, removed = brute(rows)
    for r in got:
        assert (r.text, r.n_removed, r.pos, r.h1) == (texts[r.doc_id], removed[r.doc_id], 7, "z")
        assert r.n_lines == len(([t for i, t in rows if i == r.doc_id][0] or "").split("\n"))


def test_repeated_rows_and_clashing_names(spark):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc\nd"), (2, "other")]
    docs = spark.createDataFrame([(i, t, 3, 4) for i, t in rows], "doc_id long, text string, n_removed int, _row int")
    got = sorted((r.doc_id, r.text, r.n_removed, r._row) for r in remove_repeated_lines(docs).collect())
    assert got == [(1, "a\nb\nc", 0, 4), (1, "a\nb\nc", 0, 4), (2, "d", 3, 4), (2, "other", 0, 4)]


def test_empty_table(spark):
    assert remove_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_oracle(spark, duck):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {(r.doc_id, r.n_lines, r.n_removed, r.text) for r in remove_repeated_lines(docs).collect()}
    cols = [c[0] for c in duck.sql(ORACLE).description]
    rows = [dict(zip(cols, r)) for r in duck.sql(ORACLE).fetchall()]
    assert got == {(r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in rows}
    assert sum(r[2] > 0 for r in got) > 0
