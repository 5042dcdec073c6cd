import re

from workgrid.llm.license_rules import rules
from workgrid.llm.licenses import _GATE, BASE, WORD, keywords, scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    low = (text or "").translate(LOWER)
    words = re.findall(WORD, low)
    at, base = [], set()
    for phrase, label in BASE:
        here = [i for i in range(len(words)) if tuple(words[i : i + len(phrase)]) == phrase]
        at += here
        base |= {label} if here else set()
    labels, best, n = set(base), 0.5 if at else 0.0, 0
    for line in low.split("\n"):
        spans = []
        for r in rules():
            spans += [(-r.priority, -len(m[0]), r.number, *m.span(), r.label) for m in re.finditer(r.pattern, line)]
        for d in spans:
            if not any(e < d and (e[3] <= d[3] and e[4] >= d[4] or d[3] <= e[3] and d[4] >= e[4]) for e in spans):
                labels.add(d[5])
                best = max(best, -d[0] / 100)
                n += 1
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best, n)


TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "MIT License", "GNU General\nPublic  License v3", "CC BY 4.0 and cc-by-sa-4.0",
    "SPDX-License-Identifier: GPL-2.0-or-later", "see https://www.gnu.org/licenses/gpl-3.0.html", "Permission is hereby granted, free of charge",
    "All Rights Reserved. Copyright (c) 2020 x", "the permit licenses", "mitlicense apachelicense", "public domain", "placed into the public domain",
    "BSD 3-Clause", "mozilla public licence, version 2.0", None, "", "CC...BY", "é mit licenseé", "cc by " * 300, "plain words only " * 20000,
    "GNU Affero General Public License v3.0 or GPL v2, released under the terms of the MIT license", "provided \"as is\", without warranty", "creative commons zero",
]


def check(rows, docs, got):
    assert len(got) == len(rows)
    by = dict(rows)
    for r in got:
        assert tuple(r)[1:] == brute(by[r.doc_id]), by[r.doc_id]


def test_against_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[0]), (0, TEXTS[0])]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_words int, labels string")
    check(rows, docs, scan(docs).collect())
    assert scan(docs.limit(0)).collect() == []


def test_wrapped_notices(spark):
    cases = {
        "under the terms of the GNU Lesser General Public\nLicense as published by": ("lgpl", 1),
        " * the GNU General Public License\n * version 3, or later": ("gpl,gpl-3.0", 2),  # the first line's title and the name
        "the GNU Lesser\r\n# General\r\n# Public License,\r\n# version\r\n# 2.1 of": ("lgpl-2.1", 1),
        "GNU GENERAL PUBLIC LICENSE\n2. Copying": ("gpl", 1),
        "BSD\n\nLicense": ("", 0),
        "in the public\ndomain": ("public-domain", 1),
        "MIT License\nISC License\n\nISC License": ("isc,mit", 3),
        "mit license\n" * 500: ("mit", 500),
    }
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.n_detections) for r in scan(docs, wrapped=True).collect()}
    for i, (text, want) in enumerate(cases.items()):
        labels, n = got[i]
        assert (labels, n) == want, text[:80]


def test_wrapped_scan_of_unwrapped_texts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS) if "\n" not in (t or "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, docs, scan(docs, wrapped=True).collect())
    assert not re.search("Python|Pandas|Arrow|Exchange", scan(docs, wrapped=True)._jdf.queryExecution().toString())


def test_copyright_signs(spark):
    rows = list(enumerate(["(c) 2020 x", "© 2020 x", "x (C) 1999 y © 2001", "Copyright © 2020, (c) 2021", "(c) x"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score, r.n_detections) for r in scan(docs).collect()}
    found = ("copyright", 0.6)
    assert got == {0: (*found, 1), 1: (*found, 1), 2: (*found, 2), 3: (*found, 2), 4: ("", 0.0, 0)}
    check(rows, docs, scan(docs, wrapped=True).collect())


def test_every_rule_passes_its_keyword_and_the_gate():
    assert len(rules()) > 200
    for t in filter(None, TEXTS):
        for line in t.translate(LOWER).split("\n"):
            for r in rules():
                if m := re.search(r.pattern, line):
                    assert r.keyword in line and re.search(_GATE, m[0]), (r, line)
    assert len(keywords()) > 40


def test_native_plan(spark):
    plan = scan(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, docs, scan(docs).collect())
    assert any(brute(t)[1] for _, t in rows)


def test_very_long_texts(spark):
    """Runs of blank lines and blanks, and a megabyte of notices: the sweep is linear and no pattern recurses."""
    n = 60_000
    chain = "bsd 3 clause bsd 4 clause licensed under the gnu general public license version 3 mit licensed under mit license "
    texts = {
        "mit license" + "\n" * 1_000_000 + "x": ("mit", 1), "apache license" + "\n# \n\t*" * 200_000 + "x": ("apache", 1),
        "mit license" + " " * 1_000_000 + "x": ("mit", 1), "mit" + " " * 500_000 + "license": ("mit", 1),
        " " * 1_000_000 + "isc license" + "-" * 500_000: ("isc", 1),
        "mit license " * n: ("mit", n), chain * 2000: ("bsd-3-clause,bsd-4-clause,gpl,gpl-3.0,mit", 10_000),
    }
    docs = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    for wrapped in (False, True):
        got = {r.doc_id: (r.labels, r.n_detections) for r in scan(docs, wrapped=wrapped).collect()}
        assert got == dict(enumerate(texts.values()))


def test_many_notices_in_a_line_against_brute_force(spark):
    rng = __import__("random").Random(7)
    words = ["bsd 3 clause", "4 clause bsd", "mit licensed under", "mit license", "the", "licensed under the", "gnu general public license",
             "version 3", "cc by nc sa 4.0", "creative commons attribution share alike", "public domain dedication and license", "x"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate([1, 5, 127, 128, 129, 400])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, docs, scan(docs).collect())
    check(rows, docs, scan(docs, wrapped=True).collect())
