import math

import numpy as np
import pandas as pd
import pytest

from workgrid.llm import quality as Q

SF = "/root/testdata/sf0.01"


def brute_sites(rows):
    """Means by plain loops over (host, path, p)."""
    df = pd.DataFrame(rows, columns=["host", "path", "p"])
    df["noise"] = df.p * (1 - df.p)
    paths = df.groupby(["host", "path"], dropna=False).agg(n=("p", "size"), good=("p", "sum"), noise=("noise", "sum")).reset_index()
    hosts = paths.groupby("host", dropna=False)[["n", "good", "noise"]].sum().reset_index()
    mean = hosts.good.sum() / hosts.n.sum()

    def strength(s, prior):
        spread = (s.n * (s.good / s.n - prior) ** 2).sum()
        excess = (spread - (s.noise / s.n).sum()) / s.n.sum()
        m = s.good.sum() / s.n.sum()
        return min(max(m * (1 - m) / excess - 1 if excess > 0 else Q.MAX_STRENGTH, Q.MIN_STRENGTH), Q.MAX_STRENGTH)

    hs = strength(hosts, mean)
    hosts["mean"] = (hosts.good + mean * hs) / (hosts.n + hs)
    host_mean = {None if h is None else h: m for h, m in zip(hosts.host, hosts["mean"])}
    ps = strength(paths, paths.host.map(lambda h: host_mean[h]))
    return mean, hs, ps, host_mean


def test_posteriors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for h in range(30):
        rate = rng.beta(4, 2)
        for p in range(rng.integers(1, 4)):
            for _ in range(rng.integers(1, 40 if h else 2000)):
                rows.append((f"h{h}", f"p{p}", float(np.clip(rng.normal(rate, 0.1), 0.01, 0.99))))
    df = spark.createDataFrame(rows, "host string, path string, p double")
    prior, sites = Q.posteriors(spark, df)
    mean, hs, ps, host_mean = brute_sites(rows)
    assert (prior.mean, prior.host_strength, prior.path_strength) == pytest.approx((mean, hs, ps))
    for s in sites.collect():
        assert s.host_mean == pytest.approx(host_mean[s.host])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in Q.quality(spark, docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count()
    held = [i for i in truth if rows[i].held_out]
    assert np.mean([rows[i].predicted == truth[i] for i in held]) > 0.95
    r = next(iter(rows.values()))
    odds = r.evidence + math.log(r.path_mean / (1 - r.path_mean))
    assert r.score == pytest.approx(1 / (1 + math.exp(-odds)))


def test_odd_inputs(spark):
    rows = [(i, ("good words here and there. " if i % 2 else "bad ### $$$ ||| ") * 5, f"s{i % 3}", None) for i in range(60)]
    rows += [(100, None, None, "x"), (101, "", "s0", "x"), (None, "z " * 50000, "s1", "y"), (0, rows[0][1], "s0", None)]
    docs = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, source string, lang string, p double")
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(60)] + [(None, 1, "x"), (3, None, "x")], "doc_id long, quality int, text string")
    got = Q.quality(spark, docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 60)
    none = Q.quality(spark, docs, labels.limit(0)).collect()
    assert len(none) == len(rows) and all(r.score == pytest.approx(0.5) for r in none)
    assert Q.quality(spark, docs.limit(0), labels).collect() == []


def test_site_means_leave_the_document_out(spark):
    """Means of every document against loops over all other documents of its host and path; hosts of one document too."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.selectExpr("doc_id", "text", "if(doc_id % 9 = 0, concat('alone', doc_id), source) AS source", "lang")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = Q.quality(spark, docs, labels).collect()
    known = Q._known(labels).toPandas()["quality"].mean()
    odds = math.log((known + 1e-6) / (1 - known + 1e-6))
    p = [1 / (1 + math.exp(-(r.evidence + odds))) for r in got]
    mean, hs, ps, _ = brute_sites([(r.host, r.path, x) for r, x in zip(got, p)])
    alone = 0
    for i, r in enumerate(got):
        host = [p[j] for j, o in enumerate(got) if j != i and o.host == r.host]
        path = [p[j] for j, o in enumerate(got) if j != i and (o.host, o.path) == (r.host, r.path)]
        want = (sum(host) + mean * hs) / (len(host) + hs)
        assert r.host_mean == pytest.approx(want, abs=1e-9)
        assert r.path_mean == pytest.approx((sum(path) + want * ps) / (len(path) + ps), abs=1e-9)
        if not host:
            alone += 1
            assert r.path_mean == pytest.approx(mean)
    assert alone


def test_sites_from_addresses(spark):
    urls = {"https://WWW.Example.com:80/en/1?x#y": ("example.com", "/en"), "http://u:p@m.example.org": ("m.example.org", "/"),
            "http://a.net?q=/x": ("a.net", "/"), "no address": (None, None), None: (None, None), "ftp://h/": ("h", "/")}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: (r.h, r.s) for r in df.select("url", Q.url_host(df.url).alias("h"), Q.url_section(df.url).alias("s")).collect()}
    assert got == urls
    docs = df.selectExpr("monotonically_increasing_id() AS doc_id", "url AS text", "url")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {(r.host, r.path) for r in Q.quality(spark, docs, none).collect()} == set(urls.values())
