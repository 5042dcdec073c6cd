"""Quality classifier: document evidence combined with host and path posteriors by empirical Bayes.

1. A logistic regression on shape features of the text (computed with
   DataFrame functions) gives every document its evidence: the log
   likelihood ratio of good against bad, prior odds taken out.
2. Hosts and paths collect the classifier's probabilities of their documents
   by grouped aggregation. Shrinkage is hierarchical: a path's rate is drawn
   towards its host's rate, a host's towards the global one. The prior
   strengths are estimated from all sites (method of moments on the spread
   of their rates beyond sampling noise), so a site of a few documents stays
   near its prior and a site of many speaks for itself.
3. A document's score combines its evidence with the prior odds of its path;
   the document's own share is taken out of the path and out of the host.

Labels are used by the fit alone, on at most ``SAMPLE`` labelled documents
per class; every document and every site enters the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workgrid.llm.common import stored
from workgrid.llm.toxicity import held_out

SAMPLE = 3000
RIDGE = 1.0
MAX_EVIDENCE = 8.0
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6

_CLASSES = (
    ("capitals", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("digits", "0123456789"),
    ("marks", "#$%&*@^~<>{}[]\\_=+"),
    ("bars", "|"),
    ("shouts", "!"),
    ("stops", ".,;:?"),
    ("spaces", " "),
)


def features(text: Column) -> dict[str, Column]:
    """Shape features of a text, each of limited size; an empty text has zeros."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    out = {"log_length": F.log1p(F.length(text).cast("double")) / 5}
    for name, chars in _CLASSES:
        share = (F.length(text) - F.length(F.translate(text, chars, ""))) / n
        out[name] = F.sqrt(share)
        if name in ("marks", "bars", "shouts", "capitals"):
            out[f"any_{name}"] = F.least(share * 20, F.lit(1.0))
    words = F.split(text, " ", -1)
    lines = F.split(text, "\n", -1)
    out["distinct_words"] = F.size(F.array_distinct(words)) / F.size(words).cast("double")
    out["distinct_lines"] = F.size(F.array_distinct(lines)) / F.size(lines).cast("double")
    out["log_lines"] = F.log1p(F.size(lines).cast("double")) / 3
    out["word_length"] = n / F.size(words) / 10
    return {k: F.greatest(F.least(v, F.lit(5.0)), F.lit(-5.0)) for k, v in out.items()}


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def evidence(self, text: Column) -> Column:
        """Log likelihood ratio of good against bad, within ``MAX_EVIDENCE``."""
        total = F.lit(self.bias)
        for name, value in features(text).items():
            total = total + value * self.weights[name]
        return F.greatest(F.least(total, F.lit(MAX_EVIDENCE)), F.lit(-MAX_EVIDENCE))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _known(labels: DataFrame) -> DataFrame:
    return (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.max("quality").alias("quality"))
    )


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model | None:
    """Ridge logistic regression with balanced classes on the bounded sample; None if a class has no document."""
    known = _known(labels)
    picked = [known.where(F.col("quality") == c).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE) for c in (0, 1)]
    chosen = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * SAMPLE ids
    rows = docs.select(F.col("doc_id").alias("_id"), _text().alias("text")).join(chosen, "_id")
    names = list(features(F.col("text")))
    found = rows.select("quality", *(c.alias(k) for k, c in features(F.col("text")).items())).toPandas()
    y = found["quality"].to_numpy(float)
    if not 0 < y.sum() < y.size:
        return None
    x = found[names].to_numpy(float)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    x = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (y.size - y.sum())) * y.size
    ridge = np.r_[np.full(len(names), RIDGE), 1e-6]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * w)
        w += step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    each = w[:-1] / scale
    return Model(dict(zip(names, each.tolist())), float(w[-1] - each @ mean))


@dataclass(frozen=True)
class Prior:
    """What all sites say together: the global rate, and how many documents each level's prior is worth."""

    mean: float
    host_strength: float
    path_strength: float


def strength(sites: DataFrame, prior: Column) -> float:
    """How many documents the prior mean of ``sites(n, good, noise)`` is worth.

    The spread of site rates around their prior, less what sampling noise
    explains, is the variance of a beta distribution of this strength.
    ``noise`` is the expected squared deviation of one document.
    """
    rate = F.col("good") / F.col("n")
    r = sites.agg(
        F.sum("n").alias("n"),
        F.sum("good").alias("good"),
        F.sum(F.col("n") * F.pow(rate - prior, F.lit(2.0))).alias("spread"),
        F.sum("noise").alias("noise"),
    ).first()
    if not r["n"]:
        return MIN_STRENGTH
    mean, excess = r["good"] / r["n"], (r["spread"] - r["noise"]) / r["n"]
    raw = mean * (1 - mean) / excess - 1 if excess > 0 else MAX_STRENGTH
    return min(max(raw, MIN_STRENGTH), MAX_STRENGTH)


def posteriors(spark: SparkSession, scored: DataFrame) -> tuple[Prior, DataFrame]:
    """The prior, and ``(host, path, path_n, path_good, host_n, host_good, host_mean)`` per path, of ``scored(host, path, p)``.

    A hot host is reduced to a row per path and map task before any shuffle;
    three numbers reach the driver.
    """
    paths = stored(
        spark,
        scored.groupBy("host", "path").agg(
            F.count(F.lit(1)).cast("double").alias("path_n"),
            F.sum("p").alias("path_good"),
            F.sum(F.col("p") * (1 - F.col("p"))).alias("path_noise"),
        ),
        "paths",
    )
    hosts = paths.groupBy("host").agg(
        F.sum("path_n").alias("n"), F.sum("path_good").alias("good"), (F.sum("path_noise") / F.sum("path_n")).alias("noise")
    )
    mean = hosts.agg(F.sum("good") / F.sum("n")).first()[0] or 0.0
    of_hosts = strength(hosts, F.lit(mean))
    shrunk = hosts.select(
        F.col("host").alias("_host"), F.col("n").alias("host_n"), F.col("good").alias("host_good"),
        ((F.col("good") + mean * of_hosts) / (F.col("n") + of_hosts)).alias("host_mean"),
    )
    joined = paths.join(shrunk, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    of_paths = joined.select(
        F.col("path_n").alias("n"), F.col("path_good").alias("good"), (F.col("path_noise") / F.col("path_n")).alias("noise"), "host_mean"
    )
    prior = Prior(mean, of_hosts, strength(of_paths, F.col("host_mean")))
    return prior, joined.select("host", "path", "path_n", "path_good", "host_n", "host_good", "host_mean")


def url_host(url: Column) -> Column:
    """Host of an address in lower case, without user, port and a leading ``www.``; null without one."""
    found = F.regexp_extract(F.lower(url.cast("string")), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1)
    return F.nullif(found, F.lit(""))


def url_section(url: Column) -> Column:
    """First section of an address's path, ``/`` where it has none; null without a host."""
    found = F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)
    return F.when(url_host(url).isNotNull(), F.concat(F.lit("/"), found))


def _logit(p: Column) -> Column:
    q = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(q / (1 - q))


def quality(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None
) -> DataFrame:
    """``(doc_id, held_out, score, predicted, host, path, evidence, host_mean, path_mean)`` for every row of ``docs``.

    ``host`` and ``path`` are expressions over ``docs`` (default: host and first path section of ``url`` where there is
    such a column, else ``source``, and ``lang`` within it). ``host_mean`` and ``path_mean`` are the means of the other
    documents of the site, shrunk towards the level above.

    * ``score`` is the posterior probability of quality 1, ``predicted`` is 1 from 0.5 on;
    * null and empty texts have zero features; null hosts and paths are sites like others;
    * without labels of both classes the evidence is 0 and the means are one half;
    * rows are scored one by one, equal rows equally; an empty table gives an empty result.
    """
    by_url = "url" in docs.columns
    if host is None:
        host = url_host(F.col("url")) if by_url else F.col("source")
    if path is None:
        path = url_section(F.col("url")) if by_url else F.col("lang")
    site = [host.cast("string"), path.cast("string")]
    model = fit(spark, docs, labels)
    evidence = F.lit(0.0) if model is None else model.evidence(_text())
    base = docs.select("doc_id", site[0].alias("host"), site[1].alias("path"), evidence.cast("double").alias("evidence"))
    known = _known(labels).agg(F.avg("quality").alias("m")).first()["m"]  # the prior odds of the labelled documents
    odds = 0.0 if model is None else float(np.log((known + 1e-6) / (1 - known + 1e-6)))
    scored = stored(spark, base.withColumn("p", 1 / (1 + F.exp(-(F.col("evidence") + F.lit(odds))))), "quality")
    prior, sites = posteriors(spark, scored)
    names = {"host": "_host", "path": "_path"}
    same = F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))
    # The document's own probability is taken out of its host and of its path.
    rest = lambda site: (F.col(f"{site}_n") - 1, F.greatest(F.col(f"{site}_good") - F.col("p"), F.lit(0.0)))
    host_n, host_good = rest("host")
    path_n, path_good = rest("path")
    host_mean = (host_good + prior.mean * prior.host_strength) / (host_n + prior.host_strength)
    path_mean = (path_good + F.col("host_mean") * prior.path_strength) / (path_n + prior.path_strength)
    score = 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("path_mean")))))
    return (
        scored.join(sites.withColumnsRenamed(names), same)
        .withColumn("host_mean", host_mean)
        .withColumn("path_mean", path_mean)
        .withColumn("score", score)
        .select(
            "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
            "host", "path", "evidence", "host_mean", "path_mean",
        )
    )
