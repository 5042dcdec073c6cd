"""Toxicity: subsequence string-kernel SVM with Nyström landmarks.

The kernel compares short character units (words, spelled-out letter runs,
windows of long tokens) by their gapped letter triples, see
:mod:`workgrid.llm.string_kernel`. Training rows are the sentences of
labelled documents; a sentence carries its document's label. As most
sentences of a toxic document are harmless, the positive examples of the SVM
are the units that tell toxic from clean documents (witnesses), with gapped
and inserted-character spellings of them; the negative examples are units of
clean sentences. A second round, as in multiple-instance learning, adds the
unit that the first model finds worst in each toxic document, and the clean
units that it finds hardest.

The SVM is linear in the Nyström features ``k(u, landmarks) K^(-1/2)``. Its
decision function is a weighted sum of kernels with the landmarks, and so a
weighted sum of the unit's triples; scoring uses that table, which gives the
same values as computing every kernel. A text's margin is the largest of its
units, over all its sentences; a sigmoid fitted on the sample's documents
turns margins into scores.

Bounds of the fit (documented parameters): ``DOCS`` labelled documents per
class, ``NEGATIVES`` clean units, ``HARD`` hardest clean units, ``WITNESSES``
positive units and ``LANDMARKS`` landmarks. Scoring covers every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workgrid.llm import string_kernel as K
from workgrid.llm.common import stored

DOCS = 1500
NEGATIVES = 20_000
HARD = 4_000
WITNESSES = 200
LANDMARKS = 256
FOLDS = 5
MIN_Z = 2.5
MIN_RATIO = 8
FLOOR, CEILING = -3.0, 3.0
_KEEP = 400_000
_SLICE = 1 << 21

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_SPELLED = re.compile(r"(?<!\S)\w(?:\s\w){2,}(?!\S)")
_LETTERS = re.compile(r"[^\W\d_]{3,}")
_EDGES = "".join(map(chr, (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)))) + "«»“”„‘’…–—¡¿"


@dataclass(frozen=True)
class Model:
    """Weights over letter triples, bias, and the sigmoid of the score."""

    table: np.ndarray
    bias: float
    slope: float = 2.0
    offset: float = 0.0

    def margins(self, units: list[str]) -> np.ndarray:
        return K.weighted_sums(units, self.table)[:, 0] + self.bias


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may learn from: crc32 of the id as text is divisible by ``FOLDS``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def units_of_token(token: str) -> list[str]:
    """Kernel units of one lower-cased token: the bare token, its letter runs, windows where it is long."""
    bare = token.strip(_EDGES)
    if len(bare) < 3:
        return []
    found = [K.START + bare]
    if not bare.isalpha():
        found += [K.START + x for x in _LETTERS.findall(bare)]
    out = []
    for u in found:
        if len(u) <= K.WIDTH:
            out.append(u)
        else:
            out += [u[a : a + K.WIDTH] for a in range(0, len(u) - K.WIDTH, K.STRIDE)] + [u[-K.WIDTH :]]
    return out


def tokens(text: str | None) -> set[str]:
    """Distinct lower-cased tokens of a text, spelled-out runs of single characters included."""
    if not text:
        return set()
    low = text.lower()
    return set(low.split()).union(_SPELLED.findall(low))


class Scorer:
    """Margins of whole texts; remembers the margins of tokens seen lately."""

    def __init__(self, model: Model):
        self.model = model
        self.seen: dict[str, float] = {}

    def learn(self, found: set[str]) -> None:
        new = [t for t in found if t not in self.seen]
        if not new:
            return
        if len(self.seen) + len(new) > _KEEP:
            self.seen = {t: self.seen[t] for t in found if t in self.seen}
        units, owner = [], []
        for i, t in enumerate(new):
            for u in units_of_token(t):
                units.append(u)
                owner.append(i)
        best = np.full(len(new), FLOOR)
        if units:
            np.maximum.at(best, np.array(owner), self.model.margins(units))
        self.seen.update(zip(new, best.tolist()))

    def margins(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        lo = 0
        while lo < len(texts):  # slices of bounded size
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size < _SLICE):
                size += len(texts[hi] or "")
                hi += 1
            sets = [tokens(t) for t in texts[lo:hi]]
            self.learn(set().union(*sets))
            get = self.seen.__getitem__
            out[lo:hi] = [max(map(get, s), default=FLOOR) for s in sets]
            lo = hi
        return np.clip(out, FLOOR, CEILING)


def _units(text: str | None) -> set[str]:
    return {u for sentence in _SENTENCE.split(text or "") for t in tokens(sentence) for u in units_of_token(t)}


def _document_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if units := list(_units(text)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(units), pa.array([toxic] * len(units), pa.int32())], names=["unit", "toxic"]
                )


def _worst_units(model: Model):
    """The unit of the largest margin of every text, where it is on the toxic side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [_units(text) for text in batch.column(0).to_pylist()]
            every = sorted(set().union(*bags))
            margin = dict(zip(every, model.margins(every).tolist()))
            best = (max(bag, key=lambda u: (margin[u], u)) for bag in bags if bag)
            found = [u for u in best if margin[u] > 0]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["unit"])

    return run


def _spellings(unit: str) -> list[str]:
    """The unit with gaps, and with one character inserted at several places."""
    rng = np.random.default_rng(sum(unit.encode()))
    out = [unit[0] + sep.join(unit[1:]) for sep in (".", "-", "*", " ") if 2 * len(unit) - 2 <= K.WIDTH]
    for at in range(2, len(unit)):
        if len(unit) < K.WIDTH:
            out.append(unit[:at] + "-" + unit[at:])
            out.append(unit[:at] + chr(97 + int(rng.integers(26))) + unit[at:])
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, reg: float = 1e-4) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM with a bias, by Newton steps on its active rows."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x1.shape[1], reg)
    ridge[-1] = reg * 1e-3
    w = np.zeros(x1.shape[1])
    active = np.ones(len(x), bool)
    for _ in range(50):
        a, s = x1[active], weight[active]
        w = np.linalg.solve(np.diag(ridge) + (a * s[:, None]).T @ a, (a * s[:, None]).T @ y[active])
        now = y * (x1 @ w) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], float(w[-1])


def _fit_svm(positive: list[tuple[str, float]], negative: list[str]) -> Model:
    witnesses = [u for u, _ in positive]
    spelled = [(s, n / 8) for u, n in positive for s in _spellings(u)]
    near = K.kernel(negative, witnesses[: LANDMARKS // 2]).max(axis=1)
    order = np.lexsort((np.arange(len(negative)), -near))
    landmarks = list(dict.fromkeys([*witnesses[: LANDMARKS // 2], *(negative[i] for i in order)]))[:LANDMARKS]
    values, vectors = np.linalg.eigh(K.kernel(landmarks, landmarks))
    values = np.maximum(values, 0)
    root = vectors @ np.diag(np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)) @ vectors.T
    units = [*witnesses, *(s for s, _ in spelled), *negative]
    x = K.kernel(units, landmarks) @ root
    y = np.r_[np.ones(len(witnesses) + len(spelled)), -np.ones(len(negative))]
    weight = np.r_[[n for _, n in positive], [n for _, n in spelled], np.ones(len(negative))]
    weight[y > 0] /= weight[y > 0].sum()
    weight[y < 0] *= 4 / weight[y < 0].sum()
    w, bias = _svm(x, y, weight)
    alpha = root @ w
    return Model(sum(a * K.features(u) for a, u in zip(alpha, landmarks)), bias)


def _sigmoid_fit(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Platt's sigmoid with his smoothed targets."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    w = np.array([2.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - p) - 1e-3 * (w - [2.0, 0.0]))
        w = w + step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 0.1)), float(w[1])


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on at most ``DOCS`` labelled documents per class that are not held out; None if a class has none."""
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    picked = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("_id"), "_id").limit(DOCS) for c in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("text"))
    sample = stored(spark, texts.join(F.broadcast(chosen), "_id").select("text", "toxic"), "toxic_sample")
    spread = sample.repartition(12, F.xxhash64("text"))
    counts = stored(
        spark,
        spread.mapInArrow(_document_units, "unit string, toxic int")
        .groupBy("unit")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")),
        "toxic_units",
    )
    total = sample.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).first()
    if not total["bad"] or not total["good"]:
        return None
    bad, good = F.col("bad") + 0.5, F.col("good") + 0.5
    odds = F.log(bad / good) - F.log(F.lit((total["bad"] + 1.0) / (total["good"] + 1.0)))
    ranked = (
        counts.withColumn("z", odds / F.sqrt(1 / bad + 1 / good))
        .where((F.col("z") >= MIN_Z) & (F.col("bad") >= MIN_RATIO * F.col("good")))
        .orderBy(F.desc("z"), "unit")
        .limit(WITNESSES)
    )
    positive = {r["unit"]: float(r["bad"]) for r in ranked.collect()}
    if not positive:
        return None
    clean = counts.where((F.col("good") > 0) & ~F.col("unit").isin(list(positive))).select("unit")
    negative = [r["unit"] for r in clean.orderBy(F.xxhash64("unit"), "unit").limit(NEGATIVES).collect()]
    if not negative:
        return None
    model = _fit_svm(list(positive.items()), negative)
    worst = spread.where("toxic = 1").select("text").mapInArrow(_worst_units(model), "unit string")
    worst = worst.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "unit").limit(WITNESSES)
    positive = {r["unit"]: float(r["n"]) for r in worst.collect()} | positive
    hard = clean.mapInArrow(_unit_margins(model), "unit string, margin double")
    negative += [r["unit"] for r in hard.orderBy(F.desc("margin"), "unit").limit(HARD).collect()]
    negative = [u for u in dict.fromkeys(negative) if u not in positive]
    model = _fit_svm(sorted(positive.items(), key=lambda x: (-x[1], x[0])), negative)
    rows = spread.mapInArrow(_margins(model, "toxic"), "toxic int, margin double").collect()
    slope, offset = _sigmoid_fit(np.array([r["margin"] for r in rows]), np.array([r["toxic"] for r in rows], float))
    return Model(model.table, model.bias, slope, offset)


def _unit_margins(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.margins(units))], names=["unit", "margin"])

    return run


def _margins(model: Model, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            at = batch.schema.get_field_index(key)
            m = scorer.margins(batch.column(batch.schema.get_field_index("text")).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(at), pa.array(m)], names=[key, "margin"])

    return run


def score(spark: SparkSession, docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, score, predicted)`` for every row of ``docs``.

    Null and empty texts get the lowest score. Without a model (no labels to
    learn from) every score is 0. Rows with equal ids are scored each on
    their own; a null id stays null; other columns are ignored.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if model is None:
        return texts.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    at = spark.sparkContext.broadcast(model)  # a fixed number of triples

    def run(batches):
        return _margins(at.value, "doc_id")(batches)

    s = 1 / (1 + F.exp(-(F.lit(model.slope) * F.col("margin") + F.lit(model.offset))))
    return (
        texts.mapInArrow(run, f"doc_id {kind}, margin double")
        .select("doc_id", s.alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on ``labels(doc_id, toxic)`` and score every row: ``(doc_id, held_out, score, predicted)``."""
    model = fit(spark, docs, labels)
    return score(spark, docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def reject_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that a model fitted on ``labels`` predicts as toxic; columns unchanged, no shuffle of texts."""
    model = fit(spark, docs, labels)
    if model is None:
        return docs
    at = spark.sparkContext.broadcast(model)
    limit = -model.offset / model.slope  # the margin of score 0.5
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(at.value)
        for batch in batches:
            margins = scorer.margins([None if t is None else str(t) for t in batch.column(text).to_pylist()])
            yield batch.filter(pa.array(margins < limit))

    return docs.mapInArrow(run, docs.schema)
