"""Corpus pipeline over ``documents``: filter, deduplicate, decontaminate, tokenize.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and returns
a DataFrame that is written as Parquet and read again as the next stage's
documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workgrid.llm.bpe import encoding_digests
from workgrid.llm.common import stored
from workgrid.llm.decontaminate import drop_contaminated
from workgrid.llm.line_dedup import remove_repeated_lines
from workgrid.llm.simhash import one_per_group
from workgrid.llm.toxicity import reject_toxic
from workgrid.sources.driver import read_table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, does not predict as toxic."""
    return reject_toxic(spark, docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of repeated three-line windows; those left without text go."""
    clean = remove_repeated_lines(docs)
    text = F.col("text")
    kept = clean.where((F.col("n_removed") == 0) | (F.trim(text) != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("n_removed") > 0, F.length(text).cast(kind)).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", changed)
    return kept.select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of near duplicates: 4-word shingles, at most 4 differing bits."""
    return one_per_group(spark, docs, shingle=4, max_bits=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of ``benchmark``."""
    return drop_contaminated(spark, docs, read_table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes decoded from them."""
    path = public_tokenizers.path(VOCABULARY)
    return encoding_digests(docs, path, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe", bpe),
]

#: The classifier, the fingerprints and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return docs


def pipeline_queries() -> dict:
    return {"pipeline": run}


def pipeline_oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
