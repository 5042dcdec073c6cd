"""Registered queries of this subpackage: one ``opN_<name>`` per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workgrid.sources.driver import read_table

#: Key of the registered query; a deployment passes its own secret.
PII_KEY = "registered query"

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from workgrid.llm.toxicity import toxicity

    return toxicity(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from workgrid.llm.token_files import read_token_files, write_token_files
    from workgrid.session import scratch_path

    folder = scratch_path(spark, "llm", "token_files")
    docs = read_table(spark, sf_dir, "documents")
    write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_token_files(spark, folder)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from workgrid.llm.quality import quality

    return quality(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from workgrid.llm.bpe import encoding_digests

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encoding_digests(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from workgrid.llm.line_dedup import remove_repeated_lines

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_lines(docs)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from workgrid.llm.decontaminate import contained_items

    found = contained_items(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("row")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from workgrid.llm.simhash import near_duplicates

    return near_duplicates(spark, read_table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from workgrid.llm.topk import top_k

    return top_k(spark, read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from workgrid.llm.licenses import scan

    return scan(read_table(spark, sf_dir, "documents"), wrapped=True)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from workgrid.llm.pii import pseudonymise

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, PII_KEY)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from workgrid.llm.hard_negatives import mine

    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark, rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from workgrid.llm.whitening import whiten

    return whiten(spark, read_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op13_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from workgrid.llm.one_bit_search import nearest_neighbours

    return nearest_neighbours(spark, read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def llm_queries() -> dict[str, Query]:
    return {
        "op1_toxicity": op1_toxicity,
        "op10_pii": op10_pii,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_whitening": op12_whitening,
        "op13_one_bit_search": op13_one_bit_search,
        "op2_token_files": op2_token_files,
        "op3_quality": op3_quality,
        "op4_bpe": op4_bpe,
        "op5_line_dedup": op5_line_dedup,
        "op6_topk": op6_topk,
        "op7_licenses": op7_licenses,
        "op8_decontamination": op8_decontamination,
        "op9_simhash_near_dedup": op9_simhash_near_dedup,
    }


def llm_oracle_sql() -> dict[str, str]:
    from workgrid.llm import decontaminate, hard_negatives, line_dedup, topk

    return {
        "op11_hard_negatives": hard_negatives.ORACLE,
        "op5_line_dedup": line_dedup.ORACLE,
        "op6_topk": topk.ORACLE,
        "op8_decontamination": decontaminate.ORACLE,
    }
