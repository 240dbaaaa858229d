"""From raw documents to token files, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is
written as Parquet in the shared folder and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dimkiln.llm import decontaminate, mixing, quality, simhash, token_output
from dimkiln.llm.common import materialise, read_table, scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labels of ``docs``."""
    return quality.drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item: neither a whole one of 24 characters or more
    within 8 % edits nor a shorter one word for word. Partial quotes stay."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, shuffled globally."""
    return mixing.mix(docs).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the token files of ``docs``."""
    files = token_output.write_tokens(docs, scratch_path(spark, "pipeline-tokens"))
    return token_output.read_tokens(spark, files, with_ids=False)


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

# a trained classifier and a tokenizer are not SQL; tests hold every stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
