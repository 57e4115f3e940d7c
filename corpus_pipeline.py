"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the
next one's documents.  All but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayflow.llm import jaccard, mixing, quality, suffixdedup, tiling
from stayflow.llm.common import prepare, read, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    prepare(spark)
    return quality.kept_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingle similarity of 0.8 or more."""
    prepare(spark)
    return jaccard.one_of_each(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without 100-byte strings that also start earlier."""
    prepare(spark)
    return suffixdedup.without_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item is covered by."""
    prepare(spark)
    return tiling.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' target weights, globally shuffled."""
    prepare(spark)
    return mixing.mix_sources(docs)


STAGES = [("quality_rules", quality_stage), ("ngram_jaccard_join", near_duplicate_stage), ("suffix_dedup", suffix_stage),
          ("benchmark_decontamination", decontamination_stage), ("mixing", mixing_stage)]

#: Stages 2 to 4 are beyond SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
