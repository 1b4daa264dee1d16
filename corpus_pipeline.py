"""Corpus pipeline: documents to a training mix in five stages.

Each stage reads everything its predecessor kept; its result is written as
Parquet to the shared folder and read again as the next one's input. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blotter.llm.decontamination import decontaminate
from blotter.llm.frames import read_table, stored
from blotter.llm.line_dedup import dedup_line_runs
from blotter.llm.mixing import mix_sources
from blotter.llm.ngram_join import keep_one_per_component
from blotter.llm.pu_quality import keep_quality


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts."""
    return keep_quality(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without multi-line chunks that occurred before."""
    return dedup_line_runs(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one_per_component(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the words that the mix takes."""
    return mix_sources(spark, docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
]

#: A trained classifier decides the first stage: SQL cannot state its rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
