"""The corpus pipeline: five stages from raw documents to a training mix.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and
returns a DataFrame.  ``run`` writes each stage's rows as Parquet in the shared
scratch folder and reads them again for the next, so a stage never depends on the
lineage of those before it, and a lost executor costs tasks of one stage only.

All stages but the last return the columns of ``documents``; the last adds how
often the mix repeats each document.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from vitrina.llm import decontam, jaccard, lines, mixing, quality
from vitrina.llm.common import read
from vitrina.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier line; those left without words go."""
    return lines.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by 5-word shingles at 0.8 or more."""
    return jaccard.one_per_group(docs, k=5, num=80, den=100)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no stretch of a benchmark item."""
    return decontam.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``mix_repeats``."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
]

#: SQL cannot express the first four stages; ``tests/llm`` holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
