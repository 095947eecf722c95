"""From raw documents to packed training sequences, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all that the
stage before kept; between stages the documents are written as Parquet in the
shared folder and read again, so a lost executor never costs more than one
stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenure.llm import language, line_dedup, lsh_forest, mixing, packing
from tenure.llm.common import table
from tenure.llm.queries import tokenizer_path
from tenure.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without one go."""
    return language.keep_known(docs, language.learn(docs))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines are cut out; documents that lose all their lines go."""
    return line_dedup.without_repeats(docs, drop_emptied=True)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return lsh_forest.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source in its target share: documents come not at all, once or twice."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a training sequence."""
    # four other stages have run in the same workers: this one keeps less in memory than it would alone
    return packing.pack_documents(docs, tokenizer_path(spark), cache_words=250_000, chunk_bytes=1 << 20)


STAGES = [
    ("language_id", language_id),
    ("line_deduplication", line_deduplication),
    ("near_deduplication", near_deduplication),
    ("source_mix", source_mix),
    ("best_fit_packing", packing_stage),
]

#: The stages learn, cluster, sample and pack; none of that is SQL. Tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
