"""The corpus pipeline: documents that are in a known language, good, not near-copies of
others and free of benchmark passages, packed into sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last
return the columns of documents. ``run`` writes each stage's rows to the shared folder and
reads them again. SQL cannot express compression, the classifier's fit or XXH64.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from equitylake.llm import common, decontaminate, language, packing, quality, simhash


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, common.read_table(spark, sf_dir, "labels"))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, common.read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_digests(docs)


STAGES = [
    ("language", language_stage),
    ("quality", quality_stage),
    ("near copies", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = common.staged(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, rows, sf_dir)
