"""A corpus in five stages: drop low quality and unknown languages, near duplicates and benchmark passages, then mix sources.

Each stage takes the documents that the one before kept, written as Parquet and read again; all but the last return the columns
of ``documents``. ``ORACLE_SQL`` is None, as SQL can express neither classifier.

Null, empty and repeated rows are treated as the operators say: an empty text scores as the labels' share of label 1 and has
no language, so it goes with the unknown ones; rows without an id have no near duplicates; a text that is null is no passage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bulkapply.llm import decontaminate, lang_kernel, mixing, near_dups, quality_knn
from bulkapply.llm.common import table
from bulkapply.storage import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_knn.keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lang_kernel.keep_recognised(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document left."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality),
    ("language identification", language),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixture),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
