"""The registered queries of this subpackage: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkapply.llm import (
    decontaminate,
    lang_kernel,
    line_dedup,
    mixing,
    near_dups,
    ppm,
    quality_knn,
    quality_rules,
    token_alignment,
    token_counts,
    url_filters,
    vector_codes,
    warc,
)
from bulkapply.llm.common import table
from bulkapply.storage import scratch_path


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after personal data is taken out, recounted where it was."""
    counted = token_counts.recount(table(spark, sf_dir, "documents"), token_counts.redactions(F.col("text")))
    return counted.select("doc_id", "n_edits", "n_chars", "chars_encoded", "tokens_before", "tokens_after")


# Hosts whose pages are listed: mobile mirrors and names of spam; and the contract's rules.
LISTED_HOSTS = r"^m\.|casino|pills|bets|ads-"
RULES = [
    url_filters.Rule("allow", "com", "/"), url_filters.Rule("block", "example.com", "/en/"),
    url_filters.Rule("allow", "www.example.com", "/en/"), url_filters.Rule("block", "net", "/es/"),
    url_filters.Rule("block", "net", "/fr/"),
]


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list has every page, by host and path, of the hosts that ``LISTED_HOSTS`` names."""
    pages = table(spark, sf_dir, "pages")
    host, path = url_filters.host_and_path(F.col("url"))
    listed = pages.where(host.rlike(LISTED_HOSTS)).select(F.concat(host, path).alias("key")).distinct()
    return url_filters.judge(pages, RULES, listed).drop("listed")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as monolithic archives, rewritten with a member per record, and read back."""
    whole, by_record = scratch_path(spark, "monolithic"), scratch_path(spark, "warc")
    warc.write_monolithic(warc.records(table(spark, sf_dir, "pages")), whole)
    warc.normalise(spark, whole, by_record)
    return warc.payloads(warc.read(spark, f"{by_record}/kind=archive"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start")


def op5_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op8_lang_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_kernel.classify(table(spark, sf_dir, "documents"))


def op9_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of 4-word shingles at 80 %, as this query's contract says; the operator's own default is five words."""
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.withColumn("codebooks_sha256", F.lit(vector_codes.digest(books)))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment.align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return found.select(*(c for c in found.columns if c != "groups"), digest)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op") and callable(query)}
