"""The queries ``opN_<name>`` and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgrain.llm import decontaminate, host_rules, lexical, packing, perplexity, pii, simhash, spelling, token_counts, token_files, toxicity, url_filter, warc
from opsgrain.llm.common import load
from opsgrain.llm.oracle import ORACLES


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(load(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.apply_host_rules(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolve_revisits(warc.captures(load(spark, sf_dir, "pages")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return perplexity.judge(docs, load(spark, sf_dir, "labels")).select("doc_id", "perplexity", "shrunk", "threshold", "kept")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), payload=F.crc32("ids").alias("ids_crc32"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(load(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that a passage of it holds."""
    return decontaminate.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, load(spark, sf_dir, "labels"), carried=["doc_id"]))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(load(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(load(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.lexical_search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(load(spark, sf_dir, "documents"))
    counts = [pii.count_of("base", k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"), pii.digest(F.col("spans")).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_quality_rules, op3_warc, op4_simhash, op5_quality_classifier, op6_packing, op7_token_files, op8_decontamination, op9_toxicity, op10_url_filters, op11_spelling_variants, op12_lexical_search, op13_personal_data)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
