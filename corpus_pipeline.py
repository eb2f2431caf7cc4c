"""The corpus pipeline: quality classifier, toxicity, SimHash near-dedup,
benchmark decontamination, best-fit packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; all but the last return the columns of ``docs``.  ``run``
writes each stage's result as Parquet to the shared folder and reads it back.

Defined results: an empty table passes every stage as an empty one; extra
columns pass unchanged, whatever their names; rows without a doc_id are judged
by their text, and so are rows that share one: near-dedup keeps one row of each
group of near-copies, and every row that is near nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgrain.llm import decontaminate, packing, perplexity, simhash, toxicity
from opsgrain.llm.common import broadcast_if_small, in_few_files, load, stored

CORE = ("doc_id", "text", "lang", "source", "n_chars")


def _plain(docs: DataFrame) -> DataFrame:
    """``docs`` with neutral names for all but the known columns."""
    return docs.toDF(*(c if c in CORE else f"_extra_{i}" for i, c in enumerate(docs.columns)))


def _restored(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from a result over ``_plain(docs)``."""
    return out.select(*_plain(docs).columns).toDF(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents whose perplexity is above their threshold go."""
    return _restored(perplexity.judge(_plain(docs), load(spark, sf_dir, "labels")).where("kept"), docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents predicted toxic go."""
    plain = _plain(docs)
    model = toxicity.fit(plain, load(spark, sf_dir, "labels"))
    return _restored(toxicity.score(plain, model).where("predicted = 0"), docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each component the row with the smallest doc_id stays.
    Rows that share a doc_id, or have none, are told apart by fingerprint: of a
    component that begins with one of them, the smallest text stays."""
    plain = _plain(docs)
    found = stored(simhash.near_duplicates(plain), "near-duplicates")
    n = found.count()
    several = stored(in_few_files(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), n), "repeated-ids")
    gone = stored(in_few_files(found.where("doc_id <> component_id").select("doc_id").distinct(), n), "duplicate-ids")
    kept = plain.where("doc_id is not null").join(broadcast_if_small(gone), "doc_id", "left_anti")
    bare = not found.where("doc_id is null").isEmpty()
    if bare or not several.isEmpty():
        several = broadcast_if_small(several)
        kept = kept.join(several, "doc_id", "left_anti")
        unclear = plain.join(several, "doc_id", "left_semi").select(*plain.columns).unionByName(plain.where("doc_id is null"))
        unclear = stored(simhash.with_fingerprints(unclear, "_fp"), "repeated-rows")
        # rows that begin their component, one for each component
        first = found.where("doc_id <=> component_id").select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"), F.col("root").alias("_root")).distinct()
        begin = unclear.join(first, (F.col("doc_id").eqNullSafe(F.col("_id"))) & (unclear["_fp"] == first["_fp"])).drop(first["_fp"])
        row = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(plain.columns)))
        one = begin.groupBy("_root").agg(F.min_by(row, F.struct(F.coalesce("text", F.lit("")), "_fp")).alias("x"))
        kept = kept.unionByName(one.select("x.*").toDF(*plain.columns))
    return _restored(kept, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents with a passage that holds a benchmark item go."""
    items = decontaminate.question_answer(load(spark, sf_dir, "benchmark"))
    return _restored(decontaminate.with_hits(_plain(docs), items).where("size(hits) = 0"), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the pieces of all documents, with their ids and places."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the fitted and tokenising stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
