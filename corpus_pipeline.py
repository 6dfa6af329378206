"""The corpus pipeline: toxic documents go, near duplicates and repeated passages go, benchmark leaks go, the rest is packed.

Each stage takes (spark, docs, sf_dir) and works on all documents the stage before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.common import fingerprint, free_names, stored, table
from plumbline.llm.decontamination import without_leaks
from plumbline.llm.near_dedup import near_duplicates
from plumbline.llm.packing import packed
from plumbline.llm.queries import word_tokenizer
from plumbline.llm.substring_dedup import without_repeated_spans
from plumbline.llm.toxicity import toxic_passages

#: learnt from, and so no measure of accuracy, are rows whose crc32(doc_id as text) mod 5 is not 0
TRAIN = "crc32(cast(id as string)) % 5 <> 0"


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents but those whose id and fingerprint are listed in (doc_id, tag)."""
    of_id, of_tag = free_names(docs, "_gone_id", "_gone_tag")
    gone = stored(gone.select(F.col("doc_id").alias(of_id), F.col("tag").alias(of_tag)).distinct(), "gone")
    same = F.col("doc_id").eqNullSafe(F.col(of_id)) & (fingerprint(F.col("text")) == F.col(of_tag))
    return docs.join(gone.hint("shuffle_hash"), same, "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic; rows that share an id and the text share the prediction."""
    found = toxic_passages(docs, table(spark, sf_dir, "labels"), F.expr(TRAIN), keep_tag=True)
    return _without(docs, found.where("predicted = 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id; texts without words all stay.

    Rows that share an id but not the text are documents of their own, rows that share both are one document, of which one row stays.
    """
    found = stored(near_duplicates(docs, size=5, threshold=80, keep_tag=True), "near-duplicates")
    left = _without(docs, found.where("not chosen")).select(*docs.columns)
    again = found.where("chosen and n_shingles > 0").groupBy("doc_id", "tag").agg(F.count("*").alias("n")).where("n > 1")
    if again.isEmpty():
        return left
    of_id, of_tag = free_names(docs, "_again_id", "_again_tag")
    again = stored(again.select(F.col("doc_id").alias(of_id), F.col("tag").alias(of_tag)), "repeated")
    same = F.col("doc_id").eqNullSafe(F.col(of_id)) & (fingerprint(F.col("text")) == F.col(of_tag))
    once = left.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(again, same, "left_anti").unionByName(once)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without sentences that an earlier one holds; n_chars follows the text."""
    left = without_repeated_spans(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens, with their token ids."""
    return packed(docs, word_tokenizer())


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL cannot express the learnt model, the tokenizer and the curve; tests/llm holds plain loops for the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
