"""A cleaning pipeline over a corpus: each stage takes what the one before has kept.

Toxic documents go; later copies of repeated line runs are deleted, and documents that they were all of; one
document of each group of near duplicates stays; contaminated documents go; the rest is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layercake.llm.byte_bpe import encode, public_vocabulary
from layercake.llm.decontaminate import decontaminate, small
from layercake.llm.line_dedup import dedup_lines
from layercake.llm.ngram_join import Similarity, ngram_components
from layercake.llm.scratch import Scratch
from layercake.llm.text import table
from layercake.llm.toxicity import score, train

NEAR = Similarity(n=5, percent=80)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model of the labels of ``docs``."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return score(docs, train(docs, labels)).filter("predicted = 0").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs. One that loses its last word goes; ``n_chars`` follows."""
    made = dedup_lines(docs).filter("size(deleted) = 0 OR text RLIKE '\\\\S'")
    n_chars = F.when(F.size("deleted") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return made.withColumn("n_chars", n_chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id. Repeated rows stay once."""
    kept = ngram_components(docs, NEAR).filter("component_id <=> doc_id").select(*docs.columns)
    again = docs.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    again = small(again)
    return kept.join(again, "doc_id", "left_anti").union(kept.join(again, "doc_id", "left_semi").distinct())


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of any benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).filter("NOT contaminated").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and digests of them and of what they decode to."""
    path, pattern = public_vocabulary()
    back = encode(docs.select("doc_id", "text"), path, pattern, with_decoded=True)
    return back.select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", encoding),
]
ORACLE_SQL = None  # a trained model, suffix ranks and token ids have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each stage's result is written before the next reads it."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
    return docs
