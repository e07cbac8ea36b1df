"""Corpus pipeline: quality rules, quality classifier, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.llm.ngram_join import ngram_jaccard_join
from cinderspan.llm.packing import best_fit_packing
from cinderspan.llm.quality_classifier import quality_classifier, train
from cinderspan.llm.quality_rules import quality_rules
from cinderspan.llm.substring_dedup import substring_dedup
from cinderspan.session import cut, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep: each row by itself, so repeats stay or go alike; null and empty texts go."""
    return quality_rules(docs.select(F.struct("*").alias("doc"), "text", "lang")).where("kept").select("doc.*")


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as good, each row by itself; null and empty texts get the score of the bias.

    It learns from the labelled rows of the whole table: among what the rules keep, the rejected
    class would hardly occur.
    """
    model = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier(docs.select(F.struct("*").alias("doc"), "text"), model).where("predicted = 1").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Of rows that repeat both id and text one stays; rows of one id with different texts all stay
    with their id. Rows without an id have no group, so of those only repeats of a text go.
    """
    kept = ngram_jaccard_join(docs).where("doc_id = component_id").select("doc_id").distinct()
    own = [F.col(f"`{c}`") for c in docs.columns]
    left = docs.join(kept, ["doc_id"], "left_semi").select(*own).unionByName(docs.where("doc_id IS NULL"))
    repeats = docs.groupBy("doc_id", F.xxhash64("text")).count().where("count > 1")
    return left if repeats.isEmpty() else left.dropDuplicates(["doc_id", "text"])


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the repeated passages; ``n_chars`` follows the text. No row goes; null texts and ids stay as they are."""
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")))
    cut_docs = substring_dedup(docs.select("doc_id", "text", rest.alias("rest")))
    new = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.coalesce(F.length("text").cast("bigint"), F.col("rest.n_chars"))}
    return cut_docs.select(*(new.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens; a null text is a piece of the end id alone."""
    return best_fit_packing(docs)


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("n-gram jaccard join", near_duplicates),
    ("substring dedup", passages),
    ("best-fit packing", packing),
]

#: Hash chains, training and packing have no SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"pipeline-{k}")
    return docs
