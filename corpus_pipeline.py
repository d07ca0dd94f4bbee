"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and keeps the columns of ``documents``;
the last returns pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlink.llm import common, fertility_rules, packing, quality_classifier, shingle_join, suffix_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects. It learns from the labelled documents of the table itself."""
    forest = quality_classifier.train(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs.select(*COLUMNS), forest, 0.7, *COLUMNS[1:])
    return scored.where("predicted = 1").select(*COLUMNS)


def rule(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality rules reject."""
    kept = fertility_rules.rules(docs, common.tokenizer_path("piece_bpe_32k.model"), common.tokenizer_path("byte_bpe_multi_50k.tiktoken"), keep=COLUMNS[1:])
    return kept.where("kept").select(*COLUMNS)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of least id of each class of near duplicates, and one of rows that repeat; rows without an id stay."""
    classes = common.staged(shingle_join.join(docs), "classes-of-pipeline")
    stay = classes.where("doc_id = class_id").select("doc_id").distinct()
    some = docs.select(*COLUMNS)
    once = some.where("doc_id is not null").join(stay, "doc_id").dropDuplicates(["doc_id", "text"])
    return once.select(*COLUMNS).unionByName(some.where("doc_id is null"))


def cut(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated byte strings; bytes of a character that was cut in two go as well. A document of which only white space is left goes."""
    left = suffix_dedup.removals(docs, keep=COLUMNS[2:], as_text=True).withColumn("n_chars", F.length("text").cast("long"))
    return left.where("regexp_like(text, r'[^\\x20\\x09-\\x0D]')").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 4096 tokens."""
    return packing.pack(docs, common.tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality classifier", classify), ("quality rules", rule), ("n-gram Jaccard join", dedup), ("suffix-array dedup", cut), ("packing", pack)]
ORACLE_SQL = None  # trees, tokenisers and transforms are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL}
