"""A training corpus from raw documents: toxicity, quality rules, near copies, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; run() writes each result as Parquet and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import common, jaccard, packing, rules, toxicity
from tidemark.llm.queries import fertility_vocabularies, vocabulary


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"), folds=5, left_out=0)
    return toxicity.keep_clean(docs, model, 0.5)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands."""
    return rules.keep_good(docs, fertility_vocabularies())


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return jaccard.keep_one(docs, size=5, percent=75)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=2, size=1024)


STAGES = [
    ("toxicity", clean),
    ("quality rules", good),
    ("n-gram Jaccard join", single),
    ("best-fit packing", packed),
]

#: The classifier and the tokenisers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
