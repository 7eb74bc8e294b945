"""From raw documents to packed sequences: bad and toxic documents go, copies and near copies go, the rest is packed.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns the columns of docs; the last
returns the places of the pieces in their sequences. run() stores what a stage returns in the shared folder and reads it
again, so a lost executor or a failed stage costs no earlier one.

Defined results: null text counts as empty, is scored like any other, and is a copy of other empty texts; a text without
words is near nothing; a null id is packed like any other and stays in near dedup; rows that repeat an id are told apart by
their text; without labels of both kinds a classifier rejects nothing; other columns, whatever their names, are kept up to
the last stage; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from watchsieve.llm import exact_dedup, jaccard_join, packing, quality, toxicity
from watchsieve.llm.common import documents, fold, labels, stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept(docs, quality.fitted(docs, labels(spark, sf_dir), fold("doc_id", 5) != 0))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.kept(docs, toxicity.fitted(docs, labels(spark, sf_dir), fold("doc_id", 3) != 1))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicate stages take five words and a similarity of 0.8."""
    return jaccard_join.representatives(docs, n=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [("quality classifier", good_quality), ("toxicity", not_toxic), ("exact dedup", without_copies), ("n-gram Jaccard join", without_near_copies), ("best-fit packing", packed)]

#: The classifiers are trained and the texts encoded, which SQL cannot express; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage{k}")
    return docs
