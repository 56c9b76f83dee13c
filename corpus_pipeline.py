"""The corpus pipeline: quality rules, toxicity, near-duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and calls one operator; its output is written as Parquet in the
shared folder and read again as the next stage's documents. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import bpe, mixing, quality, simhash, toxicity
from tillsight.llm.common import fold, free_name, stored, table
from tillsight.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, or whose host is rejected, go."""
    return quality.keep_good(docs)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go; learned on this stage's labelled documents."""
    machine = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), fold(F.col("id"), 5) != 0)
    score = free_name(docs, "score")
    return toxicity.score(docs, machine, name=score).where(F.col(f"`{score}`") < 0.5).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: four-word shingles, four bits."""
    return simhash.keep_one(docs, words=4, bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return bpe.digests(docs.select("doc_id", "text"), vocabulary()).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("quality rules", quality_rules), ("toxicity", remove_toxic), ("simhash near-dedup", near_dedup),
          ("mixing", mix_sources), ("bpe", encode)]

#: No SQL: toxicity, SimHash, the mix's selection and the encoding are not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
