"""The registered queries of this subpackage: each applies one operator, with production
parameters, to its whole table and derives the digest columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import (ann, bpe, conversation_repair, filter_audit, langid, license_scan, mixing, ngram_lm, quality,
                           simhash, token_counts, tool_calls, toxicity)
from tillsight.llm.common import fold, stored, table

#: Place of the byte-level BPE file; None means the installed public vocabulary.
VOCABULARY: str | None = None


def vocabulary() -> str:
    if VOCABULARY:
        return VOCABULARY
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_ann_vp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(rows, F.col("id") % 100 == 0)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", (fold(F.col("doc_id"), 10) == 0).alias("held_out"))
    model = ngram_lm.train(docs, ~F.col("held_out"))
    return ngram_lm.score(docs, model).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.select("doc_id", "text", "lang"), fold(F.col("doc_id"), 3) != 1)
    fed = docs.select("doc_id", "text", (fold(F.col("doc_id"), 3) == 1).alias("held_out"))
    return langid.predict(fed, model).select("doc_id", "held_out", "lang_pred", "score")


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return tool_calls.link(tool_calls.derived(rows), tool_calls.DERIVED)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), fold(F.col("id"), 5) != 0)
    fed = docs.withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    return toxicity.score(fed, machine).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = stored(simhash.with_fingerprint(docs, "fp").select("doc_id", "fp"), "simhash")
    return simhash.label(marked, "fp", "component_id").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, vocabulary()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality.judge(docs, carry=["doc_id"])


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary()).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair(conversation_repair.damaged(rows), rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_ann_vp_tree, op2_mix_sources, op3_lm_score, op4_language_id, op5_tool_calls, op6_toxicity,
    op7_license_scan, op8_simhash, op9_bpe, op10_quality_rules, op11_token_counts, op12_filter_audit,
    op13_conversation_repair)}

#: DuckDB SQL of the queries that SQL can express.
ORACLE: dict[str, str] = {"op5_tool_calls": tool_calls.ORACLE, "op10_quality_rules": quality.ORACLE,
                          "op12_filter_audit": filter_audit.ORACLE}
