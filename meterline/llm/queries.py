"""Registered queries of the operators, one each, over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import embed_dedup, hard_negatives, html_extract, lm, merkle, minhash, mixing, packing, pii, quality_gbt, quality_rules, sentencepieces, toxicity
from meterline.llm.common import table
from meterline.llm.oracles import ORACLES


def op1_embedding_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, folder, "embeddings"))


def op2_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_documents(table(spark, folder, "documents"))


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.apply_policy(quality_rules.ledger(table(spark, folder, "documents")))
    base = (rows.failed.bitwiseAND(quality_rules.BASE) != 0).alias("base_failed")
    measures = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", "n_words", *measures, base, "kept", "failed")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.main_text(table(spark, folder, "pages"))


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), width=3, percent=85)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_table(table(spark, folder, "documents"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_gbt.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.relabelled(table(spark, folder, "embeddings")))


def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepieces.digests(sentencepieces.encode(table(spark, folder, "documents")))


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verify(merkle.manifest(table(spark, folder, "documents"), merkle.tampered_text()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_duplicates": op1_embedding_duplicates,
    "op2_language_model": op2_language_model,
    "op3_personal_data": op3_personal_data,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_main_text": op6_main_text,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_mixing": op8_mixing,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_manifest": op13_manifest,
}

__all__ = ["ORACLES", "QUERIES"]
