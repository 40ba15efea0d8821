"""Queries of the training-text problems; where SQL can state a problem, its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colophon.llm import garbled, lookalike, lost, mixing, names, ocr, spans, tokens
from colophon.session import table


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, sf_dir, "documents"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    uses, _ = mixing.mix(mixing.sized_documents(table(spark, sf_dir, "documents")), table(spark, sf_dir, "mix_target"))
    return uses


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(*mixing.mix(mixing.sized_documents(table(spark, sf_dir, "documents")), table(spark, sf_dir, "mix_target")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled.garbled_values(table(spark, sf_dir, "lemma"))


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lost.filled_values(garbled.restored_values(table(spark, sf_dir, "lemma")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.disguised_values(table(spark, sf_dir, "lemma"))


def p3_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.unified_values(table(spark, sf_dir, "lemma"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr.scan_noise(table(spark, sf_dir, "lemma"))


def p5_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr.clean_paragraphs(table(spark, sf_dir, "lemma"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.linked_pairs(table(spark, sf_dir, "lemma"))


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.linked_groups(table(spark, sf_dir, "lemma"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_spans(table(spark, sf_dir, "documents"))


def p9_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spans.shared_amount(docs, spans.shared_spans(docs))


QUERIES = {
    "p2_found": p2_found, "p2_restored": p2_restored, "p3_found": p3_found, "p3_unified": p3_unified, "p5_found": p5_found, "p5_paragraphs": p5_paragraphs, "p6_found": p6_found, "p6_groups": p6_groups,
    "p7_ids": p7_ids, "p8_mix": p8_mix, "p8_shares": p8_shares, "p9_found": p9_found, "p9_amount": p9_amount,
}

SQL: dict[str, str] = {}
