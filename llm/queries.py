"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from llm import bpe, language, licenses, lines, merkle, minhash, mixing, passages, periodic, pseudo_likelihood, repetition, vectors, warc
from llm.oracle import ORACLE
from llm.tables import small_batches, table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return table(spark, sf_dir, "documents")


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.digests(documents(spark, sf_dir))


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op3_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.score_corpus(documents(spark, sf_dir))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.held_out_languages(documents(spark, sf_dir))


def op7_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(documents(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle=4, part=80, whole=100)


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(documents(spark, sf_dir))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digests(table(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return warc.digests(table(spark, sf_dir, "pages"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(documents(spark, sf_dir))


QUERIES = {
    "op1_passages": op1_passages,
    "op2_vectors": op2_vectors,
    "op3_pseudo_likelihood": op3_pseudo_likelihood,
    "op4_bpe": op4_bpe,
    "op5_licenses": op5_licenses,
    "op6_language": op6_language,
    "op7_repetition": op7_repetition,
    "op8_mixing": op8_mixing,
    "op9_minhash": op9_minhash,
    "op10_lines": op10_lines,
    "op11_merkle": op11_merkle,
    "op12_warc": op12_warc,
    "op13_periodic": op13_periodic,
}

__all__ = ["ORACLE", "QUERIES"]
