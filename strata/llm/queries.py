"""Registered queries of the text operators; their SQL is in ``oracle.py``.

Each takes (spark, sf_dir), applies one operator with its production
parameters to its whole table and returns the columns the contract names.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, license_scan, mil_quality, mixing, ngram_join, quality_rules, simhash, sketch_search, substring, token_files, topk, vector_codes
from .common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digest(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"))


def op5_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.digest(table(spark, sf_dir, "embeddings"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.with_probe(spark, sf_dir))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op10_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mil_quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(table(spark, sf_dir, "embeddings"))


def op12_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_search.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_token_files": op2_token_files,
    "op3_quality_rules": op3_quality_rules,
    "op4_bpe": op4_bpe,
    "op5_maxscore_topk": op5_maxscore_topk,
    "op6_license_scan": op6_license_scan,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_ngram_join": op8_ngram_join,
    "op9_mixing": op9_mixing,
    "op10_mil_quality": op10_mil_quality,
    "op11_vector_codes": op11_vector_codes,
    "op12_sketch_search": op12_sketch_search,
    "op13_simhash": op13_simhash,
    "pipeline": pipeline,
}
