"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from larkspur.llm import bpe, contamination, embeddings, html_text, language, licenses, neighbours, quality, simhash, suffix, tokens, trie, whitening
from larkspur.llm.common import table
from larkspur.llm.oracle import ORACLES


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.removed(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns where the remainder is not 1; scores every row."""
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    model = quality.train(docs, table(spark, sf_dir, "labels"), learn=remainder != 1)
    found = quality.scored(docs, model)
    return found.select("doc_id", (remainder == 1).alias("held_out"), "score", "predicted")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns where the remainder is not 0; predicts every row."""
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    models = language.train(docs, learn=remainder != 0)
    found = language.identified(docs, models)
    return found.select("doc_id", (remainder == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.written(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), share=True).drop("t1", "t2")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.component_rows(table(spark, sf_dir, "embeddings"))


QUERIES = [op1_suffix_array, op2_licenses, op3_quality, op4_language, op5_embeddings, op6_byte_bpe, op7_token_files, op8_decontamination, op9_html_text, op10_simhash, op11_neighbours, op12_prefix_trie, op13_whitening]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLES)
    if corpus_pipeline.ORACLE_SQL is not None:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
