"""From raw documents to token ids: five stages, each written as Parquet and
read again before the next one.

Every stage takes (spark, docs, sf_dir) and works on all documents that the
one before it kept. The first four return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import bpe, contamination, language, simhash, suffix
from larkspur.llm.common import scratch, scratch_dropped, table
from larkspur.sources import storage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language no model of the labelled ones
    accepts; null texts and texts without letters among them."""
    return language.kept_documents(docs, language.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that of least
    doc_id (none comes last), then of least SHA-256 of the text. Texts that
    share a doc_id but are no near-duplicates stay; copies without a doc_id
    keep one."""
    return simhash.kept_documents(docs)


#: A passage repeats if more than 50 whole words of it do; the search is for
#: strings of bytes that such passages hold (51 words of three letters or more
#: are over 200 bytes).
PASSAGE_WORDS, PASSAGE_BYTES, PASSAGE_GRAM = 51, 200, 64


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the passages of over 50 words that repeat out of the texts. Every
    copy goes, the first too, as in the operator: text that documents share word
    for word is not theirs, and no copy is known to be the original. Shorter
    repeats stay as they are."""
    return suffix.deduplicated(docs, length_col="n_chars", length=PASSAGE_BYTES, gram=PASSAGE_GRAM, least_words=PASSAGE_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a window of the benchmark occurs."""
    return contamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the bytes that they
    decode to."""
    return bpe.round_trip(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]

#: Character models, fingerprints and suffix arrays are beyond SQL; a
#: brute-force version of the stages is in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        path = scratch(spark, name)
        with scratch_dropped(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            storage.delete(spark, before)
        before = path
    return docs
