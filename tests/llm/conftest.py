import random

import pytest

CLASHING = ["row", "anchor", "bucket", "key", "fp", "id", "label", "score", "known", "compare", "n_words", "low", "words", "component_id", "hits"]


def syllables(seed: int, words: int, parts: str = "ba ke li mo nu pa re si to vu da fe gi ho ju") -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(parts.split()) for _ in range(rnd.randrange(1, 4))) for _ in range(words))


def edge_rows() -> list[tuple]:
    long = syllables(1, 30_000)
    passage = syllables(2, 120)
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "A", "en"), (5, "déjà vu 漢字 😀 x\x00y", "fr"),
        (6, long, "en"), (7, long, "en"), (8, syllables(3, 40), "en"), (8, syllables(3, 40), "en"),
        (9, syllables(4, 30) + " " + passage + " " + syllables(5, 30), "de"), (10, passage, "de"), (11, "é" * 700, None),
        (None, syllables(6, 50), "en"), (None, None, None), (12, "!!! ... ---", "en"), (13, "ab" * 3000, "fr"),
        (14, syllables(7, 60) + ". Licensed under the Apache License, Version 2.0.", "en"), (15, syllables(8, 200), "de"),
        (16, "q" * 20_000, "en"), (17, syllables(8, 198) + " other end", "de"),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Rows with nulls, empty and very long texts, repeated rows, and columns
    whose names an operator might use inside."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string").repartition(5)
    return docs.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit(c) for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
