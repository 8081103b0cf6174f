import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from larkspur.llm import tokens
from tests.llm.conftest import edge_rows, syllables


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    t.encode_special_tokens = True
    return t


def test_files_hold_the_ids(spark, library, monkeypatch):
    monkeypatch.setattr(tokens, "DICTIONARY_BYTES", 2048)
    rows = [r[:2] for r in edge_rows() if r[0] is not None and r[0] != 8] + [(100 + k, syllables(k, 300)) for k in range(150)] + [(90, "<|endoftext|> it's")]
    folder = tokens.scratch(spark, "test-tokens")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    tokens.write(docs, folder, ranges=4)
    got = sorted(map(tuple, tokens.summary(spark, folder).collect()))
    start, want = 0, []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, tokens.END_ID]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    one = tokens.read(spark, folder, 107).collect()
    assert [(r["doc_id"], r["start"]) for r in one] == [(107, dict((w[0], w[1]) for w in want)[107])]
    assert library.decode(one[0]["ids"][:-1]) == syllables(7, 300)
    assert tokens.read(spark, folder, 99_999).count() == 0
    data = spark.read.parquet(f"{folder}/data")
    assert data.where("first_doc > last_doc").count() == 0
    assert data.select("dictionary_sha256").distinct().count() == 1
    assert len(spark.read.parquet(f"{folder}/meta").first()["dictionary"]) > 0


def test_another_dictionary_is_refused(spark, edge_docs):
    folder = tokens.scratch(spark, "test-tokens")
    tokens.write(edge_docs, folder, ranges=2)
    wrong = spark.createDataFrame([(bytearray(b"x"), "0", 2)], "dictionary binary, dictionary_sha256 string, width int")
    wrong.write.mode("overwrite").parquet(f"{folder}/meta")
    with pytest.raises(ValueError, match="dictionary"):
        tokens.summary(spark, folder)


def test_null_and_repeated_ids(edge_docs):
    got = tokens.written(edge_docs).collect()
    assert len(got) == len(edge_rows())
    assert sorted(r["start"] for r in got if r["doc_id"] is None)[0] == 0
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert [a for a, _ in ends] == [0, *[b for _, b in ends][:-1]]
    assert next(r for r in got if r["doc_id"] == 2)["n_tokens"] == 1


def test_empty_table(no_docs):
    assert tokens.written(no_docs).count() == 0
