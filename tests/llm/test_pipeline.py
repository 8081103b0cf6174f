import hashlib
import re
from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline
from larkspur.llm import bpe, language, simhash
from larkspur.llm.common import saved, table
from tests.conftest import SF001
from tests.llm.conftest import edge_rows
from tests.llm.test_contamination import ITEMS
from tests.llm.test_contamination import brute as contaminated
from tests.llm.test_simhash import slow_components, slow_fingerprint


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "decontaminate", "tokenize"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF001, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], SF001), f"test-{name}"))
    return out


def without_passages(rows):
    """Texts without the repeated strings of PASSAGE_BYTES that, where they
    overlap joined, hold PASSAGE_WORDS whole words."""
    size, seen = corpus_pipeline.PASSAGE_BYTES, Counter()
    for _, text in rows:
        raw = text.encode()
        seen.update(raw[p : p + size] for p in range(len(raw) - size + 1))
    out = []
    for doc, text in rows:
        raw = text.encode()
        hit = [False] * len(raw)
        for p in range(len(raw) - size + 1):
            if seen[raw[p : p + size]] > 1:
                hit[p : p + size] = [True] * size
        gone, p = set(), 0
        while p < len(raw):
            q = p
            while q < len(raw) and hit[q] == hit[p]:
                q += 1
            if hit[p] and sum(p <= m.start() and m.end() <= q for m in re.finditer(rb"\S+", raw)) >= corpus_pipeline.PASSAGE_WORDS:
                gone |= set(range(p, q))
            p = q
        left, at = [], 0
        for c in text:  # a character goes if all its bytes go
            n = len(c.encode())
            left += [] if gone.issuperset(range(at, at + n)) else [c]
            at += n
        out.append((doc, "".join(left)))
    return out


def texts(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_each_stage_against_brute_force(spark, stages):
    start, known, groups, cut, clean, ids = stages
    for df in stages[1:5]:
        assert df.columns == start.columns and [t for _, t in df.dtypes] == [t for _, t in start.dtypes]
    judged = {r["doc_id"] for r in language.identified(start, language.train(start)).where("not rejected").collect()}
    assert texts(known) == [x for x in texts(start) if x[0] in judged]
    rows = texts(known)
    least = slow_components([r[0] for r in rows], [slow_fingerprint(r[1]) for r in rows], simhash.MAX_BITS)
    assert texts(groups) == [r for r, c in zip(rows, least, strict=True) if r[0] == c]
    assert texts(cut) == without_passages(texts(groups))
    items = [(r["item_id"], r["text"]) for r in table(spark, SF001, "benchmark").collect()]
    hit = {r[0] for r in contaminated(texts(cut), items) if r[5]}
    assert texts(clean) == [x for x in texts(cut) if x[0] not in hit]
    assert {r["doc_id"]: r["decoded_sha256"] for r in ids.collect()} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in texts(clean)}
    assert sorted(r["n_chars"] for r in cut.collect()) == sorted(len(t) for _, t in texts(cut))


def test_run_is_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF001).collect())) == sorted(map(tuple, stages[-1].collect()))


def test_stages_on_edges(spark, edge_docs, no_docs, tmp_path):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = saved(stage(spark, docs, str(tmp_path)), "test-edges")
            assert docs.columns == edge_docs.columns
        assert bpe.round_trip(docs).count() == docs.count()
    assert len(edge_rows()) == edge_docs.count()


def test_every_query_is_registered():
    found = __spark_entry__.queries()
    assert [n for n in range(1, 14) if any(q.startswith(f"op{n}_") for q in found)] == list(range(1, 14))
    assert "pipeline" in found and set(__spark_entry__.oracle_sql()) <= set(found)
