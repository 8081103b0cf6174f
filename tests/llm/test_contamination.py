import hashlib
import random
import re

import pytest

from larkspur.llm import contamination
from tests.llm.conftest import edge_rows, syllables

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    patterns = {}
    for item, text in items:
        w = words(text)
        for k in range(max(len(w) - window, 0) + 1) if w else ():
            patterns.setdefault(tuple(w[k : k + window]), set()).add(item)
    out = []
    for doc, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(p) for p in patterns}:
            for k in range(len(w) - size + 1):
                if (p := tuple(w[k : k + size])) in patterns:
                    hit |= set(range(k, k + size))
                    found |= patterns[p]
        sha = hashlib.sha256(",".join(sorted(str(i) for i in found if i is not None)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, syllables(2, 25)), (2, "ba KE, li"), (3, syllables(8, 14)), (4, None), (5, "..."), (6, syllables(8, 14)), (None, "ba"), (None, syllables(8, 14) + " more"), (None, syllables(1, 11)), (10, "é"), (11, "Li mo nu pa re si to vu da fe gi"), (12, syllables(6, 12))]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_against_brute_force(spark, edge_docs, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = contamination.decontamination(edge_docs, items, block_bytes=block_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == brute(edge_rows(), ITEMS)


def test_random_texts(spark):
    rnd = random.Random(4)
    items = [(k, " ".join(rnd.choice("a b c d ee").strip() or "f" for _ in range(rnd.randrange(1, 14)))) for k in range(30)]
    docs = [(k, "".join(rnd.choice(["a", "b", " ", ", ", "c", "d", "ee", "\n"]) for _ in range(rnd.randrange(0, 300)))) for k in range(60)]
    got = contamination.decontamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=4)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 4)


def test_empty_tables(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination.decontamination(no_docs, none).count() == 0
    assert contamination.decontamination(edge_docs, none).where("contaminated").count() == 0
    assert contamination.clean_documents(edge_docs, none).count() == edge_docs.count()


def test_clean_documents_keeps_the_others_as_they_are(spark, edge_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = contamination.clean_documents(edge_docs, items)
    hit = {r[0] for r in brute(edge_rows(), ITEMS) if r[5]}
    assert got.columns == edge_docs.columns
    assert {r["doc_id"] for r in got.collect() if r["doc_id"]} == {r[0] for r in edge_rows() if r[0] and r[0] not in hit}
