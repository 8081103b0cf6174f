import base64
import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.llm import bpe, language, pieces
from tests.llm.conftest import edge_rows

PATH = public_tokenizers.path(bpe.RANKS)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXT = st.lists(st.sampled_from(["'s", "'ll", "'re", "'", " ", "  ", "\n", "\t", "é", "a", "S", "the", "12", "½", "!", "漢", "😀", "　", "\xa0", "x́"]), max_size=25).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_pieces_follow_the_pattern(texts):
    data, at, upto = pieces.cut(texts)
    cut = [data[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:], strict=True)]
    pattern = regex.compile(public_tokenizers.PATTERN)
    assert [cut[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)] == [pattern.findall(t) for t in texts]


def test_ids_equal_the_library(reference):
    rnd = random.Random(1)
    texts = [r[1] or "" for r in edge_rows()] + ["".join(rnd.choice("abcdeth ing'é1.\n") for _ in range(rnd.randrange(80))) for _ in range(400)] + ["<|endoftext|>"]
    ids, start, raw, ends = bpe.encode_batch(PATH, [t.encode() for t in texts])
    for k, t in enumerate(texts):
        assert ids[start[k] : start[k + 1]].tolist() == reference.encode_ordinary(t)
        assert raw[ends[k] : ends[k + 1]].tobytes() == t.encode()


def test_matrix_and_heap_merge_alike(reference):
    rnd = random.Random(2)
    tool = bpe.load(PATH)
    for n in (5, 60, 700):
        piece = "".join(rnd.choice("theingaoub") for _ in range(n)).encode()
        want = reference.encode_ordinary(piece.decode())
        assert tool.encode_long(piece).tolist() == tool._matrix([piece], n)[0].tolist() == want


def test_store_survives_equal_hashes_and_starts_anew(reference, monkeypatch):
    texts = [b"some words here", b"other words there", b"some more of them"]
    want = [reference.encode_ordinary(t.decode()) for t in texts]
    tool = pieces.Store(bpe.load(PATH).encode_pieces, kept=2)
    for t, w in zip(texts, want, strict=True):
        data, at, _ = pieces.cut([t.decode()])
        assert tool.ids(data, at)[0].tolist() == w
    monkeypatch.setattr(pieces, "hashes", lambda data, at: np.full(len(at) - 1, np.uint64(7)))
    bpe.store.cache_clear()
    ids, start, _, _ = bpe.encode_batch(PATH, texts)
    bpe.store.cache_clear()
    assert [ids[a:b].tolist() for a, b in zip(start[:-1], start[1:], strict=True)] == want


def test_round_trip_and_edges(edge_docs, no_docs, reference):
    got = sorted(map(tuple, bpe.round_trip(edge_docs).collect()), key=str)
    want = []
    for doc, text, *_ in edge_rows():
        ids = reference.encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(no_docs).count() == 0


def test_encoded_then_decoded(edge_docs):
    texts = sorted((r[0] or 0, (r[1] or "").encode()) for r in edge_rows())
    back = bpe.decoded(bpe.encoded(edge_docs)).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["bytes"])) for r in back) == texts


def peak_mb(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_memory_of_a_worker():
    assert peak_mb(pieces.classes.__wrapped__) < 8 and peak_mb(language.letters.__wrapped__) < 16  # not all code points at once
    pieces.classes(), bpe.load(PATH)
    rnd = random.Random(5)
    frame = pa.RecordBatch.from_pydict({"doc_id": range(200), "text": [" ".join("".join(rnd.choices("abcdefgh", k=7)) for _ in range(700)) for _ in range(200)]})
    tool = bpe.store(PATH)
    tool.clear()
    texts = [bpe.strings_of(data, at) for _, data, at in bpe.batches(frame, step=bpe.STEP)]
    assert sum(map(len, texts)) == 200
    assert peak_mb(lambda: [bpe.encode_batch(PATH, t) for t in texts[:2]]) < 30
    assert tool.near_key.nbytes + tool.near_slot.nbytes < 16 * 2**20
