import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from larkspur.llm import suffix
from tests.llm.conftest import edge_rows


def brute(rows, length):
    """Per row: bytes, removed bytes, spans, digest of what is left."""
    seen = Counter()
    for _, text, *_ in rows:
        raw = (text or "").encode()
        seen.update(raw[p : p + length] for p in range(len(raw) - length + 1))
    out = []
    for doc, text, *_ in rows:
        raw, spans = (text or "").encode(), []
        for p in range(len(raw) - length + 1):
            if seen[raw[p : p + length]] > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
        kept = b"".join(raw[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(raw)], strict=True))
        out.append((doc, len(raw), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def small(rows):
    return [r for r in rows if r[1] is None or len(r[1]) < 30_000]


def test_suffix_array_and_common_prefixes():
    rnd = random.Random(3)
    for _ in range(40):
        n, letters = rnd.randrange(1, 300), rnd.choice([1, 2, 4])
        data = np.array([rnd.randrange(letters) for _ in range(n)], np.uint8)
        order, rank = suffix.suffix_array(data.astype(np.int64) + 1)
        raw = data.tobytes()
        assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])
        assert (rank[order] == np.arange(n)).all()
        common = suffix.common_prefixes(data, np.full(n, n), order, rank, 50, lane=rnd.choice([1, 7, 256]))
        for k in range(1, n):
            i, j, same = order[k], order[k - 1], 0
            while same < 50 and max(i, j) + same < n and raw[i + same] == raw[j + same]:
                same += 1
            assert common[i] == same


def test_sliding_min_and_stretch_hashes():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 100, 500).astype(np.uint64)
    for w in (1, 2, 7, 499, 500):
        assert suffix.sliding_min(x, w).tolist() == [x[k : k + w].min() for k in range(len(x) - w + 1)]
    data = np.frombuffer(b"abcabcxabc", np.uint8)
    h = suffix.Sums(data, suffix.BASES[0]).all(3)
    assert h[0] == h[3] == h[7] and h[0] != h[1]


def test_merge_runs_marks_keys_of_two_runs():
    rng = np.random.default_rng(2)
    runs, hit, base = [], np.zeros(500, bool), 0
    for _ in range(5):
        key = np.unique(rng.integers(0, 300, 100)).astype(np.uint64)
        runs.append((key, key * np.uint64(7), np.arange(base, base + len(key))))
        base += len(key)
    owners = Counter(int(k) for r in runs for k in r[0])
    want = {int(n) for r in runs for k, n in zip(r[0], r[2], strict=True) if owners[int(k)] > 1}
    suffix.merge_runs(runs, hit)
    assert set(np.flatnonzero(hit).tolist()) == want


@pytest.mark.parametrize("length,gram,shard_bytes,merged_keys", [(40, 10, 1 << 20, 10**6), (60, 60, 1 << 20, 10**6), (40, 10, 300, 50)])
def test_against_brute_force_on_random_texts(spark, monkeypatch, length, gram, shard_bytes, merged_keys):
    """With tiny shards most anchors are hot: their keys meet across shards."""
    monkeypatch.setattr(suffix, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(suffix, "MERGED_KEYS", merged_keys)
    parts = suffix.PART_BYTES if merged_keys > 50 else 700
    monkeypatch.setattr(suffix, "PART_BYTES", parts)
    rnd = random.Random(length)
    base = "".join(rnd.choice("abcdé ") for _ in range(900))
    rows = [(k, "".join(rnd.choice(["", base[a : a + rnd.randrange(1, 200)], "xy" * rnd.randrange(60), chr(97 + k % 26)]) for a in (rnd.randrange(800) for _ in range(6)))) for k in range(40)]
    rows += [(None, rows[3][1]), ((1 << 62) + 1, rows[5][1][:150] + "#" + rows[6][1]), ((1 << 62) + 2, rows[5][1][:150] + "!")]
    got = suffix.removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), length=length, gram=gram)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, length)


def test_edges(spark, edge_docs):
    got = sorted(map(tuple, suffix.removed(edge_docs.where("doc_id is null or doc_id not in (6, 7)")).collect()), key=str)
    assert got == brute(small(edge_rows()), suffix.LENGTH)


def test_long_copies_are_removed_whole(edge_docs):
    got = {r["doc_id"]: r for r in suffix.removed(edge_docs.where("doc_id in (6, 7, 15)")).collect()}
    assert got[6]["n_removed"] == got[6]["n_bytes"] > 100_000 and got[6]["n_spans"] == 1 and got[15]["n_removed"] == 0


def test_long_filler_runs_keep_shards_bounded(spark):
    """Distinct contexts of one anchor, each far longer than a shard's part."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh ") for _ in range(500))
    rows = [(k, word() + "-" * 200_000 + word()) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found, _ = suffix.repeats(docs)
    held = Counter()
    for r in found.select("compare").collect():
        for start, end, shard, _ in zip(*[iter(r["compare"] or [])] * 4, strict=True):
            held[shard] += end - start
    assert sum(held.values()) > 1_500_000 and max(held.values()) <= 1.5 * suffix.SHARD_BYTES
    got = {r["doc_id"]: r["n_removed"] for r in suffix.removed(docs).collect()}
    # letters beside the runs may repeat with them
    assert len(got) == 40 and all(200_000 <= n <= 200_010 for n in got.values())


def test_whole_words():
    raw = np.frombuffer(b"ab cd  ef\ngh", np.uint8)
    assert [suffix.whole_words(raw, a, b) for a, b in ((0, 12), (1, 12), (0, 11), (1, 2), (2, 6), (3, 5), (2, 8))] == [4, 3, 3, 0, 1, 1, 1]


def test_only_passages_of_enough_words(spark):
    rnd = random.Random(10)
    words = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    short, long = words(45), words(51)
    texts = [f"{words(30)} {p} {words(30)}" for p in (short, long, short, long)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["text"] for r in suffix.deduplicated(docs, length=200, gram=64, least_words=51).orderBy("doc_id").collect()]
    assert got[0] == texts[0] and got[2] == texts[2]
    assert all(long not in t and len(t.split()) == 60 for t in (got[1], got[3]))


def test_empty_table(no_docs):
    assert suffix.removed(no_docs).count() == 0
    assert suffix.deduplicated(no_docs).columns == no_docs.columns


def test_deduplicated_keeps_columns_and_whole_characters(spark, edge_docs):
    got = suffix.deduplicated(edge_docs, length_col="n_chars")
    assert got.columns == edge_docs.columns and got.count() == edge_docs.count()
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[1]["text"] is None and rows[1]["n_chars"] is None
    assert rows[6]["text"] == "" and rows[6]["n_chars"] == 0
    assert rows[15]["source"] == "s" and rows[15]["row"] == "row"
    shared = "x" * 3 + "".join(chr(0x430 + k * 7 % 30) for k in range(300))
    pair = spark.createDataFrame([(1, "Ж" + shared + "a"), (2, "П" + shared + "b")], "doc_id long, text string")
    assert sorted(r["text"] for r in suffix.deduplicated(pair).collect()) == ["Жa", "Пb"]
