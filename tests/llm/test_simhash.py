import random

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from larkspur.llm import simhash
from larkspur.llm.graph import components
from tests.llm.conftest import edge_rows, syllables


def slow_fingerprint(text, size=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in regex.split(r"[\x20\x09-\x0D]+", low) if w]
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps, bits):
    least = list(ids)
    while True:
        new = [min(least[j] for j in range(len(ids)) if (fps[k] ^ fps[j]).bit_count() <= bits) for k in range(len(ids))]
        if new == least:
            return least
        least = new


def test_edges_against_brute_force(edge_docs):
    rows = [r for r in edge_rows() if r[0] is not None]
    got = sorted(map(tuple, simhash.near_duplicates(edge_docs.where("doc_id is not null")).collect()))
    fps = [slow_fingerprint(r[1]) for r in rows]
    want = slow_components([r[0] for r in rows], fps, 4)
    assert got == sorted((r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, want, strict=True))


def test_null_ids_take_the_class_of_equal_texts(edge_docs, no_docs):
    got = simhash.near_duplicates(edge_docs)
    assert got.count() == len(edge_rows())
    assert [r["component_id"] for r in got.where(f"doc_id is null and fingerprint = '{0:016x}'").collect()] == [1]
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 7])
def test_links_connect_what_brute_force_connects(spark, bits, monkeypatch):
    rng = random.Random(bits)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            fps.add(base)
            for b in rng.sample(range(64), rng.randrange(0, 5)):
                base ^= 1 << b
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(f, k) for k, f in enumerate(signed)], "fp long, id long").repartition(4)
    want = slow_components(list(range(len(fps))), fps, bits)
    for bucket in (20_000, 3):
        if not bits:
            continue
        got = {r["node"]: r["component"] for r in components(simhash.links(classes, bits, bucket)).collect()}
        assert [got.get(k, k) for k in range(len(fps))] == want


def test_dense_bucket_is_left_at_once():
    ring = simhash._bucket_links(4)
    import pyarrow as pa

    base = random.Random(1).getrandbits(64)
    fps = np.array(sorted({base ^ (1 << a) ^ (1 << b) for a in range(30, 64) for b in range(30, a)}), np.uint64).view(np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([fps.tolist()], pa.list_(pa.int64())), pa.array([list(range(len(fps)))], pa.list_(pa.int64()))], names=["key", "fps", "ids"])
    (out,) = ring(iter([batch]))
    assert out.num_rows == len(fps) - 1


def test_components_of_chains_stars_and_doubles(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(1000, 1500)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain + star + star + [(5, 5), (1200, 159)], "a long, b long").repartition(7)).collect()}
    assert set(got.values()) == {7} and len(got) == 60 + 500 + 1
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_are_found(spark):
    base = syllables(50, 400).split()
    rows = [(k, " ".join(base[:j] + ["CHANGED"] + base[j + 1 :])) for k, j in enumerate(range(10, 390, 40))] + [(99, syllables(51, 400))]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("n", F.col("component_id"))
    near = {r["doc_id"]: r["component_id"] for r in got.collect()}
    assert near[99] == 99 and sum(near[k] == 0 for k in range(10)) >= 5
