import numpy as np
from pyspark.sql import functions as F

from larkspur.llm import quality
from larkspur.llm.common import table
from tests.conftest import SF01
from tests.llm.conftest import edge_rows


def test_statistics_against_plain_counts():
    texts = ["Aa b b, 12!\nx | y\nx | y", "", "   ", "one", "w " * 250, "\n\n", "é É ê"]
    raw = [t.encode() for t in texts]
    got = quality.statistics(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for t, r, row in zip(texts, raw, got, strict=True):
        words = r.split()
        x = dict(zip(quality.FEATURES, row.tolist(), strict=True))
        n = max(len(words), 1)
        assert x["n_words"] == len(words)
        assert x["repeat_share"] == sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
        assert x["distinct_share"] == sum(len(set(words[k : k + 100])) for k in range(0, len(words), 100)) / n
        assert x["bar_share"] == t.count("|") / max(len(r), 1)
        assert x["capital_share"] == sum("A" <= c <= "Z" for c in t) / max(len(r), 1)
        assert np.isfinite(row).all()


def test_lasso_keeps_few_rules_and_the_column_follows_them(spark):
    rng = np.random.default_rng(1)
    x = rng.random((1500, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.6) & (x[:, 5] <= 0.5)).astype(float)
    model = quality.fit(x, y, trees=15)
    assert 0 < len(model.rules) < 120
    total = np.full(len(x), model.intercept)
    for tests, weight in model.rules:
        total += weight * quality._holds(x, tests)
    want = 1 / (1 + np.exp(-total))
    assert ((want >= 0.5) == y).mean() > 0.97
    rows = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(x[:200])], "k long, " + ", ".join(f"{f} double" for f in quality.FEATURES))
    got = [r[0] for r in rows.orderBy("k").select(model.column()).collect()]
    assert np.allclose(got, want[:200])


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    learn = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    found = quality.scored(docs, quality.train(docs, labels, learn=learn)).join(labels, "doc_id").where(~learn)
    n, right, lost = found.select(F.count("*"), F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.sum(((F.col("predicted") == 0) & (F.col("quality") == 1)).cast("int"))).first()
    assert n > 100 and right >= 0.97 * n and lost <= 0.01 * n


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(6, 1), (7, 0), (7, 1), (None, 1), (15, None), (99, 0), (5, 1), (16, 0)], "doc_id long, quality int")
    model = quality.train(edge_docs, labels)
    got = quality.scored(edge_docs, model)
    assert got.count() == len(edge_rows()) and got.where("score is null or score < 0 or score > 1").count() == 0
    none = quality.train(no_docs, labels)
    assert none == quality.Ensemble((), 0.0) == quality.train(edge_docs, labels.where("false"))
    assert {r["score"] for r in quality.scored(edge_docs, none).collect()} == {0.5}
    assert quality.scored(no_docs, model).count() == 0
