import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from larkspur.llm import language
from larkspur.llm.common import table
from tests.conftest import SF01
from tests.llm.conftest import CLASHING, edge_rows, syllables


def test_letters_of_keeps_words_and_single_spaces():
    point, place, doc = language.letters_of([b"  Ab,  c!", b"", b"\xc3\x89t", b"1 2", b"x"])
    seen = ["".join(map(chr, point[place[doc == k]])) for k in range(5)]
    assert seen == ["ab c", "", "ét", "", "x"]
    rows = language.windows(point)[place]
    first = rows[0]
    assert first.tolist() == [0, 0, 0, 32, ord("a")]


def slow_kneser_ney(texts, order=language.ORDER):
    """Counts as dictionaries, and the probability of a character."""
    padded = ["\0" * (order - 2) + " " + t for t in texts]
    counts = {order: Counter(p[k - order + 1 : k + 1] for p in padded for k in range(order - 1, len(p)))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discount = {n: min(0.95, max(0.1, (a := sum(v == 1 for v in c.values())) / max(a + 2 * sum(v == 2 for v in c.values()), 1))) for n, c in counts.items()}

    def p(context, char, n):
        if n == 0:
            return 1 / (len(counts[1]) + 1)
        lower = p(context[1:], char, n - 1)
        followers = [v for g, v in counts[n].items() if g[:-1] == context]
        if not followers:
            return lower
        total, c = sum(followers), counts[n].get(context + char, 0)
        return max(c - discount[n], 0) / total + discount[n] * len(followers) / total * lower

    return lambda g: p(g[:-1], g[-1], order)


def test_model_is_interpolated_kneser_ney():
    texts = ["banana band", "an abandoned barn", "nab a banana"]
    point, place, _ = language.letters_of([t.encode() for t in texts])
    rows, n = np.unique(language.windows(point)[place], axis=0, return_counts=True)
    model = language.fit(rows, n)
    slow = slow_kneser_ney(texts)
    for text in ["banana", "abba", "zebra an", "nd"]:
        point, place, _ = language.letters_of([text.encode()])
        windows = language.windows(point)[place]
        want = [-math.log(slow("".join(map(chr, w)))) for w in windows.tolist()]
        assert np.allclose(model.cost(windows), want)
    assert all((np.diff(k.astype(float)) >= 0).all() for k in model.gram_keys)


def test_held_out_accuracy(spark):
    docs = table(spark, SF01, "documents")
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    found = language.identified(docs, language.train(docs, learn=learn)).join(docs.where(~learn), "doc_id")
    n, right, rejected = found.select(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.sum(F.col("rejected").cast("int"))).first()
    assert n > 150 and right >= 0.98 * n and rejected <= 0.01 * n


def test_foreign_text_is_rejected(spark):
    docs = table(spark, SF01, "documents")
    models = language.train(docs)
    foreign = spark.createDataFrame([(1, syllables(1, 400, "zk ujp qyx vvo wzu")), (2, "漢字仮名交じり文" * 50), (3, "щшчж ъыь эюя " * 60)], "doc_id long, text string")
    assert language.identified(foreign, models).where("rejected").count() == 3


def test_languages_with_few_rows_reject_too(spark):
    docs = table(spark, SF01, "documents").where("n_chars between 300 and 3000")
    rows = [r for lang in ("de", "en", "fr", "es") for r in docs.where(F.col("lang") == lang).orderBy("doc_id").limit(15).collect()]
    models = language.train(spark.createDataFrame(rows, docs.schema).repartition(3))
    assert set(models.names) == {"de", "en", "fr", "es"}
    assert all(0.02 <= m.spread < 1 and 1 < m.mean < 6 for m in models.models)
    foreign = [(1, syllables(1, 400, "zk ujp qyx vvo wzu")), (2, "漢字仮名交じり文" * 50), (3, "щшчж ъыь эюя " * 60), (4, syllables(2, 400, "xq wk jz vf qh"))]
    assert language.identified(spark.createDataFrame(foreign, "doc_id long, text string"), models).where("rejected").count() == 4
    own = language.identified(docs, models)
    n, kept = own.select(F.count("*"), F.sum((~F.col("rejected")).cast("int"))).first()
    assert kept >= 0.95 * n
    one = language.train(spark.createDataFrame(rows[:1], docs.schema))
    assert language.identified(spark.createDataFrame(foreign, "doc_id long, text string"), one).where("rejected").count() == 4
    assert language.identified(spark.createDataFrame(rows[:1], docs.schema), one).where("rejected").count() == 0


def test_edges(spark, edge_docs, no_docs):
    models = language.train(edge_docs)
    assert models.names == ["de", "en", "fr"]
    got = language.identified(edge_docs, models)
    assert got.count() == len(edge_rows())
    und = {r["doc_id"] for r in got.where("lang_pred = 'und'").collect()}
    assert und == {None, 1, 2, 3, 12}
    assert got.where("score < 0 or score > 1 or isnan(score)").count() == 0
    assert language.train(no_docs).names == []
    none = language.identified(edge_docs, language.train(no_docs))
    assert none.where("lang_pred != 'und' or not rejected").count() == 0
    kept = language.kept_documents(edge_docs, models)
    assert kept.columns == edge_docs.columns and set(CLASHING) <= set(kept.columns)
    assert kept.count() == got.where("not rejected").count()


def test_sample_is_bounded_and_the_same_again(spark):
    docs = table(spark, SF01, "documents")
    a, b = (language.train(docs.repartition(k), sample_rows=20) for k in (2, 5))
    assert a.names == b.names and all(np.array_equal(x.gram_keys[4], y.gram_keys[4]) and np.allclose(x.gram_logs[4], y.gram_logs[4]) for x, y in zip(a.models, b.models, strict=True))
