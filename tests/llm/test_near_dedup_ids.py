"""The pipeline's near_dedup on repeated and missing doc_ids."""

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import syllables

A, B, C, D = (syllables(k, 80) for k in (31, 32, 33, 34))


def test_groups_are_of_texts_whatever_their_ids(spark):
    rows = [(8, A, "x"), (8, B, "x"), (8, A, "a"), (None, C, "x"), (None, C, "x"), (None, C, "b"), (5, D, "x"), (None, D, "x"), (9, B, "x"), (3, None, "x"), (4, "", "x")]
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        got = corpus_pipeline.near_dedup(spark, docs, "")
        assert got.schema == docs.schema
        got = sorted(map(tuple, got.collect()), key=str)
        assert set(got) <= set(rows)
        assert [r[:2] for r in got] == sorted([(8, A), (8, B), (None, C), (5, D), (3, None)], key=str)


def test_columns_of_any_name_and_type(spark):
    rows = [(1, A, {"k": 1}, 2, [1.0]), (2, A, None, 3, None), (2, B, {}, 4, [2.0, None]), (2, B, {"k": 2}, 5, [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` map<string,int>, row int, `x y;z` array<double>").withColumn("v", F.parse_json(F.lit('{"a":1}')))
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.dtypes == docs.dtypes
    got = [(r["doc_id"], r["text"], r["a.b"], r["row"]) for r in got.collect()]
    assert len(got) == 2 and (1, A, {"k": 1}, 2) in got and [r for r in got if r[1] == B][0] in [x[:4] for x in rows]
