"""Keyed buffer (D1, D2, G1): groups close by count or by time, whichever comes
first, and what waits survives a restart."""

import time

import pytest
from pyspark.sql import functions as F

from larkspur.contract import Layout, Settings
from larkspur.operators.staging import read_manifest
from larkspur.sources.catalog import PACKAGE_CATALOG, apply_all
from larkspur.sources.stream import file_source
from larkspur.streaming.buffer import drain, run_buffered_ingest, waiting_events
from larkspur.streaming.ingest import final_merge
from tests.test_staging import AT, records


@pytest.fixture()
def lake(root, spark):
    apply_all(spark, PACKAGE_CATALOG, root)
    return root


def put(spark, path, first, n, partition=0):
    rows = records(spark, [("x", {"k": 1, "action": str(k)}, AT) for k in range(n)]).drop("batch_id")
    text = F.replace(F.replace("value", F.lit('"namespace":"ns"'), F.lit('"namespace":"site"')), F.lit('"type":"x"'), F.lit('"type":"page_actions"'))
    rows = rows.withColumn("source_offset", F.col("source_offset") + first).withColumn("source_partition", F.lit(partition)).withColumn("value", text)
    rows.coalesce(1).write.mode("append").parquet(path)


def staged(spark, root):
    return sorted(r["total_records"] for r in read_manifest(spark, Layout(root)).collect())


def test_count_restart_then_time(spark, lake):
    source, check = f"{lake}/in", f"{lake}/check"
    put(spark, source, 0, 25)
    put(spark, source, 0, 7, partition=1)
    patient = Settings(max_buffer_records=10, max_buffer_time="PT1H")
    drain(run_buffered_ingest(file_source(spark, source), lake, check, patient, {"processingTime": "1 second"}))
    assert staged(spark, lake) == [10, 10]
    held = waiting_events(spark, check).groupBy("source_partition").agg(F.count("*").alias("n"), F.min("source_offset").alias("first")).orderBy("source_partition").collect()
    assert [tuple(r) for r in held] == [(0, 5, 20), (1, 7, 0)]
    # a restarted query goes on with what waited: five old events and five new ones fill a group
    put(spark, source, 25, 8)
    drain(run_buffered_ingest(file_source(spark, source), lake, check, patient, {"processingTime": "1 second"}))
    assert staged(spark, lake) == [10, 10, 10]
    final_merge(spark, lake)
    offsets = spark.read.parquet(f"{lake}/landing/outcome=accepted").count()
    assert offsets == 30


def test_time_closes_what_count_does_not(spark, lake):
    source = f"{lake}/in"
    put(spark, source, 0, 12)
    query = run_buffered_ingest(file_source(spark, source), lake, f"{lake}/check", Settings(max_buffer_records=10, max_buffer_time="PT2S"), {"processingTime": "1 second"})
    until = time.monotonic() + 60
    while staged(spark, lake) != [2, 10] and time.monotonic() < until:
        time.sleep(1)
    query.stop()
    assert staged(spark, lake) == [2, 10]
