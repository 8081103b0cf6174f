"""Streaming ingest: availableNow run, restart from checkpoint."""

from pyspark.sql import functions as F

from larkspur.contract import Settings
from larkspur.operators.publish import read_ledger
from larkspur.contract import Layout
from larkspur.sources.catalog import PACKAGE_CATALOG, apply_all
from tools.event_log import landed_records
from larkspur.sources.stream import file_source
from larkspur.streaming.ingest import final_merge, run_ingest


def test_available_now_and_restart(spark, root):
    apply_all(spark, PACKAGE_CATALOG, root)
    landing = f"{root}/landing"
    landed_records(spark, "/root/testdata/sf0.001").repartition(2).write.parquet(landing)
    ckpt = f"{root}/_ckpt"
    settings = Settings(max_buffer_records=200)
    q = run_ingest(file_source(spark, landing, 1), root, ckpt, settings, trigger={"availableNow": True})
    q.awaitTermination()
    final_merge(spark, root, settings)
    n1 = read_ledger(spark, Layout(root)).agg(F.sum("total_records")).first()[0]
    # restart with the same checkpoint: nothing new, nothing duplicated
    q = run_ingest(file_source(spark, landing, 1), root, ckpt, settings, trigger={"availableNow": True})
    q.awaitTermination()
    assert final_merge(spark, root, settings) == []
    n2 = read_ledger(spark, Layout(root)).agg(F.sum("total_records")).first()[0]
    assert n1 == n2 and n1 > 0


def test_processing_time_trigger_merges_each_batch(spark, root):
    apply_all(spark, PACKAGE_CATALOG, root)
    landing = f"{root}/landing"
    landed_records(spark, "/root/testdata/sf0.001").repartition(3).write.parquet(landing)
    settings = Settings(max_buffer_records=200, max_buffer_time="PT1S")
    q = run_ingest(file_source(spark, landing, 1), root, f"{root}/_ckpt", settings,
                   merge_every_batch=True)  # trigger: processingTime = max_buffer_time
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    led = read_ledger(spark, Layout(root))
    assert led.count() >= 2  # merges committed while the query ran
    assert final_merge(spark, root, settings) == []  # nothing left pending
    staged = spark.read.parquet(f"{root}/manifest").agg(F.sum("total_records")).first()[0]
    assert led.agg(F.sum("total_records")).first()[0] == staged
