"""The manifest as a stream (A7, D4, G2, J5): a query of its own over the
manifest folder merges and commits what is newly published. Its checkpoint says
what was taken, so a merge reads the new manifest rows only, however many
batches there were before; a batch that is published twice is taken once, by
keyed state.

Merge ids come from the batches and sequence numbers from the micro-batch, so a
micro-batch that runs again commits the same merges. Tables that fail are handed
to the next micro-batch (G9); what was handed on is a small table per
micro-batch.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from larkspur.contract import MANIFEST_DDL, Layout, Settings
from larkspur.operators.compaction import MergeError, merge_all, merge_summary, plan_merges, valid_manifest
from larkspur.sources import storage
from larkspur.sources.catalog import live_tables
from larkspur.streaming.buffer import STATE_STORE

log = logging.getLogger(__name__)

#: Merges of one micro-batch, at most, as far as their numbers go.
SEQUENCES = 1_000_000


def manifest_source(spark: SparkSession, layout: Layout, max_files: int) -> DataFrame:
    """New manifest rows, each staged unit once."""
    storage.make_dirs(spark, layout.manifest)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    rows = spark.readStream.schema(MANIFEST_DDL).option("maxFilesPerTrigger", max_files).parquet(layout.manifest)
    return valid_manifest(rows).dropDuplicates(["namespace", "type", "batch_id"])


def run_merges(spark: SparkSession, root: str, checkpoint: str, settings: Settings | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start the merge query; the trigger defaults to the merge window."""
    settings = settings or Settings()
    layout = Layout(root)

    def left_over(number: int) -> str:
        return f"{checkpoint.rstrip('/')}-left/batch={number}"

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        todo = batch
        if number and storage.exists(session, left_over(number - 1)):
            todo = todo.unionByName(session.read.schema(MANIFEST_DDL).parquet(left_over(number - 1)))
        todo = todo.persist()
        try:
            plans = plan_merges(merge_summary(todo).collect(), settings.max_batches_per_merge)
            failed: set = set()
            try:
                merge_all(session, layout, live_tables(session, root), plans, settings, first_seq=number * SEQUENCES + 1)
            except MergeError as e:
                failed = {(ns, tp) for ns, tp, _ in e.args[0]}
                log.error("tables handed to the next batch: %s", sorted(failed))
            if failed:
                keep = " or ".join(f"(namespace = {ns!r} and type = {tp!r})" for ns, tp in sorted(failed))
                todo.where(keep).write.mode("overwrite").parquet(left_over(number))
            else:
                storage.delete(session, left_over(number))
        finally:
            todo.unpersist()

    source = manifest_source(spark, layout, settings.max_batches_per_merge)
    trigger = trigger or {"processingTime": f"{max(1, int(settings.merge_interval.total_seconds()))} seconds"}
    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**trigger).start()
