"""The streaming ingest query.

``source -> foreachBatch(ingest)`` with a processing-time trigger that plays
the role of the grouping tick (``MAX_BUFFER_TIME``); the file count bound of
a group is ``maxRecordsPerFile``. Each micro-batch re-reads the live table
schemas (no stale cache) and stages its rows under ``batch_id = <id of the
query>-<number of the micro-batch>``. The query's id lives in its checkpoint:
a replay rewrites the same batch (exactly-once together with the checkpoint),
while another source or a new checkpoint never meets its batches.

Merges run beside the query, on a clock of their own: pending files are
committed within the merge window even if no event arrives, and a table whose
merge fails stays pending without holding up the ingest of the others.

There is no watermark: late events are accepted and land in their own
``event_date`` (G7).
"""

from __future__ import annotations

import json
import logging
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larkspur.contract import Layout, Settings
from larkspur.operators.compaction import MergeError, merge_pending
from larkspur.operators.ingest import ingest
from larkspur.sources.catalog import live_tables

log = logging.getLogger(__name__)

_LOCKS: dict[str, threading.Lock] = {}


def merge_lock(root: str) -> threading.Lock:
    """Ingest and merges of one lake take turns in this driver: a replayed
    batch is not merged while it is written anew."""
    return _LOCKS.setdefault(root.rstrip("/"), threading.Lock())


def query_label(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query, from its checkpoint."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"].replace("-", "")


def batch_label(query: str, batch_id: int) -> str:
    return f"{query}-{int(batch_id):010d}"


def make_batch_writer(root: str, checkpoint: str, settings: Settings, merge_every_batch: bool = False):
    label: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not label:
            label.append(query_label(spark, checkpoint))
        with merge_lock(root):
            specs = live_tables(spark, root)
            name = batch_label(label[0], batch_id)
            ingest(spark, batch.withColumn("batch_id", F.lit(name)), root, specs, settings, batch_ids=[name])
        if merge_every_batch:
            merge_now(spark, root, settings)

    return write


def merge_now(spark: SparkSession, root: str, settings: Settings) -> None:
    """Merge what is pending; a table that fails is logged and stays pending."""
    try:
        with merge_lock(root):
            merge_pending(spark, Layout(root), live_tables(spark, root), settings)
    except MergeError as e:
        log.error("some tables stay pending: %s", e)


def start_merge_clock(spark: SparkSession, query: StreamingQuery, root: str, settings: Settings) -> threading.Thread:
    """Merge every ``pre_commit_merge_window`` while the query runs, and once
    more when it has ended."""

    def run() -> None:
        while query.isActive:
            query.awaitTermination(max(1, int(settings.merge_interval.total_seconds())))
            try:
                merge_now(spark, root, settings)
            except Exception:  # noqa: BLE001 - the next tick tries again
                log.exception("merge of %s failed", root)

    thread = threading.Thread(target=run, name=f"merge-{root}", daemon=True)
    thread.start()
    return thread


def run_ingest(source: DataFrame, root: str, checkpoint: str, settings: Settings | None = None,
               trigger: dict | None = None, merge_every_batch: bool = False) -> StreamingQuery:
    """Start the ingest query. ``trigger`` defaults to the grouping tick; with
    a trigger that ends by itself (``availableNow``) call ``final_merge``."""
    settings = settings or Settings()
    trigger = trigger or {"processingTime": settings.buffer_interval}
    query = (
        source.writeStream.foreachBatch(make_batch_writer(root, checkpoint, settings, merge_every_batch))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    if "processingTime" in trigger:
        start_merge_clock(source.sparkSession, query, root, settings)
    return query


def final_merge(spark: SparkSession, root: str, settings: Settings | None = None):
    """Merge whatever is still pending (e.g. after an ``availableNow`` run)."""
    with merge_lock(root):
        return merge_pending(spark, Layout(root), live_tables(spark, root), settings)
