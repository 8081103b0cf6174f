"""Keyed buffer of the ingest stream (D1, D2, G1): events of one namespace, type
and log partition gather in keyed state until there are ``max_buffer_records``
of them or the oldest has waited for ``max_buffer_time``, whichever comes first.
Every group that closes is staged as one unit (one manifest row).

State and timers belong to the query's checkpoint, so a restarted query goes on
with the events that waited; Spark's batch clock drives the timers, so a batch
that is run again closes the same groups. The key has the log partition, as the
log is what spreads a busy table over tasks; a key's state is less than one
group, and a batch brings it at most its part of one micro-batch.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from larkspur.contract import Layout, Settings, parse_iso_duration
from larkspur.operators.ingest import ingest
from larkspur.sources.catalog import live_tables
from larkspur.streaming.ingest import merge_lock, query_label

KEY = ["namespace", "type", "source_partition"]
EVENT = ["source_offset", "key", "value", "source_ts", "source_name"]
EVENT_DDL = "source_offset bigint, key string, value string, source_ts timestamp_ntz, source_name string"
GROUPED_DDL = f"namespace string, type string, source_partition int, group_seq bigint, closed_by string, {EVENT_DDL}"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class GroupBuffer(StatefulProcessor):
    """State of a key: the waiting events, the next group's number and when the
    open group is due (milliseconds; 0: no event waits)."""

    def __init__(self, max_records: int, max_millis: int):
        self.max_records, self.max_millis = max_records, max_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", EVENT_DDL)
        self.group = handle.getValueState("group", "seq bigint, due bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("source_offset", kind="stable")[EVENT]
        seq, due = self.group.get() if self.group.exists() else (0, 0)
        held = pd.DataFrame(list(self.waiting.get()), columns=EVENT) if due else new.iloc[:0]
        events = pd.concat([held, new]) if len(held) else new
        full = len(events) // self.max_records
        for g in range(full):
            yield self._closed(key, seq + g, "count", events.iloc[g * self.max_records : (g + 1) * self.max_records])
        rest = events.iloc[full * self.max_records :]
        if due and (full or not len(rest)):
            self.handle.deleteTimer(due)
        if not len(rest):
            self.waiting.clear()
            due = 0
        else:
            if full or not due:  # the open group's first event came now
                due = timerValues.getCurrentProcessingTimeInMs() + self.max_millis
                self.handle.registerTimer(due)
            self.waiting.put([tuple(r) for r in rest.astype(object).where(rest.notna(), None).itertuples(index=False)])
        self.group.update((seq + full, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        seq, due = self.group.get() if self.group.exists() else (0, 0)
        if due and due <= expiredTimerInfo.getExpiryTimeInMs():
            held = pd.DataFrame(list(self.waiting.get()), columns=EVENT)
            self.waiting.clear()
            self.group.update((seq + 1, 0))
            yield self._closed(key, seq, "time", held)

    @staticmethod
    def _closed(key, seq: int, by: str, events: pd.DataFrame) -> pd.DataFrame:
        head = dict(zip(KEY, key, strict=True)) | {"group_seq": seq, "closed_by": by}
        return events.assign(**head)[[*head, *EVENT]]

    def close(self) -> None:
        pass


def grouped_events(source: DataFrame, settings: Settings) -> DataFrame:
    """Raw records of a stream -> records of closed groups. Records whose
    envelope has no namespace or type wait under a key of their own."""
    source.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    name = F.col("source_name") if "source_name" in source.columns else F.lit(None).cast("string")
    text = lambda field: F.coalesce(F.get_json_object("value", f"$.{field}"), F.lit(""))
    rows = source.select(text("namespace").alias("namespace"), text("type").alias("type"), "source_partition", "source_offset", "key", "value", "source_ts", name.alias("source_name"))
    millis = int(parse_iso_duration(settings.max_buffer_time).total_seconds() * 1000)
    buffer = GroupBuffer(settings.max_buffer_records, millis)
    return rows.groupBy(*KEY).transformWithStateInPandas(buffer, GROUPED_DDL, "append", "processingTime")


def group_batch_id(label: str):
    """One batch id for each group, the same whenever it is staged again."""
    key = F.sha2(F.concat_ws("|", *(F.col(c).cast("string") for c in KEY)), 256)
    return F.concat(F.lit(f"{label}-"), F.substring(key, 1, 12), F.lit("-"), F.lpad(F.col("group_seq").cast("string"), 10, "0"))


def run_buffered_ingest(source: DataFrame, root: str, checkpoint: str, settings: Settings | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start the ingest with the keyed buffer. The trigger is how often the
    clock is looked at (default: a tenth of ``max_buffer_time``)."""
    settings = settings or Settings()
    label: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        if not label:
            label.append(query_label(spark, checkpoint))
        rows = batch.withColumn("batch_id", group_batch_id(label[0])).drop("namespace", "type", "group_seq", "closed_by")
        rows = rows.persist()  # the state's work is done once
        try:
            with merge_lock(root):
                ingest(spark, rows, root, live_tables(spark, root), settings)
        finally:
            rows.unpersist()

    seconds = max(1, int(parse_iso_duration(settings.max_buffer_time).total_seconds() / 10))
    return (
        grouped_events(source, settings).writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": f"{seconds} seconds"})).start()
    )


def waiting_events(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The events that wait in a stopped query's buffers: key and event."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "waiting").option("flattenCollectionTypes", "true").load()
    return state.select(*(F.col(f"key.{c}").alias(c) for c in KEY), "list_element.*")


def drain(query: StreamingQuery, poll_seconds: float = 0.5) -> None:
    """Wait until two batches on end find nothing new in the source (the first
    may be one that was cut off before a restart), and stop the query: with
    timers it has always another batch, so it never ends by itself."""
    while query.isActive:
        last = query.recentProgress[-2:]
        if len(last) == 2 and not any(p["numInputRows"] for p in last):
            break
        time.sleep(poll_seconds)
    if query.exception():
        raise query.exception()
    query.stop()


def staged_groups(spark: SparkSession, layout: Layout) -> DataFrame:
    """Accepted rows of each staged group: batch_id and their number."""
    from larkspur.operators.staging import read_manifest

    return read_manifest(spark, layout).groupBy("batch_id", "namespace", "type").agg(F.sum("total_records").cast("bigint").alias("n"))
