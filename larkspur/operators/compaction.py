"""Pre-commit merge of staged files.

Pending = manifest rows whose batch is not yet in the ledger (J5, by batch).
Per table, all pending staged files are read with the table's *current*
schema (A8: missing columns read as null, dropped ones vanish), laid out by
``event_date`` (and ``event_hour``) into files of about the target size and
written below ``data/merge_id=<M>/``. ``merge_id`` is a hash of the table and
its sorted pending batches, so a re-run rewrites the same directory. The
ledger row is written last (publish).
"""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone
import logging
import math
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larkspur.contract import R_COMMIT_GUARD, Layout, Settings
from larkspur.functions.times import event_date
from larkspur.operators.publish import guard_reason, one_row, read_ledger, settled_batches, write_ledger_row, write_rejected
from larkspur.operators.staging import listing, read_manifest, read_staged
from larkspur.session import settings_of
from larkspur.sources import storage
from larkspur.sources.catalog import POSITION, TableSpec

log = logging.getLogger(__name__)

#: Merges that are written beside each other, of one table or of several.
MERGES_AT_ONCE = 8


class CommitTurn:
    """Lets a table's merges commit in their order, also if a later one is
    written first: a reader as of a number must not see more under it later.
    After a merge that failed none of the table's later ones commits."""

    def __init__(self) -> None:
        self._turn, self._failed, self._changed = 0, False, threading.Condition()

    def wait(self, place: int) -> bool:
        """True when all merges before ``place`` have committed, False if one failed."""
        with self._changed:
            self._changed.wait_for(lambda: self._failed or self._turn >= place)
            return not self._failed

    def done(self, place: int, failed: bool = False) -> None:
        with self._changed:
            self._turn, self._failed = place + 1, self._failed or failed
            self._changed.notify_all()


class MergeSkipped(Exception):
    """An earlier merge of the table failed; this one stays pending with it."""


def valid_manifest(manifest: DataFrame) -> DataFrame:
    """Drop rows with a blank namespace, type or location."""
    cond = F.lit(True)
    for c in ("namespace", "type", "location"):
        cond = cond & F.col(c).isNotNull() & (F.trim(F.col(c)) != "")
    return manifest.where(cond)


def pending_manifest(spark: SparkSession, layout: Layout) -> DataFrame:
    """Valid staged files whose batch is neither committed nor refused."""
    settled = settled_batches(spark, layout)
    return valid_manifest(read_manifest(spark, layout)).join(settled, ["namespace", "type", "batch_id"], "left_anti")


def pending_manifest_as_of(spark: SparkSession, layout: Layout, as_of: int) -> DataFrame:
    """J5 as of ledger sequence ``as_of``: what was pending at that point."""
    settled = settled_batches(spark, layout, as_of)
    return valid_manifest(read_manifest(spark, layout)).join(settled, ["namespace", "type", "batch_id"], "left_anti")


def merge_summary(pending: DataFrame) -> DataFrame:
    """Per table and staged batch, its number of files and totals."""
    return pending.groupBy("namespace", "type", "batch_id").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("total_records").cast("bigint").alias("total_records"),
        F.sum("length").cast("bigint").alias("length"),
    )


def plan_merges(summary_rows, max_batches: int) -> list[dict]:
    """Group per-batch summary rows into merges of at most ``max_batches``
    batches per table, oldest batches first."""
    by_table: dict = {}
    for r in summary_rows:
        by_table.setdefault((r["namespace"], r["type"]), []).append(r)
    out = []
    for (ns, tp), rows in sorted(by_table.items()):
        rows.sort(key=lambda r: r["batch_id"])
        for i in range(0, len(rows), max_batches):
            chunk = rows[i:i + max_batches]
            out.append({
                "namespace": ns,
                "type": tp,
                "n_files": sum(int(r["n_files"]) for r in chunk),
                "total_records": sum(int(r["total_records"] or 0) for r in chunk),
                "length": sum(int(r["length"] or 0) for r in chunk),
                "child_batches": [r["batch_id"] for r in chunk],
            })
    return out


def merge_id_of(namespace: str, table: str, batches: list[str]) -> str:
    text = "\x1f".join([namespace, table, *sorted(batches)])
    return hashlib.sha256(text.encode()).hexdigest()[:20]


def with_partition_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    df = df.withColumn("event_date", event_date(F.col("event_time")))
    if spec.hourly:
        df = df.withColumn("event_hour", F.hour(F.col("event_time")))
    return df


@dataclass
class MergeResult:
    namespace: str
    type: str
    merge_id: str
    merge_seq: int
    total_records: int
    length: int
    n_files: int
    committed: bool


class MergeError(RuntimeError):
    """One or more tables failed to merge; they stay pending."""


def merge_table(spark: SparkSession, layout: Layout, spec: TableSpec, summary_row, merge_seq: int,
                settings: Settings, others_write: bool = True, may_commit: Callable[[], bool] = lambda: True) -> MergeResult:
    """Merge the pending files of one table and commit them. What the ledger
    says of the merge is observed while it is written; nothing is read again.
    ``may_commit`` waits until the merge is next to commit."""
    batches = list(summary_row["child_batches"])
    merge_id = merge_id_of(spec.namespace, spec.table_name, batches)
    staged = read_staged(spark, spec, layout, batches)
    rows = with_partition_columns(staged.drop("batch_id", "_metadata"), spec)
    total_bytes = int(summary_row["length"] or 0)
    total_rows = int(summary_row["total_records"] or 0)
    n_out = max(1, math.ceil(total_bytes / settings.target_file_bytes), math.ceil(total_rows / settings.target_file_rows))
    # Range partitioning on (date, time, id) splits one hot day, and even one
    # hot second, over several tasks, and leaves every file sorted by
    # event_time, so min/max statistics skip row groups on time filters. Rows
    # for one file a folder need no ranges, and so no sample: folders are dealt.
    order = [*spec.partition_columns, "event_time", "event_id"]
    writers = min(32, spark.sparkContext.defaultParallelism)
    out = (rows.repartition(writers, *spec.partition_columns) if n_out == 1 else rows.repartitionByRange(n_out, *order)).sortWithinPartitions(*order)
    target = f"{layout.data(spec)}/merge_id={merge_id}"
    seen = Observation()
    out = out.observe(seen, F.count(F.lit(1)).alias("n"), F.max("load_time").alias("l"), F.min("event_time").alias("t0"), F.max("event_time").alias("t1"))
    position = [f.name for f in POSITION.fields]
    out.select(*spec.to_physical(), *position, *spec.partition_columns).write.mode("overwrite").partitionBy(*spec.partition_columns).parquet(target)
    found = seen.get
    n_files, length = storage.size_of(spark, target)
    total = int(found["n"] or 0)
    if total != total_rows:
        raise RuntimeError(f"merge {merge_id} wrote {total} rows of {total_rows} staged ones")
    facts = {"total_records": total, "length": length, "type": spec.table_name, "location": target}
    why = one_row(spark, facts, "total_records long, length long, type string, location string").select(guard_reason().alias("why")).first()["why"]
    single = int(summary_row["n_files"]) == 1
    row = {
        "namespace": spec.namespace,
        "type": spec.table_name,
        "merge_id": merge_id,
        "merge_seq": merge_seq,
        "committed_at": None,
        "schema_version": spec.version,
        "total_records": total,
        "length": length,
        # A single staged unit passes through unchanged, without children
        "child_items": None if single else [layout.staged(spec, b) for b in batches],
        "child_batches": batches,
        "max_load_time": found["l"],
        "min_event_time": found["t0"],
        "max_event_time": found["t1"],
    }
    if not may_commit():
        raise MergeSkipped(merge_id)
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    if why is not None:
        log.error("merge %s of %s|%s refused: %s", merge_id, spec.namespace, spec.table_name, why)
        write_rejected(spark, layout, {
            "namespace": spec.namespace, "type": spec.table_name, "merge_id": merge_id, "rejected_at": now,
            "reason": f"{R_COMMIT_GUARD}: {why}", "total_records": total, "length": length, "child_batches": batches})
    else:
        if others_write:  # and may have committed some of these batches meanwhile
            led = read_ledger(spark, layout, spec.namespace, spec.table_name)
            done = led.where((F.col("merge_id") != merge_id) & F.arrays_overlap("child_batches", F.array(*map(F.lit, batches))))
            if not done.isEmpty():
                raise RuntimeError(f"batches of merge {merge_id} were committed by another writer")
        row["committed_at"] = now
        write_ledger_row(spark, layout, row)
    return MergeResult(spec.namespace, spec.table_name, merge_id, merge_seq, total, length, n_files, why is None)


def merge_all(spark: SparkSession, layout: Layout, specs: list[TableSpec], plans: list[dict], settings: Settings,
              first_seq: int | None = None) -> list[MergeResult]:
    """Make the planned merges beside each other; those of a table commit in their order.
    ``first_seq`` is given by a caller that alone hands out batches, each once;
    otherwise the ledger is asked for the next number and for other writers.

    Tables are independent (G9): a failing table is logged, stays pending
    and the error is raised after the others are done.
    """
    by_key = {(s.namespace, s.table_name): s for s in specs}
    if first_seq is None:
        last = read_ledger(spark, layout).agg(F.max("merge_seq").alias("m")).first()["m"] if plans else 0
        next_seq = int(last or 0) + 1
    else:
        next_seq = first_seq
    todo: dict = {}
    for r in plans:
        spec = by_key.get((r["namespace"], r["type"]))
        if spec is None:
            log.warning("no live table for %s|%s; files stay pending", r["namespace"], r["type"])
            continue
        todo.setdefault(spec, []).append((next_seq + sum(map(len, todo.values())), r))

    turns = {spec: CommitTurn() for spec in todo}

    def one_merge(spec: TableSpec, place: int) -> tuple[list, list]:
        seq, r = todo[spec][place]
        turn = turns[spec]
        try:
            done = merge_table(spark, layout, spec, r, seq, settings, first_seq is None, lambda: turn.wait(place))
        except MergeSkipped:
            return [], []
        except Exception as e:  # noqa: BLE001 - isolate tables, re-raise below
            log.error("merge of %s|%s failed: %s", r["namespace"], r["type"], e)
            told = turn.wait(place)  # of a table only the first failure
            turn.done(place, failed=True)
            return [], [(r["namespace"], r["type"], e)] if told else []
        except BaseException:  # nobody must wait for it
            turn.done(place, failed=True)
            raise
        turn.done(place)
        return [done], []

    if not todo:
        return []
    # by place, so that every merge's predecessors have started before it
    order = sorted(((spec, k) for spec in todo for k in range(len(todo[spec]))), key=lambda m: m[1])
    # set around the threads, which share the session's settings
    with settings_of(spark, listing(spark)), ThreadPoolExecutor(max_workers=min(MERGES_AT_ONCE, len(order))) as pool:
        found = list(pool.map(lambda m: one_merge(*m), order))
    results = sorted((r for done, _ in found for r in done), key=lambda r: r.merge_seq)
    errors = [e for _, bad in found for e in bad]
    if errors:
        raise MergeError(errors)
    return results


def merge_pending(spark: SparkSession, layout: Layout, specs: list[TableSpec],
                  settings: Settings | None = None) -> list[MergeResult]:
    """Merge and commit every table with pending staged files."""
    settings = settings or Settings()
    plans = plan_merges(merge_summary(pending_manifest(spark, layout)).collect(), settings.max_batches_per_merge)
    return merge_all(spark, layout, specs, plans, settings)
