"""One ingest step: raw records -> landed files + manifest + quarantine.

This is the body of the streaming ``foreachBatch`` and also the batch entry
point (many batches at once, told apart by a ``batch_id`` column). The work
is one narrow pass: decode (A2) -> validate and route (B1-B3, J1) -> typed rows
of all tables (B10, C*) -> one partitioned write of accepted and rejected rows
(A5, Q1-Q5) -> manifest (A6) from the footers of what was written (D5). Nothing
is cached and no landed column is read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.contract import Layout, Settings
from larkspur.operators.project import project_tables
from larkspur.operators.staging import BATCHES_AT_ONCE, REJECTED, land, publish_landed
from larkspur.operators.validate import route
from larkspur.sources import storage
from larkspur.sources.catalog import TableSpec
from larkspur.sources.envelope import decode_envelope


@dataclass
class IngestReport:
    batch_ids: list
    tables: list


def batch_ids_by_offset(raw: DataFrame, epoch: str, offsets_per_batch: int) -> DataFrame:
    """Batch mode: cut a log into batches of ``offsets_per_batch`` offsets."""
    n = F.floor(F.col("source_offset") / F.lit(offsets_per_batch)).cast("string")
    return raw.withColumn("batch_id", F.concat(F.lit(f"{epoch}-"), F.lpad(n, 10, "0")))


def ingest(spark: SparkSession, raw: DataFrame, root: str, specs: list[TableSpec],
           settings: Settings | None = None, load_time: Column | None = None, batch_ids: list[str] | None = None) -> IngestReport:
    """Land every batch present in ``raw`` (which must have ``batch_id``).
    ``batch_ids`` spares the scan of that column where they are known."""
    settings = settings or Settings()
    layout = Layout(root)
    if batch_ids is None:
        batch_ids = sorted(r["batch_id"] for r in raw.select("batch_id").distinct().collect())
    storage.make_dirs(spark, layout.quarantine)
    # a part at a time, so that the folders of one write are bounded
    tables = set()
    for k in range(0, len(batch_ids), BATCHES_AT_ONCE):
        some = batch_ids[k : k + BATCHES_AT_ONCE]
        part = raw if len(some) == len(batch_ids) else raw.where(F.col("batch_id").between(some[0], some[-1]))
        filled = land(project_tables(route(decode_envelope(part), specs), specs, load_time), specs, layout, settings.max_buffer_records)
        publish_landed(spark, specs, layout, some, filled)
        tables |= {i for i, _ in filled if i != REJECTED}
    return IngestReport(batch_ids, [(specs[i].namespace, specs[i].table_name) for i in sorted(tables)])
