"""Build a lakehouse from the driver's ``events`` table, the way the ingest
service would: schemas applied, the log staged batch by batch, merged and
committed in two rounds. Queries over staged/merged/committed state read it.

Scenario ``main``: batches ``[0, half)`` are staged (the first one twice, a
replay), merged and committed; then batches ``[half, n)`` are staged, merged
and committed. Scenario ``evolve`` applies the v2 declaration of
``page_actions`` between the two rounds (adds ``session``, drops ``fault``,
changes a type and the partitioning - the last two are ignored).

Built lakes are cached per Spark application and input, since building is
deterministic.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.contract import Layout, Settings
from larkspur.operators.compaction import merge_pending
from larkspur.operators.ingest import batch_ids_by_offset, ingest
from larkspur.session import work_root
from larkspur.sources.catalog import (
    PACKAGE_CATALOG,
    PACKAGE_CATALOG_V2,
    TableSpec,
    apply_all,
    apply_schema,
    live_tables,
)
from tools.event_log import landed_records

# Parameters of the scenario (the oracle SQL uses the same numbers).
OFFSETS_PER_BATCH = 2500
EPOCH = "e0"
GROUP_RECORDS = 500
SETTINGS = Settings(max_buffer_records=GROUP_RECORDS)


@dataclass
class Lake:
    root: str
    n_batches: int
    half: int
    specs: list
    steps: dict = field(default_factory=dict)  # seconds per build step
    first_round: int = 0  # the ledger's last number after the first round of merges

    @property
    def layout(self) -> Layout:
        return Layout(self.root)

    def spec(self, table: str) -> TableSpec:
        return next(s for s in self.specs if s.table_name == table)


_CACHE: dict = {}


def raw_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_ids_by_offset(landed_records(spark, sf_dir), EPOCH, OFFSETS_PER_BATCH)


def build_shared_bucket(spark: SparkSession, sf_dir: str) -> Lake:
    """Both tables declared in one bucket; everything staged, then merged."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "shared")
    if key not in _CACHE:
        root = work_root(spark, "lake-shared")
        apply_all(spark, PACKAGE_CATALOG, root)
        specs = [replace(s, bucket_name="shared") for s in live_tables(spark, root)]
        ingest(spark, raw_batches(spark, sf_dir), root, specs, SETTINGS)
        merge_pending(spark, Layout(root), specs, SETTINGS)
        _CACHE[key] = Lake(root, 0, 0, specs)
    return _CACHE[key]


def build_readded(spark: SparkSession, sf_dir: str) -> Lake:
    """Three rounds: declaration v1, then v2 (drops ``fault``), then v1 again
    (adds it back); each round's batches are staged and merged."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "readded")
    if key not in _CACHE:
        root = work_root(spark, "lake-readded")
        raw = raw_batches(spark, sf_dir)
        n = int(raw.agg(F.max("source_offset").alias("m")).first()["m"] or 0) // OFFSETS_PER_BATCH + 1
        cuts = [0, n // 3 * OFFSETS_PER_BATCH, 2 * n // 3 * OFFSETS_PER_BATCH, n * OFFSETS_PER_BATCH]
        for catalog, lo, hi in zip((PACKAGE_CATALOG, PACKAGE_CATALOG_V2, PACKAGE_CATALOG), cuts, cuts[1:], strict=False):
            apply_all(spark, catalog, root)
            specs = live_tables(spark, root)
            ingest(spark, raw.where((F.col("source_offset") >= lo) & (F.col("source_offset") < hi)), root, specs, SETTINGS)
            merge_pending(spark, Layout(root), specs, SETTINGS)
        _CACHE[key] = Lake(root, n, 0, live_tables(spark, root))
    return _CACHE[key]


def build_lake(spark: SparkSession, sf_dir: str, scenario: str = "main") -> Lake:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), scenario)
    if key in _CACHE:
        return _CACHE[key]
    steps: dict = {}

    def step(name, fn):
        t = time.perf_counter()
        out = fn()
        steps[name] = round(time.perf_counter() - t, 3)
        return out

    root = work_root(spark, f"lake-{scenario}")
    step("apply_schemas", lambda: apply_all(spark, PACKAGE_CATALOG, root))
    raw = raw_batches(spark, sf_dir)
    max_off = raw.agg(F.max("source_offset").alias("m")).first()["m"] or 0
    n_batches = int(max_off) // OFFSETS_PER_BATCH + 1
    half = n_batches // 2
    cut = half * OFFSETS_PER_BATCH
    specs = live_tables(spark, root)
    first = raw.where(F.col("source_offset") < cut)
    step("stage_round1", lambda: ingest(spark, first, root, specs, SETTINGS))
    if half > 0:  # replay of the first batch: must replace, not add
        step("replay_batch", lambda: ingest(
            spark, raw.where(F.col("source_offset") < OFFSETS_PER_BATCH), root, specs, SETTINGS))
    merged = step("merge_round1", lambda: merge_pending(spark, Layout(root), specs, SETTINGS))
    if scenario == "evolve":
        apply_schema(spark, PACKAGE_CATALOG_V2, root, "site", "page_actions")
        specs = live_tables(spark, root)
    step("stage_round2", lambda: ingest(spark, raw.where(F.col("source_offset") >= cut), root, specs, SETTINGS))
    step("merge_round2", lambda: merge_pending(spark, Layout(root), specs, SETTINGS))
    lake = Lake(root, n_batches, half, live_tables(spark, root), steps, max((m.merge_seq for m in merged), default=0))
    _CACHE[key] = lake
    return lake
