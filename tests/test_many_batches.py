"""What a long backlog of small batches costs and gives: one write however many
batches there are, no second projection, rounds of more merges than tables."""

import glob
import os
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from larkspur.contract import RAW_SCHEMA, Layout, Settings
from larkspur.operators import compaction, staging
from larkspur.operators import ingest as step
from larkspur.operators.publish import read_ledger
from larkspur.operators.read import read_table
from larkspur.plans import lake as lakes
from larkspur.plans.queries import QUERIES
from larkspur.sources import storage
from larkspur.sources.catalog import PACKAGE_CATALOG, apply_all, live_tables

VALUE = '{"namespace":"site","type":"page_actions","tenantId":"t","eventTime":"2025-03-01 10:00:00","attributes":{"k":%s}}'


def backlog(spark, n):
    """A good and a bad record in each of ``n`` batches."""
    rows = [(None, VALUE % k, 0, 2 * b + j, None) for b in range(n) for j, k in enumerate((b, '"x"'))]
    return spark.createDataFrame(rows, RAW_SCHEMA).withColumn("batch_id", F.format_string("b%05d", F.floor(F.col("source_offset") / 2).cast("int")))


def test_one_write_for_many_batches(spark, root, monkeypatch):
    apply_all(spark, PACKAGE_CATALOG, root)
    writes = []

    def counted(df, path, *rest):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        writes.append((path, plan.count("count_if"), "Filter" in plan.split("CollectMetrics")[-1]))
        real(df, path, *rest)

    real = staging.overwrite_partitions
    monkeypatch.setattr(staging, "overwrite_partitions", counted)
    step.ingest(spark, backlog(spark, 150), root, live_tables(spark, root))
    landed = [w for w in writes if w[0] == Layout(root).landing]
    assert landed == [(Layout(root).landing, 0, False)]
    m = staging.read_manifest(spark, Layout(root)).collect()
    assert len(m) == 150 and {r["total_records"] for r in m} == {1}
    for r in m[:3]:
        assert r["length"] == sum(os.path.getsize(f) for f in glob.glob(f"{r['location']}/*.parquet"))
    assert staging.read_quarantine(spark, Layout(root)).count() == 150


def test_files_of_the_log_are_landed_beside_each_other(spark, root, monkeypatch):
    apply_all(spark, PACKAGE_CATALOG, root)
    cores = spark.sparkContext.defaultParallelism
    backlog(spark, 2 * cores).repartitionByRange(4 * cores, "source_offset").write.parquet(f"{root}/raw")
    tasks, real = [], staging.overwrite_partitions

    def counted(df, path, *rest):
        if path == Layout(root).landing:
            tasks.append(df.rdd.getNumPartitions())
        real(df, path, *rest)

    monkeypatch.setattr(staging, "overwrite_partitions", counted)
    step.ingest(spark, spark.read.parquet(f"{root}/raw"), root, live_tables(spark, root))
    files = len(glob.glob(f"{root}/raw/*.parquet"))
    assert tasks == [files] and files > 2 * cores  # packed by core: at most about 2 tasks a core
    assert staging.read_manifest(spark, Layout(root)).count() == 2 * cores


def test_parts_of_a_backlog(spark, root, monkeypatch):
    apply_all(spark, PACKAGE_CATALOG, root)
    monkeypatch.setattr(step, "BATCHES_AT_ONCE", 2)
    step.ingest(spark, backlog(spark, 5), root, live_tables(spark, root))
    m = staging.read_manifest(spark, Layout(root))
    assert sorted((r["batch_id"], r["total_records"]) for r in m.collect()) == [(f"b{b:05d}", 1) for b in range(5)]


def test_size_of_counts_data_files(spark, root):
    spark.range(10).withColumn("p", F.col("id") % 3).repartition(2).write.partitionBy("p").parquet(f"{root}/some")
    files = glob.glob(f"{root}/some/*/*.parquet")
    assert storage.size_of(spark, f"{root}/some") == (len(files), sum(map(os.path.getsize, files)))


def test_first_round_of_more_merges_than_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lakes, "SETTINGS", replace(lakes.SETTINGS, max_batches_per_merge=1))
    day = F.expr("timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, 0, 0, id)")
    spark.range(1, 20000, 100).select(
        F.col("id").alias("event_id"), day.alias("ts"), (F.col("id") + 1).alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(1.5).alias("value"), F.lit('{"k":1}').alias("props")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    lake = lakes.build_lake(spark, str(tmp_path))
    m = staging.read_manifest(spark, lake.layout).where("type = 'page_actions'").collect()
    early = sum(r["total_records"] for r in m if r["batch_id"] < "e0-0000000004")
    late = sum(r["total_records"] for r in m if r["batch_id"] >= "e0-0000000004")
    assert early and late and lake.n_batches == 8
    assert sum(r["n"] for r in QUERIES["as_of_read"](spark, str(tmp_path)).collect()) == early
    pending = [r for r in QUERIES["pending_files"](spark, str(tmp_path)).collect() if r["type"] == "page_actions"]
    assert [(r["n_batches"], r["total_records"]) for r in pending] == [(4, late)]


def test_merges_of_a_table_are_written_beside_each_other_and_commit_in_order(spark, root, monkeypatch):
    """A round of several merges a table; the first waits here until the
    last is written, and the ledger still gets them in their order."""
    apply_all(spark, PACKAGE_CATALOG, root)
    layout, specs = Layout(root), live_tables(spark, root)
    step.ingest(spark, backlog(spark, 5), root, specs)
    written, committed, last = [], [], threading.Event()
    size_of, ledger = storage.size_of, compaction.write_ledger_row

    def sized(session, path):
        written.append(path)
        if len(written) == 3:
            last.set()
        assert last.wait(60), "the merges do not overlap"
        return size_of(session, path)

    monkeypatch.setattr(compaction.storage, "size_of", sized)
    monkeypatch.setattr(compaction, "write_ledger_row", lambda s, lay, row: (committed.append(row["merge_seq"]), ledger(s, lay, row)))
    got = compaction.merge_pending(spark, layout, specs, Settings(max_batches_per_merge=2))
    assert [(r.merge_seq, r.total_records) for r in got] == [(1, 2), (2, 2), (3, 1)] and committed == [1, 2, 3]
    assert sorted((r["merge_seq"], r["child_batches"][0]) for r in read_ledger(spark, layout).collect()) == [(1, "b00000"), (2, "b00002"), (3, "b00004")]


def test_after_a_failed_merge_none_of_its_table_commits(spark, root, monkeypatch):
    apply_all(spark, PACKAGE_CATALOG, root)
    layout, specs = Layout(root), live_tables(spark, root)
    step.ingest(spark, backlog(spark, 7), root, specs)
    real = compaction.merge_table

    def failing(session, lay, spec, row, seq, *rest):
        if seq in (2, 4):
            raise OSError(f"merge {seq} is broken")
        return real(session, lay, spec, row, seq, *rest)

    monkeypatch.setattr(compaction, "merge_table", failing)
    few = Settings(max_batches_per_merge=2)
    with pytest.raises(compaction.MergeError) as told:
        compaction.merge_pending(spark, layout, specs, few)
    assert [str(e) for _, _, e in told.value.args[0]] == ["merge 2 is broken"]
    assert [r["merge_seq"] for r in read_ledger(spark, layout).collect()] == [1]
    monkeypatch.undo()
    assert compaction.pending_manifest(spark, layout).count() == 5
    assert [(r.merge_seq, r.total_records) for r in compaction.merge_pending(spark, layout, specs, few)] == [(2, 2), (3, 2), (4, 1)]
    page_actions = next(s for s in specs if s.table_name == "page_actions")
    assert sorted(r["k"] for r in read_table(spark, root, page_actions).collect()) == list(range(7))
