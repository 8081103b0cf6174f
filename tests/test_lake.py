"""Staging, merge, commit and reads."""

import datetime as dt

from pyspark.sql import functions as F

from larkspur.contract import Layout, Settings
from larkspur.operators.compaction import merge_pending, pending_manifest, valid_manifest
from larkspur.operators.ingest import batch_ids_by_offset, ingest
from larkspur.operators.publish import cleanup_candidates, commit_guard, guard_reason, read_ledger
from larkspur.operators.read import read_table
from larkspur.operators.staging import read_manifest
from larkspur.sources.catalog import PACKAGE_CATALOG, apply_all, live_tables
from tools.event_log import landed_records

SF = "/root/testdata/sf0.001"


def _setup(spark, root):
    apply_all(spark, PACKAGE_CATALOG, root)
    return live_tables(spark, root), batch_ids_by_offset(landed_records(spark, SF), "e0", 250)


def test_commit_guard_and_manifest_validity(spark):
    rows = [("site", "page_actions", "s3://b/f.parquet", 3, 100), ("site", "", "x", 1, 1),
            ("site", "page_actions", "x", 0, 1), ("site", "page_actions", " ", 1, 1),
            ("", "page_actions", "loc", 1, 1), ("site", "page_actions", "x", 1, 0)]
    df = spark.createDataFrame(rows, "namespace string, type string, location string, total_records bigint, length bigint")
    got = [(r["ok"], r["why"]) for r in df.select(commit_guard().alias("ok"), guard_reason().alias("why")).collect()]
    assert got == [(True, None), (False, "blank_type"), (False, "no_records"), (False, "blank_location"),
                   (True, None), (False, "no_bytes")]
    # the merge side drops a blank namespace; the commit guard does not check it
    assert valid_manifest(df).count() == 3


def test_empty_pending_merges_nothing(spark, root):
    specs, _ = _setup(spark, root)
    assert merge_pending(spark, Layout(root), specs) == []


def test_stage_merge_commit_read(spark, root):
    specs, raw = _setup(spark, root)
    layout = Layout(root)
    ingest(spark, raw.where("source_offset < 500"), root, specs, Settings(max_buffer_records=100))
    # replay of batch 0 replaces its files
    before = read_manifest(spark, layout).where("batch_id = 'e0-0000000000'").agg(F.sum("total_records")).first()[0]
    ingest(spark, raw.where("source_offset < 250"), root, specs, Settings(max_buffer_records=100))
    after = read_manifest(spark, layout).where("batch_id = 'e0-0000000000'").agg(F.sum("total_records")).first()[0]
    assert before == after and before > 0
    staged_rows = read_manifest(spark, layout).agg(F.sum("total_records")).first()[0]
    first = merge_pending(spark, layout, specs)
    assert {r.type for r in first} == {"page_actions", "alarms"} and all(r.committed for r in first)
    assert pending_manifest(spark, layout).count() == 0
    ingest(spark, raw.where("source_offset >= 500"), root, specs, Settings(max_buffer_records=100))
    assert pending_manifest(spark, layout).count() > 0
    second = merge_pending(spark, layout, specs)
    led = read_ledger(spark, layout).orderBy("merge_seq").collect()
    assert [r["merge_seq"] for r in led] == [1, 2, 3, 4]
    api = next(s for s in specs if s.table_name == "page_actions")
    total = read_table(spark, root, api).count()
    assert total == sum(r["total_records"] for r in led if r["type"] == "page_actions")
    as_of = read_table(spark, root, api, as_of=2).count()
    assert as_of == next(r.total_records for r in first if r.type == "page_actions")
    assert cleanup_candidates(spark, layout).agg(F.sum("total_records")).first()[0] == \
        read_manifest(spark, layout).agg(F.sum("total_records")).first()[0]
    # merged rows equal staged rows across both tables
    assert sum(r["total_records"] for r in led) == read_manifest(spark, layout).agg(F.sum("total_records")).first()[0]
    assert staged_rows <= sum(r["total_records"] for r in led)


def test_single_file_passthrough_has_no_children(spark, root):
    specs, raw = _setup(spark, root)
    ingest(spark, raw.where("source_offset < 50"), root, specs, Settings(max_buffer_records=10_000))
    layout = Layout(root)
    n_files = read_manifest(spark, layout).groupBy("type").count().collect()
    merge_pending(spark, layout, specs)
    led = {r["type"]: r for r in read_ledger(spark, layout).collect()}
    for r in n_files:
        if r["count"] == 1:
            assert led[r["type"]]["child_items"] is None
        else:
            assert len(led[r["type"]]["child_items"]) == r["count"]


def test_time_range_read_prunes_partitions(spark, root):
    specs, raw = _setup(spark, root)
    ingest(spark, raw, root, specs)
    merge_pending(spark, Layout(root), specs)
    api = next(s for s in specs if s.table_name == "page_actions")
    df = read_table(spark, root, api, start="2024-01-10", end="2024-01-12")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters" in plan
    rows = df.select("event_time").collect()
    assert rows and all(dt.datetime(2024, 1, 10) <= r[0] < dt.datetime(2024, 1, 12) for r in rows)


def test_sql_views_follow_the_ledger(spark, root):
    from larkspur.operators.read import register_views

    specs, raw = _setup(spark, root)
    layout = Layout(root)
    ingest(spark, raw.where("source_offset < 500"), root, specs)
    merge_pending(spark, layout, specs)
    ingest(spark, raw.where("source_offset >= 500"), root, specs)
    merge_pending(spark, layout, specs)
    api = next(s for s in specs if s.table_name == "page_actions")
    names = register_views(spark, root, specs, as_of=2)
    view = names[("site", "page_actions")]
    assert spark.sql(f"SELECT count(*) FROM {view}").first()[0] == read_table(spark, root, api, as_of=2).count()
    names = register_views(spark, root, specs)
    assert spark.sql(f"SELECT count(*) FROM {view}").first()[0] == read_table(spark, root, api).count()
