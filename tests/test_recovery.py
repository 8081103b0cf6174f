"""Crash between a merge's data write and its ledger row."""

import pytest

import larkspur.operators.compaction as compaction
from larkspur.contract import Layout
from larkspur.operators.compaction import MergeError, merge_pending, pending_manifest
from larkspur.operators.ingest import batch_ids_by_offset, ingest
from larkspur.operators.publish import read_ledger
from larkspur.operators.read import read_table
from larkspur.operators.staging import read_manifest
from larkspur.sources.catalog import PACKAGE_CATALOG, apply_all, live_tables
from tools.event_log import landed_records


def test_crash_before_ledger_row_is_invisible_and_rerun_commits_once(spark, root, monkeypatch):
    apply_all(spark, PACKAGE_CATALOG, root)
    specs = live_tables(spark, root)
    layout = Layout(root)
    ingest(spark, batch_ids_by_offset(landed_records(spark, "/root/testdata/sf0.001"), "e0", 250), root, specs)
    staged = {r["type"]: r["n"] for r in read_manifest(spark, layout).groupBy("type").agg(
        {"total_records": "sum"}).withColumnRenamed("sum(total_records)", "n").collect()}

    def crash(*args, **kwargs):
        raise RuntimeError("driver lost before commit")

    monkeypatch.setattr(compaction, "write_ledger_row", crash)
    with pytest.raises(MergeError):
        merge_pending(spark, layout, specs)
    # data directories were written, but nothing is visible and all stays pending
    assert read_ledger(spark, layout).count() == 0
    for spec in specs:
        assert read_table(spark, root, spec).count() == 0
    assert pending_manifest(spark, layout).count() == read_manifest(spark, layout).count()

    monkeypatch.undo()
    merge_pending(spark, layout, specs)  # same pending set -> same merge ids, overwritten
    led = read_ledger(spark, layout).collect()
    assert len(led) == len(specs)
    for spec in specs:
        assert read_table(spark, root, spec).count() == staged[spec.table_name]
    assert merge_pending(spark, layout, specs) == []
