"""Settings, keys, lookups and failure isolation."""

import dataclasses
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from larkspur.contract import Layout, Settings, parse_iso_duration
from larkspur.functions.keys import group_key, split_key
from larkspur.operators.compaction import MergeError, merge_pending, pending_manifest
from larkspur.operators.ingest import batch_ids_by_offset, ingest
from larkspur.operators.publish import read_ledger
from larkspur.sources.catalog import PACKAGE_CATALOG, apply_all, live_tables, read_declaration, SchemaNotFound
from tools.event_log import landed_records


def test_iso_durations():
    assert parse_iso_duration("PT2M") == timedelta(minutes=2)
    assert parse_iso_duration("PT3M") == timedelta(minutes=3)
    assert parse_iso_duration("PT1H30M15S") == timedelta(hours=1, minutes=30, seconds=15)
    assert Settings().buffer_interval == "120 seconds"
    with pytest.raises(ValueError):
        parse_iso_duration("2 minutes")


def test_key_and_split(spark):
    df = spark.createDataFrame([("site", "page_actions"), ("a", "b|c")], "ns string, t string")
    keys = [r[0] for r in df.select(group_key(F.col("ns"), F.col("t"))).collect()]
    assert keys == ["site|page_actions", "a|b|c"]
    ns, t = split_key(F.lit("site|page_actions|extra"))
    r = spark.range(1).select(ns.alias("ns"), t.alias("t")).first()
    assert (r["ns"], r["t"]) == ("site", "page_actions")


def test_location_lookup(spark):
    decl = read_declaration(spark, PACKAGE_CATALOG, "site", "page_actions").first()
    assert decl["bucketName"] == "site-page-actions"
    with pytest.raises(SchemaNotFound):
        read_declaration(spark, PACKAGE_CATALOG, "site", "missing")


def test_failed_table_stays_pending_others_commit(spark, root):
    apply_all(spark, PACKAGE_CATALOG, root)
    specs = live_tables(spark, root)
    raw = batch_ids_by_offset(landed_records(spark, "/root/testdata/sf0.001"), "e0", 250)
    ingest(spark, raw, root, specs)
    # a broken spec for one table: its staged location does not exist
    broken = [dataclasses.replace(s, bucket_name="missing-bucket") if s.table_name == "alarms" else s
              for s in specs]
    with pytest.raises(MergeError):
        merge_pending(spark, Layout(root), broken)
    committed = {r["type"] for r in read_ledger(spark, Layout(root)).collect()}
    assert committed == {"page_actions"}
    pending = {r["type"] for r in pending_manifest(spark, Layout(root)).select("type").distinct().collect()}
    assert pending == {"alarms"}
    # with the right spec the remaining table commits
    merge_pending(spark, Layout(root), specs)
    assert pending_manifest(spark, Layout(root)).count() == 0
