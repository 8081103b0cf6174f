"""Staging and schema cases beyond the plain path: shared buckets, batches that
stage nothing, replays under another schema, unreadable metadata, two logs in
one lake, columns that come back, hot seconds, idle streams."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from larkspur.contract import QUARANTINE_DDL, RAW_SCHEMA, Layout, Settings
from larkspur.operators import compaction
from larkspur.operators.compaction import merge_pending, pending_manifest
from larkspur.operators.ingest import ingest
from larkspur.operators.publish import read_ledger, read_rejected
from larkspur.operators.read import read_table
from larkspur.operators.staging import read_manifest
from larkspur.sources import storage
from larkspur.sources.catalog import apply_schema, live_tables
from larkspur.sources.stream import file_source
from larkspur.streaming.ingest import final_merge, run_ingest


def declare(folder, table, fields, bucket="one-bucket", partition="DAY", namespace="ns"):
    os.makedirs(f"{folder}/{namespace}", exist_ok=True)
    doc = {"namespace": namespace, "tableName": table, "bucketName": bucket, "partitionType": partition,
           "fields": [{"id": 100 + k, "name": n, "dataType": t} for k, (n, t) in enumerate(fields)]}
    with open(f"{folder}/{namespace}/{table}.json", "w") as f:
        json.dump(doc, f)


def records(spark, rows, batch="b0"):
    """rows: (table, attributes as JSON text or a dict, event time)"""
    out = []
    for k, (table, attributes, at) in enumerate(rows):
        text = attributes if isinstance(attributes, str) else json.dumps(attributes)
        out.append((None, '{"namespace":"ns","type":"%s","tenantId":"t","eventTime":"%s","attributes":%s}' % (table, at, text), 0, k, None))
    return spark.createDataFrame(out, RAW_SCHEMA).withColumn("source_ts", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")).withColumn("batch_id", F.lit(batch))


AT = "2025-03-01 10:00:00"


@pytest.fixture()
def lake(spark, root, tmp_path):
    cat = str(tmp_path / "cat")
    declare(cat, "t1", [("k", "INT")])
    declare(cat, "t2", [("k", "INT")])
    for t in ("t1", "t2"):
        apply_schema(spark, cat, root, "ns", t)
    return root, cat


def table(spark, root, name="t1"):
    return next(s for s in live_tables(spark, root) if s.table_name == name)


def values(spark, root, name="t1", column="k"):
    return sorted((r[column] for r in read_table(spark, root, table(spark, root, name)).collect()), key=str)


def test_two_tables_share_a_bucket(spark, lake):
    root, _ = lake
    ingest(spark, records(spark, [("t1", {"k": k}, AT) for k in range(3)] + [("t2", {"k": 10 + k}, AT) for k in range(5)]), root, live_tables(spark, root))
    merge_pending(spark, Layout(root), live_tables(spark, root))
    assert values(spark, root, "t1") == [0, 1, 2] and values(spark, root, "t2") == [10, 11, 12, 13, 14]
    assert read_manifest(spark, Layout(root)).groupBy("type").agg(F.sum("total_records").alias("n")).orderBy("type").collect() == [("t1", 3), ("t2", 5)]


def test_all_rejected_batch_stages_nothing(spark, lake):
    root, _ = lake
    ingest(spark, records(spark, [("t1", {"k": "x"}, AT)]), root, live_tables(spark, root))
    assert read_manifest(spark, Layout(root)).count() == 0 and merge_pending(spark, Layout(root), live_tables(spark, root)) == []
    assert spark.read.parquet(Layout(root).quarantine).count() == 1
    ingest(spark, records(spark, []), root, live_tables(spark, root))


def test_replay_under_another_schema_leaves_nothing_stale(spark, lake):
    root, cat = lake
    rows = [("t1", {"k": k, "s": "x"}, AT) for k in range(4)] + [("t1", {"k": "bad"}, AT)]
    ingest(spark, records(spark, rows), root, live_tables(spark, root))
    declare(cat, "t1", [("s", "STRING")])
    apply_schema(spark, cat, root, "ns", "t1")
    ingest(spark, records(spark, rows), root, live_tables(spark, root))
    merge_pending(spark, Layout(root), live_tables(spark, root))
    quarantined = spark.read.schema(QUARANTINE_DDL).parquet(Layout(root).quarantine)
    assert quarantined.count() == 0 and values(spark, root, column="s") == [None, "x", "x", "x", "x"]


@pytest.mark.parametrize("what", ["ledger", "manifest", "registry"])
def test_unreadable_metadata_raises_and_changes_nothing(spark, lake, monkeypatch, what):
    root, _ = lake
    layout, specs = Layout(root), live_tables(spark, root)
    ingest(spark, records(spark, [("t1", {"k": 1}, AT)]), root, specs)
    merge_pending(spark, layout, specs)
    ingest(spark, records(spark, [("t1", {"k": 2}, AT)], "b1"), root, specs)
    there, bad = storage.exists, getattr(layout, what)

    def broken(session, path):
        if path.startswith(bad):
            raise OSError("store is away")
        return there(session, path)

    monkeypatch.setattr(storage, "exists", broken)
    with pytest.raises(OSError):
        if what == "registry":
            live_tables(spark, root)
        else:
            merge_pending(spark, layout, specs)
    monkeypatch.undo()
    assert read_ledger(spark, layout).count() == 1
    merge_pending(spark, layout, specs)
    assert values(spark, root) == [1, 2]


def test_columns_follow_field_ids(spark, lake):
    root, cat = lake
    steps = [([("k", "INT"), ("x", "STRING")], {"x": "old"}), ([("k", "INT")], {}), ([("k", "INT"), ("x", "STRING")], {"x": "new"}),
             ([("k", "INT")], {}), ([("k", "INT"), ("x", "LONG")], {"x": 7})]
    seen = []
    for n, (fields, extra) in enumerate(steps):
        declare(cat, "t1", fields)
        apply_schema(spark, cat, root, "ns", "t1")
        ingest(spark, records(spark, [("t1", {"k": n, **extra}, AT)], f"b{n}"), root, live_tables(spark, root))
        merge_pending(spark, Layout(root), live_tables(spark, root))
        got = read_table(spark, root, table(spark, root))
        seen.append({r["k"]: r["x"] for r in got.collect()} if "x" in got.columns else None)
    assert seen == [{0: "old"}, None, {0: None, 1: None, 2: "new"}, None, {0: None, 1: None, 2: None, 3: None, 4: 7}]


def test_staged_before_a_drop_reads_null_after_readding(spark, lake):
    root, cat = lake
    declare(cat, "t1", [("k", "INT"), ("x", "STRING")])
    apply_schema(spark, cat, root, "ns", "t1")
    ingest(spark, records(spark, [("t1", {"k": 0, "x": "old"}, AT)]), root, live_tables(spark, root))
    for fields in ([("k", "INT")], [("k", "INT"), ("x", "STRING")]):
        declare(cat, "t1", fields)
        apply_schema(spark, cat, root, "ns", "t1")
    merge_pending(spark, Layout(root), live_tables(spark, root))
    assert values(spark, root, column="x") == [None]


def test_drop_all_columns(spark, lake):
    root, cat = lake
    declare(cat, "t1", [])
    got = apply_schema(spark, cat, root, "ns", "t1")
    assert (got.version, got.dropped) == (2, 1) and table(spark, root).fields == () and table(spark, root).version == 2
    assert apply_schema(spark, cat, root, "ns", "t1").version == 2
    declare(cat, "t1", [("k", "INT")])
    assert apply_schema(spark, cat, root, "ns", "t1").version == 3 and table(spark, root).fields[0][0] != 100


def test_dotted_and_quoted_names(spark, lake):
    root, cat = lake
    declare(cat, "t1", [("a.b", "INT"), ("it's", "INT")])
    apply_schema(spark, cat, root, "ns", "t1")
    ingest(spark, records(spark, [("t1", {"a.b": 1, "it's": 2}, AT), ("t1", {"a.b": "bad", "it's": "bad"}, AT)]), root, live_tables(spark, root))
    merge_pending(spark, Layout(root), live_tables(spark, root))
    assert values(spark, root, column="a.b") == [1] and values(spark, root, column="it's") == [2]
    assert set(spark.read.parquet(Layout(root).quarantine).first()["detail"].split(",")) == {"a.b", "it's"}


def test_a_hot_second_is_several_files_and_few_rows_are_one(spark, lake):
    root, _ = lake
    ingest(spark, records(spark, [("t1", {"k": k}, AT) for k in range(400)]), root, live_tables(spark, root))
    merge_pending(spark, Layout(root), live_tables(spark, root), Settings(target_file_rows=50))
    files = read_table(spark, root, table(spark, root)).select("_metadata.file_path").distinct().count()
    assert files >= 4 and values(spark, root) == sorted(range(400), key=str)


def test_few_rows_of_an_hourly_table_are_one_file(spark, lake):
    root, cat = lake
    declare(cat, "t3", [("k", "INT")], partition="HOUR")
    apply_schema(spark, cat, root, "ns", "t3")
    ingest(spark, records(spark, [("t3", {"k": k}, f"2025-03-01 {10 + k % 3}:00:0{k % 10}") for k in range(60)]), root, live_tables(spark, root))
    merge_pending(spark, Layout(root), live_tables(spark, root))
    spec = table(spark, root, "t3")
    assert read_table(spark, root, spec).select("_metadata.file_path").distinct().count() == 3  # one for each hour
    hour = read_table(spark, root, spec, start="2025-03-01T11:00:00", end="2025-03-01T12:00:00")
    assert hour.count() == 20 and len(hour.inputFiles()) == 3
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = read_table(spark, root, spec, start="2025-03-01T11:00:00", end="2025-03-01T12:00:00")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "event_hour" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_refused_merge_is_kept_once(spark, lake, monkeypatch):
    root, _ = lake
    layout, specs = Layout(root), live_tables(spark, root)
    ingest(spark, records(spark, [("t1", {"k": 1}, AT)]), root, specs)
    monkeypatch.setattr(compaction, "guard_reason", lambda: F.lit("no_bytes"))
    assert [r.committed for r in merge_pending(spark, layout, specs)] == [False]
    monkeypatch.undo()
    assert read_ledger(spark, layout).count() == 0 and pending_manifest(spark, layout).count() == 0
    assert [(r["type"], r["reason"]) for r in read_rejected(spark, layout).collect()] == [("t1", "commit_guard: no_bytes")]
    assert merge_pending(spark, layout, specs) == []


def land(spark, path, rows):
    records(spark, rows).drop("batch_id").write.mode("append").parquet(path)


def test_two_logs_and_a_new_checkpoint_keep_all_rows(spark, lake):
    root, _ = lake
    land(spark, f"{root}/in/a", [("t1", {"k": k}, AT) for k in range(4)])
    land(spark, f"{root}/in/b", [("t1", {"k": 10 + k}, AT) for k in range(4)])
    for name in ("a", "b"):
        run_ingest(file_source(spark, f"{root}/in/{name}", name=name), root, f"{root}/check/{name}", trigger={"availableNow": True}).awaitTermination()
    final_merge(spark, root)
    assert values(spark, root) == sorted([0, 1, 2, 3, 10, 11, 12, 13], key=str)
    ids = read_table(spark, root, table(spark, root)).select("event_id").distinct().count()
    assert ids == 8  # equal positions of two logs
    land(spark, f"{root}/in/c", [("t2", {"k": 1}, AT)])
    run_ingest(file_source(spark, f"{root}/in/c", name="a"), root, f"{root}/check/new", trigger={"availableNow": True}).awaitTermination()
    final_merge(spark, root)
    assert len(values(spark, root)) == 8 and values(spark, root, "t2") == [1]


def test_an_idle_stream_commits_and_a_poisoned_batch_does_not_stop_it(spark, lake, monkeypatch):
    root, _ = lake
    land(spark, f"{root}/in", [("t1", {"k": "poison"}, AT)])
    land(spark, f"{root}/in", [("t1", {"k": 1}, AT), ("t2", {"k": 2}, AT)])
    real = compaction.merge_table

    def failing(session, layout, spec, *rest):
        if spec.table_name == "t2":
            raise OSError("t2 is broken")
        return real(session, layout, spec, *rest)

    monkeypatch.setattr(compaction, "merge_table", failing)
    settings = Settings(max_buffer_time="PT1S", pre_commit_merge_window="PT2S")
    query = run_ingest(file_source(spark, f"{root}/in", 1), root, f"{root}/check", settings)
    try:
        until = time.monotonic() + 90
        while read_ledger(spark, Layout(root)).count() < 1 and time.monotonic() < until:
            time.sleep(1)
        assert query.isActive and values(spark, root) == [1]
        land(spark, f"{root}/in", [("t1", {"k": 3}, AT)])
        while len(values(spark, root)) < 2 and time.monotonic() < until:
            time.sleep(1)
        assert values(spark, root) == [1, 3] and {r["type"] for r in pending_manifest(spark, Layout(root)).collect()} == {"t2"}
    finally:
        query.stop()
