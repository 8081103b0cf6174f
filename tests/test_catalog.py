"""Schema apply, diff and registry."""

import json
import os

import pytest

from larkspur.contract import MSG_SCHEMA_APPLIED, MSG_SCHEMA_NOT_FOUND
from larkspur.sources.catalog import (
    InvalidRequest,
    SchemaNotFound,
    apply_schema,
    distinct_buckets,
    handle_apply_request,
    live_tables,
    load_catalog,
)


def _write(dirpath, ns, table, fields, ptype="DAY"):
    os.makedirs(f"{dirpath}/{ns}", exist_ok=True)
    doc = {"namespace": ns, "tableName": table, "bucketName": f"{ns}-{table}", "partitionType": ptype,
           "fields": [{"id": 10 + i, "name": n, "dataType": t, "deprecated": False} for i, (n, t) in enumerate(fields)],
           "unknownProperty": 1}
    with open(f"{dirpath}/{ns}/{table}.json", "w") as f:
        json.dump(doc, f)


def test_create_evolve_and_no_change(spark, root, tmp_path):
    cat = str(tmp_path / "cat")
    _write(cat, "site", "page_actions", [("user_id", "STRING"), ("legacy_col", "STRING")])
    r = apply_schema(spark, cat, root, "site", "page_actions")
    assert r.created and r.version == 1 and r.message == MSG_SCHEMA_APPLIED
    _write(cat, "site", "page_actions",
           [("user_id", "STRING"), ("op_type", "LONG"), ("result", "DATE"), ("seen_at", "TIMESTAMP")], "HOUR")
    r = apply_schema(spark, cat, root, "site", "page_actions")
    assert (r.version, r.added, r.dropped) == (2, 3, 1)
    spec = live_tables(spark, root)[0]
    assert sorted(spec.field_names) == ["op_type", "result", "seen_at", "user_id"]
    assert spec.partition_type == "DAY"  # partition changes are not evolved
    r = apply_schema(spark, cat, root, "site", "page_actions")
    assert (r.version, r.added, r.dropped) == (2, 0, 0)


def test_type_change_is_ignored(spark, root, tmp_path):
    cat = str(tmp_path / "cat")
    _write(cat, "g", "t", [("user_id", "STRING")])
    apply_schema(spark, cat, root, "g", "t")
    _write(cat, "g", "t", [("user_id", "INT")])
    r = apply_schema(spark, cat, root, "g", "t")
    assert r.ignored == 1 and r.version == 1
    assert live_tables(spark, root)[0].fields[0][2] == "STRING"


def test_hourly_table_and_empty_fields(spark, root, tmp_path):
    cat = str(tmp_path / "cat")
    _write(cat, "g", "h", [("user_id", "INT")], "HOUR")
    _write(cat, "g", "e", [])
    apply_schema(spark, cat, root, "g", "h")
    apply_schema(spark, cat, root, "g", "e")
    specs = {s.table_name: s for s in live_tables(spark, root)}
    assert specs["h"].partition_columns == ["event_date", "event_hour"]
    assert specs["e"].fields == ()
    assert [f.name for f in specs["e"].struct().fields] == ["event_id", "tenant_id", "load_time", "event_time"]


def test_missing_file_and_blank_request(spark, root, tmp_path):
    with pytest.raises(SchemaNotFound):
        apply_schema(spark, str(tmp_path), root, "site", "nope")
    with pytest.raises(InvalidRequest):
        apply_schema(spark, str(tmp_path), root, "", "page_actions")
    assert handle_apply_request(spark, str(tmp_path), root, {"namespace": "site", "tableName": ""}) == MSG_SCHEMA_NOT_FOUND


def test_catalog_scan_and_locations(spark, tmp_path):
    cat = str(tmp_path / "cat")
    _write(cat, "a", "t1", [("x", "STRING")])
    _write(cat, "b", "t2", [("y", "INT")])
    df = load_catalog(spark, cat)
    assert df.count() == 2
    assert sorted(r["bucket_name"] for r in distinct_buckets(df).collect()) == ["a-t1", "b-t2"]


def test_apply_all_matches_single_applies(spark, root, tmp_path):
    from larkspur.sources.catalog import apply_all

    cat = str(tmp_path / "cat")
    _write(cat, "a", "t1", [("x", "STRING"), ("old", "INT")])
    _write(cat, "b", "t2", [("y", "INT")], "HOUR")
    res = apply_all(spark, cat, root)
    assert sorted((r.created, r.version) for r in res) == [(True, 1), (True, 1)]
    _write(cat, "a", "t1", [("x", "LONG"), ("new", "DATE")])
    res = apply_all(spark, cat, root)
    assert sorted((r.version, r.added, r.dropped, r.ignored) for r in res) == [(1, 0, 0, 0), (2, 1, 1, 1)]
    specs = {s.table_name: s for s in live_tables(spark, root)}
    assert [(n, t) for _, n, t in specs["t1"].fields] == [("x", "STRING"), ("new", "DATE")]
    assert specs["t2"].hourly
    assert apply_all(spark, cat, root)[0].version in (1, 2)


def test_ensure_namespace_creates_database_once(spark, root, tmp_path):
    from larkspur.sources.catalog import ensure_namespace

    cat = str(tmp_path / "cat")
    _write(cat, "ns_probe", "t", [("x", "STRING")])
    apply_schema(spark, cat, root, "ns_probe", "t", create_database=True)
    assert spark.catalog.databaseExists("ns_probe")
    assert ensure_namespace(spark, root, "ns_probe") is False
