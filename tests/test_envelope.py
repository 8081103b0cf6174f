"""Envelope decode/encode and the validation reasons."""

import datetime as dt

from pyspark.sql import functions as F

from larkspur.contract import RAW_SCHEMA
from larkspur.operators.validate import route
from larkspur.sources.catalog import PACKAGE_CATALOG, load_catalog, specs_from_catalog
from larkspur.sources.envelope import decode_envelope, encode_envelope, envelope_json

TS = dt.datetime(2025, 11, 20, 8, 45, 10)


def _raw(spark, values):
    return spark.createDataFrame(
        [(None, v, 0, i, TS) for i, v in enumerate(values)], RAW_SCHEMA
    )


def test_decode_reasons(spark):
    values = [
        '{"namespace":"site","type":"page_actions","tenantId":"north-7","eventTime":"2025-11-20 08:15:30","attributes":{"visitor":"V-1"}}',
        None,
        "",
        "null",
        "{",
        '{"namespace":"site","type":"","tenantId":"t1"}',
        '{"namespace":"site","type":"page_actions","tenantId":"t1","eventTime":"2025-11-20T08:15:30"}',
        '{"type":"page_actions","tenantId":"t1"}',
        '{"namespace":"site","type":"page_actions","tenantId":"t1","extra":{"a":1}}',
    ]
    got = {r["source_offset"]: r for r in decode_envelope(_raw(spark, values)).collect()}
    assert got[0]["reason"] is None
    assert got[0]["event_time"] == dt.datetime(2025, 11, 20, 8, 15, 30)
    assert [got[i]["reason"] for i in (1, 2, 3)] == ["null_event"] * 3
    assert got[4]["reason"] == "undecodable_envelope"
    assert got[5]["reason"] == "empty_type"
    assert got[6]["reason"] == "bad_event_time"
    assert got[7]["reason"] == "null_namespace"
    # unknown top-level field ignored; missing eventTime falls back to the record time
    assert got[8]["reason"] is None and got[8]["event_time"] == TS and got[8]["event_time_defaulted"]


def test_attributes_must_be_an_object(spark):
    shapes = ['{"k":1}', "{}", "null", '"text"', "[1]", "7", "true"]
    values = ['{"namespace":"site","type":"page_actions","tenantId":"t","attributes":%s}' % s for s in shapes]
    got = [r["reason"] for r in decode_envelope(_raw(spark, values)).orderBy("source_offset").collect()]
    assert got == [None] * 3 + ["undecodable_envelope"] * 4


def test_route_tenant_and_registration(spark):
    specs = specs_from_catalog(load_catalog(spark, PACKAGE_CATALOG))
    values = [
        '{"namespace":"site","type":"page_actions"}',
        '{"namespace":"site","type":"page_actions","tenantId":""}',
        '{"namespace":"site","type":"cart_events","tenantId":"t"}',
        '{"namespace":"site","type":" ","tenantId":"t"}',
    ]
    got = {r["source_offset"]: r["reason"] for r in route(decode_envelope(_raw(spark, values)), specs).collect()}
    assert got == {0: "null_tenant", 1: None, 2: "unregistered_type", 3: "unregistered_type"}


def test_encode_writes_text_time(spark):
    d = decode_envelope(_raw(spark, ['{"namespace":"g","type":"t","tenantId":"a","eventTime":"2025-11-20 08:15:30","attributes":{"k":1}}']))
    j = encode_envelope(d).first()["value"]
    assert '"eventTime":"2025-11-20 08:15:30"' in j and '"attributes":{"k":1}' in j
    again = decode_envelope(encode_envelope(d).withColumn("key", F.lit(None).cast("string"))).first()
    assert again["reason"] is None and again["event_time"] == dt.datetime(2025, 11, 20, 8, 15, 30)


def test_envelope_from_attributes_already_written(spark):
    values = [
        '{"namespace":"a}\\\\n","type":"t}","tenantId":"}","eventTime":"2024-01-01 00:00:00","attributes":{"z":1e3,"y":[1.50,{"q":null}]}}',
        '{"attributes":{}}', '{"attributes":null}', '{"type":"t"}', "{}", "{", None,
    ]
    d = decode_envelope(_raw(spark, values)).withColumn("text", F.to_json("attributes"))
    whole = F.to_json(F.struct("namespace", "type", F.col("tenant_id").alias("tenantId"),
                               F.substring(F.col("event_time").cast("string"), 1, 19).alias("eventTime"), "attributes"))
    rows = d.select(whole.alias("whole"), envelope_json(F.col("text")).alias("given"), envelope_json().alias("own")).collect()
    assert len(rows) == len(values)
    assert all(r["whole"] == r["given"] == r["own"] for r in rows), rows
