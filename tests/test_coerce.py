"""Coercion rules (C1-C10) on the edge inputs of FIXTURES.md section 4."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larkspur.functions.coerce import coerce

CASES = {
    # type: [(json literal, expected value or "FAIL")]
    "INT": [("10", 10), ('"10"', 10), ('"+5"', 5), ('"-5"', -5), ("1.9", 1), ("-7.5", -7), ("1e3", 1000),
            ('" 5 "', "FAIL"), ('"1.5"', "FAIL"), ('"abc"', "FAIL"), ('""', "FAIL"), ("true", "FAIL"),
            ("3000000000", "FAIL"), ('{"a":1}', "FAIL"), ("null", None)],
    "LONG": [("3000000000", 3000000000), ('"-5"', -5), ("12345678901234567890", "FAIL"), ('"1.5"', "FAIL")],
    "BOOLEAN": [("true", True), ('"TRUE"', True), ('"yes"', False), ('"1"', False), ("0", False),
                ("false", False), ("null", None)],
    "DATE": [('"2026-06-04"', dt.date(2026, 6, 4)), ('"2026-6-4"', "FAIL"), ('"2026-02-30"', "FAIL"),
             ("20260604", "FAIL")],
    "TIMESTAMP": [('"2026-06-04T12:00"', dt.datetime(2026, 6, 4, 12, 0)),
                  ('"2026-06-04T12:00:00.5"', dt.datetime(2026, 6, 4, 12, 0, 0, 500000)),
                  ('"2026-06-04 12:00:00"', "FAIL"), ('"2026-06-04T12:00:00Z"', "FAIL")],
    "STRING": [("10", "10"), ("true", "true"), ('"x"', "x"), ("1e3", "1000.0"), ("10.0", "10.0"), ("0.00001", "1.0E-5"),
               ("123456789.125", "1.23456789125E8"), ("12345678901234567890", "12345678901234567890"), ("-7.50", "-7.5"), ('{"a":1}', '{"a":1}'),
               ("null", None)],
    "FLOAT": [('" 5 "', 5.0), ('"1.5f"', 1.5), ("1.5", 1.5), ('"abc"', "FAIL"), ("true", "FAIL")],
    "DOUBLE": [("9.5", 9.5), ('"1e3"', 1000.0), ('""', "FAIL")],
}


@pytest.mark.parametrize("data_type", sorted(CASES))
def test_coercion_rules(spark, data_type):
    rows = [('{"x": %s}' % lit,) for lit, _ in CASES[data_type]]
    df = spark.createDataFrame(rows, "j string").select(
        F.try_variant_get(F.parse_json("j"), "$['x']", "variant").alias("raw")
    )
    value, failed = coerce("raw", data_type)
    got = df.select(value.alias("v"), failed.alias("f")).collect()
    for (lit, expected), r in zip(CASES[data_type], got):
        if expected == "FAIL":
            assert r["f"] and r["v"] is None, (data_type, lit, r)
        else:
            assert not r["f"], (data_type, lit, r)
            assert r["v"] == expected, (data_type, lit, r["v"])


def test_missing_attribute_is_null_not_failure(spark):
    df = spark.createDataFrame([('{"y": 1}',)], "j string").select(
        F.try_variant_get(F.parse_json("j"), "$['x']", "variant").alias("raw")
    )
    value, failed = coerce("raw", "INT")
    r = df.select(value.alias("v"), failed.alias("f")).first()
    assert r["v"] is None and r["f"] is False
