"""Randomised check of the coercion rules against a plain-Python model of
the Java parsers (Integer/Long.parseInt, Double.parseDouble, LocalDate.parse, Boolean.parseBoolean)."""

import datetime as dt
import json
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspur.functions.coerce import coerce

INT_RANGE = {"INT": (-2**31, 2**31 - 1), "LONG": (-2**63, 2**63 - 1)}


def model(value, data_type):
    """Expected (value, failed) for a JSON value (Python object)."""
    if value is None:
        return None, False
    if data_type in INT_RANGE:
        lo, hi = INT_RANGE[data_type]
        if isinstance(value, bool):
            return None, True
        if isinstance(value, (int, float)):
            v = int(value)  # truncation toward zero
            return (v, False) if lo <= v <= hi else (None, True)
        if isinstance(value, str) and re.fullmatch(r"[+-]?[0-9]+", value):
            v = int(value)
            return (v, False) if lo <= v <= hi else (None, True)
        return None, True
    if data_type == "BOOLEAN":
        if isinstance(value, bool):
            return value, False
        return (value.lower() == "true" if isinstance(value, str) else False), False
    if data_type == "DOUBLE":
        if isinstance(value, bool):
            return None, True
        if isinstance(value, (int, float)):
            return float(value), False
        if isinstance(value, str) and re.fullmatch(
            r"[ ]*[+-]?(NaN|Infinity|(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?)[fFdD]?)[ ]*", value
        ):
            return float(value.strip().rstrip("fFdD")), False
        return None, True
    if data_type == "DATE":
        if isinstance(value, str) and re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", value):
            try:
                return dt.date.fromisoformat(value), False
            except ValueError:
                return None, True
        return None, True
    raise AssertionError(data_type)


texts = st.text(alphabet="+-0123456789 .eTtRrUuEe", max_size=12)
dates = st.builds(lambda y, m, d: f"{y:04d}-{m:02d}-{d:02d}", st.integers(1, 9999), st.integers(0, 13), st.integers(0, 32))
values = st.one_of(
    st.none(), st.booleans(), texts, dates,
    st.integers(-2**70, 2**70),
    st.floats(-1e12, 1e12, allow_nan=False).map(lambda f: round(f, 3)),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(values, min_size=20, max_size=60))
def test_rules_match_model(spark, batch):
    rows = [(json.dumps({"x": v}),) for v in batch]
    df = spark.createDataFrame(rows, "j string").select(
        F.try_variant_get(F.parse_json("j"), "$['x']", "variant").alias("raw")
    )
    for data_type in ("INT", "LONG", "BOOLEAN", "DATE", "DOUBLE"):
        value, failed = coerce("raw", data_type)
        got = [(r["v"], r["f"]) for r in df.select(value.alias("v"), failed.alias("f")).collect()]
        for v, g in zip(batch, got):
            assert g == model(v, data_type), (data_type, v, g)
