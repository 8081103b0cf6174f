"""Event envelope decode / encode (A2, A3) and the first validation checks
(B1, B5, B6, V3).

``decode_envelope`` keeps every input row and adds a ``reason`` column that is
null for rows that may continue; callers split on it. Nothing is dropped
silently, so a batch is never lost because of one bad record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.contract import (
    ENVELOPE_DDL,
    R_BAD_EVENT_TIME,
    R_EMPTY_TYPE,
    R_NULL_EVENT,
    R_NULL_NAMESPACE,
    R_UNDECODABLE,
)
from larkspur.functions.times import format_event_time, parse_event_time

_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def decode_reason(env: Column, value: Column, event_time: Column, shapeless: Column) -> Column:
    """First failing check of the envelope, or null."""
    return (
        F.when(value.isNull() | (F.trim(value) == "") | (F.trim(value) == "null"), F.lit(R_NULL_EVENT))
        .when(env["_corrupt"].isNotNull() | shapeless, F.lit(R_UNDECODABLE))
        .when(env["eventTime"].isNotNull() & event_time.isNull(), F.lit(R_BAD_EVENT_TIME))
        .when(env["type"].isNull() | (env["type"] == ""), F.lit(R_EMPTY_TYPE))
        .when(env["namespace"].isNull(), F.lit(R_NULL_NAMESPACE))
    )


def decode_envelope(raw: DataFrame, default_time: Column | None = None) -> DataFrame:
    """Raw records -> envelope columns + ``reason``.

    Output columns: the raw position columns, ``value``, ``namespace``,
    ``type``, ``tenant_id``, ``event_time`` (TIMESTAMP_NTZ), ``event_time_defaulted``,
    ``attributes`` (VARIANT) and ``reason``.

    A missing eventTime falls back to ``default_time`` (default: the record's
    ``source_ts``), so replays of the same record keep the same time.
    """
    if default_time is None:
        default_time = F.col("source_ts")
    env = F.from_json(F.col("value"), ENVELOPE_DDL, _JSON_OPTIONS)
    # The parse sits in a one-element generator: filters on its fields (a
    # table's namespace/type) then stay above it instead of being pushed
    # below with a copy of the parse, so each record is parsed exactly once.
    parsed = raw.select("*", F.inline(F.array(F.struct(env.alias("_env")))))
    e = F.col("_env")
    parsed_time = parse_event_time(e["eventTime"])
    value = F.col("value")
    # attributes must be an object (or null): text, numbers and arrays have no keys
    shapeless = (
        e["attributes"].isNotNull() & ~F.is_variant_null(e["attributes"])
        # an object has a struct, whatever its keys; looking for one key builds nothing
        & F.try_variant_get(e["attributes"], "$", "struct<_:variant>").isNull()
    )
    decodable = ~(value.isNull() | (F.trim(value) == "") | (F.trim(value) == "null")) & e["_corrupt"].isNull()
    return parsed.select(
        *[c for c in raw.columns],
        e["namespace"].alias("namespace"),
        e["type"].alias("type"),
        e["tenantId"].alias("tenant_id"),
        F.when(
            decodable,
            F.coalesce(parsed_time, F.when(e["eventTime"].isNull(), default_time.cast("timestamp_ntz"))),
        ).alias("event_time"),
        (decodable & e["eventTime"].isNull()).alias("event_time_defaulted"),
        e["attributes"].alias("attributes"),
        decode_reason(e, F.col("value"), parsed_time, shapeless).alias("reason"),
    )


def envelope_json(attributes: Column | None = None) -> Column:
    """JSON text of the decoded envelope columns (A3).

    Times are written as ``yyyy-MM-dd HH:mm:ss`` text, not epoch numbers;
    null fields are left out. ``attributes`` is the JSON text of that column,
    where a caller has it already: writing a VARIANT costs more than the rest.
    """
    attributes = F.to_json("attributes") if attributes is None else attributes
    head = F.to_json(
        F.struct(
            F.col("namespace").alias("namespace"),
            F.col("type").alias("type"),
            F.col("tenant_id").alias("tenantId"),
            format_event_time(F.col("event_time")).alias("eventTime"),
        )
    )
    # attributes come last, in place of the closing brace
    opened = F.when(head == "{}", F.lit("{")).otherwise(F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(",")))
    return F.when(attributes.isNull(), head).otherwise(F.concat(opened, F.lit('"attributes":'), attributes, F.lit("}")))


def encode_envelope(events: DataFrame) -> DataFrame:
    """Decoded events -> raw records with the envelope as JSON text (A3)."""
    return events.select(
        envelope_json().alias("value"),
        *[c for c in ("source_partition", "source_offset", "source_ts") if c in events.columns],
    )
