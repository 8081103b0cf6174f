"""Derived event log: the driver's ``events`` table re-expressed as the raw
records of an event topic (key, JSON value, partition, offset, timestamp).

Every row of ``events`` becomes one record, so all downstream work grows with
the table. The mapping (also written in the DuckDB oracle, see
``larkspur.plans.oracle``) is:

* partition = ``event_id % 3``, offset = ``event_id``, timestamp = ``ts``
* namespace ``security`` for ``error`` events, else ``site``
* type ``alarms`` (error), ``cart_events`` (purchase, no table),
  ``''`` for every 50th signup, ``' '`` for signups with ``event_id % 50 = 25``,
  else ``page_actions``
* tenant null when ``user_id % 37 = 0``, ``''`` when ``user_id % 41 = 0``,
  else ``acct-<user_id % 5 + 1>``
* eventTime text of ``ts``; ISO ``T`` form when ``event_id % 101 = 0``;
  missing when ``event_id % 211 = 0``; seven days early when
  ``event_id % 173 = 0`` (late data)
* attributes: ``visitor, action, outcome, k, amount, channel, address``,
  the typed keys ``count, total, ratio, score, active, day, seen_at, fault``
  and an undeclared ``session``. On every fourth event (``event_id % 4 = 0``)
  all typed keys carry the same probe value
  ``PROBES[(event_id div 4) % len(PROBES)]``; otherwise they carry valid
  values: count = k, total = user_id, ratio = score = value, active =
  ``event_id % 2 = 0``, day / seen_at = date / ISO text of ts, fault absent
* whole value replaced: cut JSON when ``event_id % 997 = 0``, empty when
  ``event_id % 499 = 0``, text ``null`` when ``event_id % 1499 = 0``; the
  namespace is JSON null when ``event_id % 89 = 0``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.times import format_event_time
from larkspur.session import settings_of

# --- fixed values: coercion edge inputs, as JSON literal text ---------------
PROBES = [
    '10', '"10"', '"+5"', '"-5"', '1.9', '" 5 "', '"1.5"', '"abc"', '""', 'true',
    '3000000000', '"TRUE"', '"yes"', '"1"', '0', '"2026-06-04"', '"2026-6-4"',
    '"2026-02-30"', '20260604', '"2026-06-04T12:00"', '"2026-06-04T12:00:00.5"',
    '"2026-06-04 12:00:00"', '"2026-06-04T12:00:00Z"', 'null', '{"a":1}', '[1,2]',
    '1e3', '"1.5f"', '"NaN"', '-7.5', '12345678901234567890', '10.0', '0.00001', '123456789.125',
]
# Attribute keys that carry the probe value.
PROBE_KEYS = ["count", "total", "ratio", "score", "active", "day", "seen_at", "fault"]
# ---------------------------------------------------------------------------


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _json_str(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def raw_records(events: DataFrame) -> DataFrame:
    """``events`` -> (key, value, source_partition, source_offset, source_ts)."""
    eid = F.col("event_id")
    etype = F.col("event_type")
    uid = F.col("user_id")
    ts = F.col("ts")

    namespace = F.when(etype == "error", "security").otherwise("site")
    type_ = (
        F.when(etype == "error", "alarms")
        .when(etype == "purchase", "cart_events")
        .when((etype == "signup") & (eid % 50 == 0), "")
        .when((etype == "signup") & (eid % 50 == 25), " ")
        .otherwise("page_actions")
    )
    tenant = (
        F.when(uid % 37 == 0, F.lit(None).cast("string"))
        .when(uid % 41 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("acct-"), (uid % 5 + 1).cast("string")))
    )
    shown_ts = F.when(eid % 173 == 0, ts - F.expr("INTERVAL 7 DAYS")).otherwise(ts)
    text_ts = format_event_time(shown_ts)
    event_time = (
        F.when(eid % 211 == 0, F.lit(None).cast("string"))
        .when(eid % 101 == 0, F.regexp_replace(text_ts, " ", "T"))
        .otherwise(text_ts)
    )
    probe = F.element_at(
        F.array(*[F.lit(p) for p in PROBES]), (F.floor(eid / 4) % len(PROBES) + 1).cast("int")
    )
    is_probe = eid % 4 == 0
    k_text = F.get_json_object("props", "$.k")
    natural = {
        "count": k_text,
        "total": uid.cast("string"),
        "ratio": F.col("value").cast("string"),
        "score": F.col("value").cast("string"),
        "active": F.when(eid % 2 == 0, F.lit("true")).otherwise(F.lit("false")),
        "day": _json_str(F.substring(ts.cast("string"), 1, 10)),
        "seen_at": _json_str(F.regexp_replace(F.substring(ts.cast("string"), 1, 19), " ", "T")),
        "fault": None,
    }

    def typed_key(key):
        if natural[key] is None:
            return F.when(is_probe, F.concat(F.lit(f',"{key}":'), probe)).otherwise(F.lit(""))
        return F.concat(F.lit(f',"{key}":'), F.when(is_probe, probe).otherwise(natural[key]))
    result = F.when(etype == "error", "refused").otherwise("done")

    attrs = F.concat(
        F.lit('{"visitor":'), _json_str(F.concat(F.lit("V-"), uid.cast("string"))),
        F.lit(',"action":'), _json_str(etype),
        F.lit(',"outcome":'), _json_str(result),
        F.lit(',"k":'), k_text,
        F.lit(',"amount":'), F.col("value").cast("string"),
        F.lit(',"channel":"web","address":'),
        _json_str(F.concat(F.lit("10.0.0."), (uid % 256).cast("string"))),
        *[typed_key(key) for key in PROBE_KEYS],
        F.lit(',"session":'), _json_str(F.concat(F.lit("S-"), (eid % 7).cast("string"))),
        F.lit("}"),
    )
    ns_json = F.when(eid % 89 == 0, F.lit("null")).otherwise(_json_str(namespace))
    body = F.concat(
        F.lit('{"namespace":'), ns_json,
        F.lit(',"type":'), _json_str(type_),
        F.when(tenant.isNull(), F.lit("")).otherwise(
            F.concat(F.lit(',"tenantId":'), _json_str(tenant))
        ),
        F.when(event_time.isNull(), F.lit("")).otherwise(
            F.concat(F.lit(',"eventTime":'), _json_str(event_time))
        ),
        F.lit(',"attributes":'), attrs,
        F.lit("}"),
    )
    value = (
        F.when(eid % 997 == 0, F.substring(body, 1, 25))
        .when(eid % 499 == 0, F.lit(""))
        .when(eid % 1499 == 0, F.lit("null"))
        .otherwise(body)
    )
    return events.select(
        tenant.alias("key"),
        value.alias("value"),
        (eid % 3).cast("int").alias("source_partition"),
        eid.alias("source_offset"),
        ts.alias("source_ts"),
    )


def fixture_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived log as a lazily computed DataFrame."""
    return raw_records(events_table(spark, sf_dir))


# Rows per landed file: bounds file size whatever the input size is.
LANDING_ROWS_PER_FILE = 1_000_000
_LANDED: dict = {}


def landed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived log written once as a Parquet table in the shared folder
    and read back - the shape real input has (topic partitions / landed
    files): many files, plain columns, parallel reads.

    Files are cut by offset range, ``defaultParallelism`` ranges at least.
    """
    from larkspur.session import work_root

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    path = _LANDED.get(key)
    if path is None:
        path = work_root(spark, "landing") + "/raw"
        n = max(2, spark.sparkContext.defaultParallelism * 2)
        # cut the narrow events rows by offset first (cheap sampling and
        # shuffle), then build the JSON text in parallel after the exchange
        rows = raw_records(events_table(spark, sf_dir).repartitionByRange(n, "event_id"))
        # one generated method for all of a record's text is too long for the JVM
        # to compile; without whole-stage code it is split
        with settings_of(spark, {"spark.sql.codegen.wholeStage": "false"}):
            rows.write.option("maxRecordsPerFile", LANDING_ROWS_PER_FILE).parquet(path)
        _LANDED[key] = path
    from larkspur.contract import RAW_SCHEMA

    return spark.read.schema(RAW_SCHEMA).parquet(path)
