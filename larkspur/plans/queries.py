"""Registered queries. Each takes ``(spark, sf_dir)`` and returns a DataFrame
computed from the driver's tables (the ``events`` log, through the derived
envelope) over their whole extent. Column names match the oracle SQL in
``larkspur.plans.oracle``.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.contract import R_COERCION, SPARK_TYPES, Layout
from larkspur.functions.coerce import attribute, failed_sql, kind_sql, text_sql, value_sql
from larkspur.operators.compaction import merge_pending, pending_manifest_as_of, valid_manifest
from larkspur.operators.grouping import assign_groups, group_sizes
from larkspur.operators.ingest import ingest
from larkspur.operators.packing import packed
from larkspur.operators.project import project_typed, unknown_attributes
from larkspur.operators.publish import cleanup_candidates, freshness, guard_reason, read_ledger
from larkspur.operators.read import read_table, register_views
from larkspur.operators.retry import retry_quarantine
from larkspur.operators.staging import read_manifest, read_quarantine, staged_rows
from larkspur.operators.tables import function_name, sync_tables, table_name
from larkspur.operators.validate import route
from larkspur.plans.lake import GROUP_RECORDS, OFFSETS_PER_BATCH, SETTINGS, build_lake, build_readded, build_shared_bucket, raw_batches
from larkspur.session import work_root
from larkspur.sources.catalog import (
    PACKAGE_CATALOG,
    apply_all,
    catalog_fields,
    latest_registry,
    load_catalog,
    live_tables,
    registry,
    schema_diff,
    specs_from_catalog,
)
from larkspur.functions.times import format_event_time
from larkspur.sources.envelope import decode_envelope, envelope_json
from tools.event_log import landed_records

STATUS_OK = "accepted"


def _specs(spark):
    return specs_from_catalog(load_catalog(spark, PACKAGE_CATALOG))


def _routed(spark, sf_dir):
    return route(decode_envelope(raw_batches(spark, sf_dir)), _specs(spark))


def _typed_all(spark, sf_dir) -> DataFrame:
    """Accepted rows of every table with the columns shared by both."""
    routed = _routed(spark, sf_dir)
    cols = ["namespace", "type", "event_time", "tenant_id", "k", "amount", "count", "day", "seen_at"]
    out = None
    for spec in _specs(spark):
        t = project_typed(routed, spec)
        t = t.where(F.col("reason").isNull()).select(
            *[F.col(c).cast("bigint").alias(c) if c in ("k", "amount", "count") else F.col(c) for c in cols]
        )
        out = t if out is None else out.unionByName(t)
    return out


# --- envelope and validation -------------------------------------------------

def q_rejected_events(spark, sf_dir):
    """Every record by outcome."""
    r = _routed(spark, sf_dir)
    return r.groupBy(F.coalesce("reason", F.lit(STATUS_OK)).alias("status")).agg(
        F.count(F.lit(1)).alias("n")
    )


def q_valid_events(spark, sf_dir):
    """Routed events per table and day."""
    r = _routed(spark, sf_dir).where(F.col("reason").isNull())
    return r.groupBy("namespace", "type", F.to_date("event_time").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("event_time_defaulted").cast("int")).cast("bigint").alias("n_defaulted_time"),
        F.sum((F.col("tenant_id") == "").cast("int")).cast("bigint").alias("n_empty_tenant"),
    )


def q_event_time_parse(spark, sf_dir):
    """Decoded event times per day."""
    d = decode_envelope(raw_batches(spark, sf_dir)).where(F.col("event_time").isNotNull())
    return d.groupBy(F.to_date("event_time").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("event_time_defaulted").cast("int")).cast("bigint").alias("n_defaulted"),
        F.min("event_time").alias("first_time"),
        F.max("event_time").alias("last_time"),
    )


def q_unregistered_types(spark, sf_dir):
    """Events whose (namespace, type) has no table."""
    r = _routed(spark, sf_dir).where(F.col("reason") == "unregistered_type")
    return r.groupBy("namespace", "type").agg(F.count(F.lit(1)).alias("n"))


def q_envelope_roundtrip(spark, sf_dir):
    """A3: decode -> encode -> decode keeps every decodable envelope.

    Row by row: the re-encoded text is decoded in the same pass, no join."""
    d = decode_envelope(raw_batches(spark, sf_dir)).where(
        F.col("reason").isNull() | F.col("reason").isin("empty_type", "null_namespace")
    )
    fields = ("namespace", "type", "tenant_id", "event_time")
    # the attributes are written once, for the envelope and to compare with. The
    # one-element generator keeps later steps from writing them again
    text = F.inline(F.array(F.struct(F.to_json("attributes").alias("a_attributes"))))
    d = d.select("source_partition", "source_offset", "source_ts", *fields, text)
    first = d.select(
        "source_partition", "source_offset", "source_ts",
        *[F.col(c).alias(f"a_{c}") for c in fields],
        "a_attributes",
        envelope_json(F.col("a_attributes")).alias("value"),
    )
    again = decode_envelope(first)
    same = (
        F.col("a_namespace").eqNullSafe(F.col("namespace"))
        & F.col("a_type").eqNullSafe(F.col("type"))
        & F.col("a_tenant_id").eqNullSafe(F.col("tenant_id"))
        & (format_event_time(F.col("a_event_time")) == format_event_time(F.col("event_time")))
        # numbers may change encoding (1e3 -> 1000.0) but not value: canonical JSON
        # is compared where the texts differ
        & ((F.col("a_attributes") == F.col("b_attributes")) | (F.to_json(F.parse_json("a_attributes")) == F.col("b_attributes")))
    )
    again = again.select("*", F.inline(F.array(F.struct(F.to_json("attributes").alias("b_attributes")))))
    return again.groupBy(F.when(same, "same").otherwise("changed").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n")
    )


# --- coercion ---------------------------------------------------------------------

def q_typed_projection(spark, sf_dir):
    """Accepted rows of both tables per day."""
    t = _typed_all(spark, sf_dir)
    return t.groupBy("namespace", "type", F.to_date("event_time").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("k"), F.lit(0)).cast("bigint").alias("sum_k"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast("bigint").alias("sum_amount"),
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("sum_count"),
        F.count("day").alias("n_day"),
        F.count("seen_at").alias("n_seen_at"),
        F.count_distinct("tenant_id").alias("n_tenants"),
    )


def _exact(value, dt):
    """Text of a coerced value; 9 digits tell any two floats apart, 15 any two
    doubles of decimal texts of that length."""
    if dt in ("FLOAT", "DOUBLE"):
        digits = "%.8e" if dt == "FLOAT" else "%.14e"
        return F.when(F.isnan(value), F.lit("NaN")).when(value.isNotNull(), F.format_string(digits, value.cast("double")))
    return value.cast("string")


def q_coerce_values(spark, sf_dir):
    """Every declared attribute of every accepted row of both tables,
    coerced: how often each raw text became which value, or failed. In the raw
    text a number with a fraction or exponent is written as a Java double."""
    r = _routed(spark, sf_dir).where(F.col("reason").isNull())
    # the attributes' own texts: a VARIANT shows 10.0 as 10
    written = F.from_json("value", "attributes map<string, string>")["attributes"]
    cells = None
    for spec in _specs(spark):
        mine = F.array(*[
            F.struct(F.lit(name).alias("column_name"), F.lit(dt).alias("data_type"),
                     attribute("attributes", name).alias("a"), F.col("written")[name].alias("w"))
            for _, name, dt in spec.fields
        ])
        is_mine = (F.col("namespace") == spec.namespace) & (F.col("type") == spec.table_name)
        cells = F.when(is_mine, mine) if cells is None else cells.when(is_mine, mine)
    r = r.select("namespace", "type", "attributes", written.alias("written"))
    r = r.select("namespace", "type", F.explode(cells).alias("c")).select("namespace", "type", "c.*")
    r = r.select("*", F.expr(kind_sql("a")).alias("k"), F.expr(text_sql("a")).alias("t"))
    raw = F.when(F.col("a").isNull(), F.lit(None)).when(F.col("k") == "ST", F.to_json("a")).otherwise(F.coalesce("w", F.lit("null")))
    text = failed = None
    for dt in SPARK_TYPES:
        value = value_sql("a", dt, "k", "t")
        is_dt = F.col("data_type") == dt
        one, bad = _exact(F.expr(value), dt), F.expr(failed_sql("k", value))
        text, failed = (F.when(is_dt, one), F.when(is_dt, bad)) if text is None else (text.when(is_dt, one), failed.when(is_dt, bad))
    r = r.select("namespace", "type", "column_name", "data_type", raw.alias("raw_text"), text.alias("value_text"), failed.alias("failed"))
    return r.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("n"))


def q_coerce_matrix(spark, sf_dir):
    """What became of the values of each declared column, over every
    accepted row of both tables."""
    c = q_coerce_values(spark, sf_dir)
    kept = F.col("value_text").isNotNull()
    return c.groupBy("namespace", "type", "column_name", "data_type").agg(
        F.sum("n").cast("bigint").alias("n"),
        F.sum(F.when(F.col("failed"), F.col("n")).otherwise(0)).cast("bigint").alias("n_failed"),
        F.sum(F.when(kept, F.col("n")).otherwise(0)).cast("bigint").alias("n_values"),
        F.count_distinct("value_text").alias("n_distinct"),
    )


def q_coercion_quarantine(spark, sf_dir):
    """Failed columns of quarantined rows."""
    routed = _routed(spark, sf_dir)
    out = None
    for spec in _specs(spark):
        t = project_typed(routed, spec).where(F.col("reason") == R_COERCION).select(
            "namespace", "type", F.explode(F.split("detail", ",")).alias("column_name")
        )
        out = t if out is None else out.unionByName(t)
    return out.groupBy("namespace", "type", "column_name").agg(F.count(F.lit(1)).alias("n"))


def q_unknown_attributes(spark, sf_dir):
    """Attribute keys no declared column picks up."""
    routed = _routed(spark, sf_dir).where(F.col("reason").isNull())
    declared = catalog_fields(load_catalog(spark, PACKAGE_CATALOG)).select("namespace", "table_name", "name")
    return unknown_attributes(routed, declared).groupBy("namespace", "type", "attribute").agg(
        F.count(F.lit(1)).alias("n")
    )


# --- grouping -------------------------------------------------------------------------

def _decoded_for_grouping(spark, sf_dir):
    return decode_envelope(raw_batches(spark, sf_dir)).where(F.col("reason").isNull())


def q_group_sizes(spark, sf_dir):
    """Count-bounded groups per key and source partition."""
    g = assign_groups(_decoded_for_grouping(spark, sf_dir), GROUP_RECORDS)
    return group_sizes(g)


def q_group_batches(spark, sf_dir):
    """The group of every event (arrival order within its key)."""
    g = assign_groups(_decoded_for_grouping(spark, sf_dir), GROUP_RECORDS)
    return g.select("namespace", "type", "source_partition", "source_offset", "group_seq")


def q_commit_guard(spark, sf_dir):
    """Groups as candidate manifest rows, checked by the commit guard."""
    g = assign_groups(_routed_for_groups(spark, sf_dir), GROUP_RECORDS)
    cand = g.groupBy("namespace", "type", "source_partition", "group_seq").agg(
        F.sum(F.col("reason").isNull().cast("int")).cast("bigint").alias("total_records"),
        F.sum(F.when(F.col("reason").isNull(), F.length("value")).otherwise(0)).cast("bigint").alias("length"),
    ).withColumn("location", F.concat_ws("/", "namespace", "type", "source_partition", "group_seq"))
    return cand.groupBy("namespace", "type", F.coalesce(guard_reason(), F.lit("commit")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum("total_records").cast("bigint").alias("total_records")
    )


def _routed_for_groups(spark, sf_dir):
    d = decode_envelope(raw_batches(spark, sf_dir)).where(F.col("reason").isNull())
    return route(d, _specs(spark)).select("namespace", "type", "source_partition", "source_offset", "value", "reason")


# --- staging, merge, commit, read --------------------------------------------------------

def q_staged_manifest(spark, sf_dir):
    """Staged rows per table and batch (first batch replayed)."""
    lake = build_lake(spark, sf_dir)
    m = read_manifest(spark, lake.layout)
    return m.groupBy("namespace", "type", "batch_id").agg(
        F.sum("total_records").cast("bigint").alias("total_records"),
        (F.min("length") > 0).alias("has_bytes"),
    )


def q_replay_idempotent(spark, sf_dir):
    """Staged files re-read; a replayed batch counts once."""
    lake = build_lake(spark, sf_dir)
    out = None
    for spec in lake.specs:
        s = staged_rows(spark, spec, lake.layout)
        s = s.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_ids"))
        s = s.select(F.lit(spec.namespace).alias("namespace"), F.lit(spec.table_name).alias("type"), "*")
        out = s if out is None else out.unionByName(s)
    return out


def q_merge_totals(spark, sf_dir):
    """Ledger totals per table."""
    lake = build_lake(spark, sf_dir)
    led = read_ledger(spark, lake.layout)
    return led.groupBy("namespace", "type").agg(
        F.count(F.lit(1)).alias("n_merges"),
        F.sum("total_records").cast("bigint").alias("total_records"),
        F.sum(F.size("child_batches")).cast("bigint").alias("n_child_batches"),
        F.sum((F.col("length") > 0).cast("int")).cast("bigint").alias("n_with_bytes"),
    )


def q_merge_roundtrip(spark, sf_dir):
    """Committed rows equal staged rows, per table and day."""
    lake = build_lake(spark, sf_dir)
    out = None
    for spec in lake.specs:
        t = read_table(spark, lake.root, spec).groupBy("event_date").agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).cast("bigint").alias("sum_k")
        ).select(F.lit(spec.namespace).alias("namespace"), F.lit(spec.table_name).alias("type"), "*")
        out = t if out is None else out.unionByName(t)
    return out


def q_pending_files(spark, sf_dir):
    """Staged files not covered by the ledger as of the first round."""
    lake = build_lake(spark, sf_dir)
    p = pending_manifest_as_of(spark, lake.layout, lake.first_round)
    return p.groupBy("namespace", "type").agg(
        F.count_distinct("batch_id").alias("n_batches"),
        F.sum("total_records").cast("bigint").alias("total_records"),
    )


def q_cleanup_candidates(spark, sf_dir):
    """Staged files whose batch is committed (report only)."""
    lake = build_lake(spark, sf_dir)
    c = cleanup_candidates(spark, lake.layout)
    return c.groupBy("namespace", "type").agg(
        F.count_distinct("batch_id").alias("n_batches"),
        F.sum("total_records").cast("bigint").alias("total_records"),
    )


def q_partition_day(spark, sf_dir):
    """Daily layout of page_actions."""
    lake = build_lake(spark, sf_dir)
    t = read_table(spark, lake.root, lake.spec("page_actions"))
    return t.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


def q_partition_hour(spark, sf_dir):
    """Hourly layout of alarms."""
    lake = build_lake(spark, sf_dir)
    t = read_table(spark, lake.root, lake.spec("alarms"))
    return t.groupBy("event_date", "event_hour").agg(F.count(F.lit(1)).alias("n"))


def q_time_range_read(spark, sf_dir):
    """One week of page_actions, pruned by derived event_date."""
    lake = build_lake(spark, sf_dir)
    t = read_table(spark, lake.root, lake.spec("page_actions"), start="2024-01-10", end="2024-01-17")
    return t.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).cast("bigint").alias("sum_k")
    )


def q_as_of_read(spark, sf_dir):
    """page_actions as of the first commit round."""
    lake = build_lake(spark, sf_dir)
    t = read_table(spark, lake.root, lake.spec("page_actions"), as_of=lake.first_round)
    return t.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


def q_late_events(spark, sf_dir):
    """Events older than the log's first day land in their own dates."""
    lake = build_lake(spark, sf_dir)
    out = None
    for spec in lake.specs:
        t = read_table(spark, lake.root, spec, end="2024-01-01").groupBy("event_date").agg(
            F.count(F.lit(1)).alias("n")
        ).select(F.lit(spec.table_name).alias("type"), "*")
        out = t if out is None else out.unionByName(t)
    return out


def q_ulid_shape(spark, sf_dir):
    """Event ids are distinct 26-character Crockford base-32 text whose
    time part orders like event_time."""
    lake = build_lake(spark, sf_dir)
    out = None
    for spec in lake.specs:
        t = read_table(spark, lake.root, spec).agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("event_id").alias("n_distinct"),
            F.sum(F.col("event_id").rlike("^[0-9A-HJKMNP-TV-Z]{26}$").cast("int")).cast("bigint").alias("n_valid"),
            # the time part names the millisecond: as many as there are event times, and in their order
            F.count_distinct(F.substring("event_id", 1, 10)).alias("n_times"),
            (F.min_by(F.substring("event_id", 1, 10), "event_time") == F.min(F.substring("event_id", 1, 10))).alias("first_is_least"),
            (F.max_by(F.substring("event_id", 1, 10), "event_time") == F.max(F.substring("event_id", 1, 10))).alias("last_is_greatest"),
        ).select(F.lit(spec.table_name).alias("type"), "*")
        out = t if out is None else out.unionByName(t)
    return out


def q_distinct_locations(spark, sf_dir):
    """Table locations that hold committed rows."""
    lake = build_lake(spark, sf_dir)
    led = read_ledger(spark, lake.layout)
    cat = load_catalog(spark, PACKAGE_CATALOG).select(
        "namespace", F.col("tableName").alias("type"), F.col("bucketName").alias("bucket_name")
    )
    # one catalog row per declared table: bounded by configuration
    return led.join(F.broadcast(cat), ["namespace", "type"]).groupBy("bucket_name").agg(
        F.sum("total_records").cast("bigint").alias("total_records")
    )


def q_evolved_read(spark, sf_dir):
    """After adding session and dropping fault mid-stream, old
    files read session as null and fault is gone."""
    lake = build_lake(spark, sf_dir, "evolve")
    spec = lake.spec("page_actions")
    t = read_table(spark, lake.root, spec)
    return t.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("session").alias("n_session"),
        F.lit("fault" in t.columns).alias("has_error_column"),
    )


def q_schema_changes(spark, sf_dir):
    """Changes between the applied v1 schema of page_actions and
    its v2 declaration, with how many of its events carry each attribute."""
    lake = build_lake(spark, sf_dir, "evolve")
    v1 = registry(spark, lake.root).where(
        "namespace = 'site' and table_name = 'page_actions' and version = 1"
    ).select("namespace", "table_name", "name", "data_type")
    decl = catalog_fields(load_catalog(spark, f"{PACKAGE_CATALOG}_v2")).where(
        "table_name = 'page_actions'"
    ).select("namespace", "table_name", "name", "data_type")
    diff = schema_diff(decl, v1)
    names = sorted(r["name"] for r in diff.select("name").distinct().collect())  # a few column names
    routed = _routed(spark, sf_dir).where((F.col("type") == "page_actions") & F.col("reason").isNull())
    present = routed.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), attribute("attributes", n).isNotNull().alias("p")) for n in names
    ])).alias("x")).groupBy("x.name").agg(F.sum(F.col("x.p").cast("int")).cast("bigint").alias("n_events"))
    version = latest_registry(spark, lake.root).where("table_name = 'page_actions'").agg(
        F.max("version").alias("v")
    ).first()["v"]  # one scalar from the registry
    return diff.join(present, "name", "left").select(
        "namespace", "table_name", "name", "change", "data_type",
        F.coalesce("n_events", F.lit(0)).cast("bigint").alias("n_events"),
        F.lit(version).cast("int").alias("live_version"),
    )


def _schema_change(change):
    def q(spark, sf_dir):
        return q_schema_changes(spark, sf_dir).where(F.col("change") == change)
    q.__doc__ = f"J3/J4/H9: schema diff rows of kind {change!r}."
    return q


q_schema_add_columns = _schema_change("add")
q_schema_drop_columns = _schema_change("drop")
q_schema_ignored_changes = _schema_change("ignored")


def q_stream_equals_batch(spark, sf_dir):
    """The streaming ingest (availableNow, several micro-batches)
    commits the same rows as the batch build."""
    from larkspur.streaming.ingest import final_merge, run_ingest
    from larkspur.sources.stream import file_source

    root = work_root(spark, "stream")
    apply_all(spark, PACKAGE_CATALOG, root)
    landing = f"{root}/landing"
    # 32 landed files read 8 per trigger: four micro-batches of several tasks each
    landed_records(spark, sf_dir).repartitionByRange(32, "source_offset").write.parquet(landing)
    q = run_ingest(
        file_source(spark, landing, max_files_per_trigger=8), root, f"{root}/_checkpoint",
        SETTINGS, trigger={"availableNow": True},
    )
    q.awaitTermination()
    final_merge(spark, root, SETTINGS)
    out = None
    for spec in live_tables(spark, root):
        t = read_table(spark, root, spec).groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(spec.table_name).alias("type"), "*"
        )
        out = t if out is None else out.unionByName(t)
    return out


def q_quarantine_report(spark, sf_dir):
    """The quarantine table of the lake, per reason and table."""
    lake = build_lake(spark, sf_dir)
    q = read_quarantine(spark, lake.layout)
    return q.groupBy("reason", "namespace", "type").agg(
        F.count(F.lit(1)).alias("n"), F.count("detail").alias("n_detail")
    )


def q_sql_view_read(spark, sf_dir):
    """SQL over the committed table through a registered view."""
    lake = build_lake(spark, sf_dir)
    names = register_views(spark, lake.root, lake.specs)
    view = names[("site", "page_actions")]
    return spark.sql(f"""
        SELECT tenant_id, count(*) AS n, CAST(coalesce(sum(k), 0) AS BIGINT) AS sum_k,
               count(DISTINCT event_date) AS n_days
        FROM {view}
        WHERE event_date BETWEEN DATE'2024-01-05' AND DATE'2024-01-19'
          AND event_time >= TIMESTAMP_NTZ'2024-01-05 00:00:00'
          AND event_time <  TIMESTAMP_NTZ'2024-01-20 00:00:00'
        GROUP BY tenant_id""")


def q_freshness(spark, sf_dir):
    """Merges of each table, and that no row was loaded after its
    commit (the lag itself is wall-clock time)."""
    lake = build_lake(spark, sf_dir)
    return freshness(spark, lake.layout).select(
        "namespace", "type", "n_merges", (F.col("max_lag_seconds") >= -1).alias("lag_is_sound"))


def q_shared_location(spark, sf_dir):
    """A5 K7: two tables in one bucket keep their own rows."""
    lake = build_shared_bucket(spark, sf_dir)
    out = None
    for spec in lake.specs:
        t = read_table(spark, lake.root, spec).groupBy("event_date").agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).cast("bigint").alias("sum_k"),
            F.count_distinct("tenant_id").alias("n_tenants"),
        ).select(F.lit(spec.table_name).alias("type"), F.lit(spec.bucket_name).alias("bucket_name"), "*")
        out = t if out is None else out.unionByName(t)
    return out


def q_readd_column(spark, sf_dir):
    """H6 H7 K1: a column that was dropped and declared again holds only what
    came after it came back."""
    lake = build_readded(spark, sf_dir)
    return read_table(spark, lake.root, lake.spec("page_actions")).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.count("fault").alias("n_fault"))


def q_manifest_validity(spark, sf_dir):
    """The lake's manifest beside copies with a blank or missing field;
    only the rows as they were pass."""
    m = read_manifest(spark, build_lake(spark, sf_dir).layout)
    blank = [m.withColumn(c, F.lit(v)) for c, v in (("location", " "), ("type", ""), ("namespace", None))]
    every = m
    for b in blank:
        every = every.unionByName(b)
    return valid_manifest(every).groupBy("namespace", "type").agg(F.sum("total_records").cast("bigint").alias("total_records"))


def q_two_sources_ingest(spark, sf_dir):
    """Two logs ingested into one lake, each with its own checkpoint:
    all rows of both arrive, with ids of their own."""
    from larkspur.streaming.ingest import final_merge, run_ingest
    from larkspur.sources.stream import file_source

    root = work_root(spark, "two-sources")
    apply_all(spark, PACKAGE_CATALOG, root)
    raw = landed_records(spark, sf_dir)
    for name, rows in (("even", raw.where("source_offset % 2 = 0")), ("odd", raw.where("source_offset % 2 = 1"))):
        rows.withColumn("source_offset", F.floor(F.col("source_offset") / 2)).write.parquet(f"{root}/landing/{name}")
        run_ingest(file_source(spark, f"{root}/landing/{name}", name=name), root, f"{root}/_checkpoint/{name}",
                   SETTINGS, trigger={"availableNow": True}).awaitTermination()
    final_merge(spark, root, SETTINGS)
    out = None
    for spec in live_tables(spark, root):
        t = read_table(spark, root, spec).groupBy("event_date").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_ids")
        ).select(F.lit(spec.table_name).alias("type"), "*")
        out = t if out is None else out.unionByName(t)
    return out


# --- keyed buffer, manifest stream, catalog tables, retry ------------------------------

def q_buffer_groups(spark, sf_dir):
    """The log through the keyed buffer as a stream: groups that
    closed by count, and what still waits in the state of each key."""
    from larkspur.sources.stream import file_source
    from larkspur.streaming.buffer import KEY, drain, grouped_events, waiting_events

    root = work_root(spark, "buffer")
    raw = landed_records(spark, sf_dir)
    raw.repartitionByRange(32, "source_offset").write.parquet(f"{root}/landing")
    source = file_source(spark, f"{root}/landing", max_files_per_trigger=16)
    valid = decode_envelope(source).where(F.col("reason").isNull()).select(*source.columns)
    settings = replace(SETTINGS, max_buffer_time="PT1H")
    query = (
        grouped_events(valid, settings).writeStream.outputMode("append").format("parquet").option("path", f"{root}/groups")
        .option("checkpointLocation", f"{root}/_checkpoint").trigger(processingTime="1 second").start()
    )
    drain(query)
    span = [F.count(F.lit(1)).alias("n_events"), F.min("source_offset").alias("first_offset"), F.max("source_offset").alias("last_offset")]
    closed = spark.read.parquet(f"{root}/groups").groupBy(*KEY, "group_seq", "closed_by").agg(*span)
    number = closed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("group_seq"))
    waiting = waiting_events(spark, f"{root}/_checkpoint").groupBy(*KEY).agg(*span).join(number, KEY, "left")
    waiting = waiting.withColumn("group_seq", F.coalesce("group_seq", F.lit(0)).cast("bigint")).withColumn("closed_by", F.lit("waiting"))
    return closed.unionByName(waiting.select(closed.columns))


def q_manifest_stream(spark, sf_dir):
    """Merges by a streaming query over the manifest: two rounds of
    batches, each merged by a run that reads only what is new."""
    from larkspur.streaming.merges import run_merges

    root = work_root(spark, "manifest-stream")
    apply_all(spark, PACKAGE_CATALOG, root)
    raw, specs = raw_batches(spark, sf_dir), live_tables(spark, root)
    n = int(raw.agg(F.max("source_offset").alias("m")).first()["m"] or 0) // OFFSETS_PER_BATCH + 1
    cut = n // 2 * OFFSETS_PER_BATCH
    for part in (raw.where(F.col("source_offset") < cut), raw.where(F.col("source_offset") >= cut)):
        ingest(spark, part, root, specs, SETTINGS)
        run_merges(spark, root, f"{root}/_merges", SETTINGS, {"availableNow": True}).awaitTermination()
    return read_ledger(spark, Layout(root)).groupBy("namespace", "type").agg(
        F.count(F.lit(1)).alias("n_merges"), F.sum("total_records").cast("bigint").alias("total_records"),
        F.sum(F.size("child_batches")).cast("bigint").alias("n_child_batches"),
    )


_PREFIXES: dict = {}


def _published(spark, sf_dir):
    """The lake's committed merges in Spark's catalog, in databases of its own."""
    lake = build_lake(spark, sf_dir)
    if lake.root not in _PREFIXES:
        prefix = f"lake{uuid.uuid4().hex[:8]}_"
        sync_tables(spark, lake.layout, lake.specs, prefix)
        _PREFIXES[lake.root] = prefix
    return lake, _PREFIXES[lake.root]


def q_catalog_read(spark, sf_dir):
    """Another session reads a committed table by its name."""
    lake, prefix = _published(spark, sf_dir)
    name = table_name(lake.spec("page_actions"), prefix)
    return spark.newSession().sql(f"""
        SELECT event_date, count(*) AS n, CAST(coalesce(sum(k), 0) AS BIGINT) AS sum_k, count(DISTINCT event_id) AS n_ids
        FROM {name} GROUP BY event_date""")


def q_sql_between(spark, sf_dir):
    """K2: SQL table functions that prune folders by event time alone."""
    lake, prefix = _published(spark, sf_dir)
    actions, alarms = (function_name(lake.spec(t), prefix) for t in ("page_actions", "alarms"))
    return spark.sql(f"""
        SELECT 'page_actions' AS type, event_date, count(*) AS n, CAST(coalesce(sum(k), 0) AS BIGINT) AS sum_k
        FROM {actions}(TIMESTAMP_NTZ'2024-01-10 00:00:00', TIMESTAMP_NTZ'2024-01-17 00:00:00') GROUP BY event_date
        UNION ALL
        SELECT 'alarms', event_date, count(*), CAST(coalesce(sum(k), 0) AS BIGINT)
        FROM {alarms}(TIMESTAMP_NTZ'2024-01-10 06:00:00', TIMESTAMP_NTZ'2024-01-12 18:30:00') GROUP BY event_date""")


#: Records of a rewrite group of staged units.
PACK_RECORDS = 3000


def q_packed_units(spark, sf_dir):
    """K5: staged units packed into rewrite groups by their running size."""
    m = read_manifest(spark, build_lake(spark, sf_dir).layout).select("namespace", "type", "batch_id", "total_records")
    return packed(m, "total_records", PACK_RECORDS, "batch_id")


def q_unknown_kinds(spark, sf_dir):
    """Attributes that no declared column picks up, by what their values are."""
    routed = _routed(spark, sf_dir).where(F.col("reason").isNull())
    declared = catalog_fields(load_catalog(spark, PACKAGE_CATALOG)).select("namespace", "table_name", "name")
    return unknown_attributes(routed, declared).groupBy("namespace", "type", "attribute", "kind").agg(F.count(F.lit(1)).alias("n"))


def q_quarantine_retry(spark, sf_dir):
    """Quarantined records tried again after a table for them was declared:
    rows of each reason before and after, and what its table then holds."""
    root = work_root(spark, "retry")
    apply_all(spark, PACKAGE_CATALOG, root)
    layout, settings = Layout(root), SETTINGS
    ingest(spark, raw_batches(spark, sf_dir), root, live_tables(spark, root), settings)
    count = lambda df, name: df.groupBy("namespace", "type", "reason").agg(F.count(F.lit(1)).alias(name))
    before = count(read_quarantine(spark, layout), "n_before").collect()  # a row for each reason and type
    apply_all(spark, f"{PACKAGE_CATALOG}_carts", root)
    retry_quarantine(spark, root, settings)
    specs = live_tables(spark, root)
    merge_pending(spark, layout, specs, settings)
    carts = next(s for s in specs if s.table_name == "cart_events")
    taken = read_table(spark, root, carts).select(F.lit("site").alias("namespace"), F.lit("cart_events").alias("type"), F.lit(STATUS_OK).alias("reason"))
    after = count(read_quarantine(spark, layout).select("namespace", "type", "reason").unionByName(taken), "n_after")
    first = spark.createDataFrame(before, "namespace string, type string, reason string, n_before long").select(
        F.col("namespace").alias("ns0"), F.col("type").alias("type0"), F.col("reason").alias("reason0"), "n_before")
    same = F.col("namespace").eqNullSafe(F.col("ns0")) & F.col("type").eqNullSafe(F.col("type0")) & (F.col("reason") == F.col("reason0"))
    return after.join(first, same, "full").select(
        F.coalesce("namespace", "ns0").alias("namespace"), F.coalesce("type", "type0").alias("type"), F.coalesce("reason", "reason0").alias("reason"),
        F.coalesce("n_before", F.lit(0)).cast("bigint").alias("n_before"), F.coalesce("n_after", F.lit(0)).cast("bigint").alias("n_after"),
    )


def q_log_order(spark, sf_dir):
    """F1 F2: committed rows grouped anew by where they stood in their log: the
    order of arrival survives staging and merging."""
    lake = build_lake(spark, sf_dir)
    out = None
    for spec in lake.specs:
        t = read_table(spark, lake.root, spec, positions=True).select(
            F.lit(spec.namespace).alias("namespace"), F.lit(spec.table_name).alias("type"),
            F.col("log_partition").alias("source_partition"), F.col("log_offset").alias("source_offset"))
        out = t if out is None else out.unionByName(t)
    return group_sizes(assign_groups(out, GROUP_RECORDS))


QUERIES = {
    "shared_location": q_shared_location,
    "readd_column": q_readd_column,
    "manifest_validity": q_manifest_validity,
    "two_sources_ingest": q_two_sources_ingest,
    "rejected_events": q_rejected_events,
    "valid_events": q_valid_events,
    "event_time_parse": q_event_time_parse,
    "unregistered_types": q_unregistered_types,
    "envelope_roundtrip": q_envelope_roundtrip,
    "typed_projection": q_typed_projection,
    "coerce_matrix": q_coerce_matrix,
    "coerce_values": q_coerce_values,
    "coercion_quarantine": q_coercion_quarantine,
    "unknown_attributes": q_unknown_attributes,
    "group_sizes": q_group_sizes,
    "group_batches": q_group_batches,
    "commit_guard": q_commit_guard,
    "staged_manifest": q_staged_manifest,
    "replay_idempotent": q_replay_idempotent,
    "merge_totals": q_merge_totals,
    "merge_roundtrip": q_merge_roundtrip,
    "pending_files": q_pending_files,
    "cleanup_candidates": q_cleanup_candidates,
    "partition_day": q_partition_day,
    "partition_hour": q_partition_hour,
    "time_range_read": q_time_range_read,
    "as_of_read": q_as_of_read,
    "late_events": q_late_events,
    "ulid_shape": q_ulid_shape,
    "distinct_locations": q_distinct_locations,
    "evolved_read": q_evolved_read,
    "schema_changes": q_schema_changes,
    "schema_add_columns": q_schema_add_columns,
    "schema_drop_columns": q_schema_drop_columns,
    "schema_ignored_changes": q_schema_ignored_changes,
    "stream_equals_batch": q_stream_equals_batch,
    "quarantine_report": q_quarantine_report,
    "sql_view_read": q_sql_view_read,
    "freshness": q_freshness,
    "buffer_groups": q_buffer_groups,
    "manifest_stream": q_manifest_stream,
    "catalog_read": q_catalog_read,
    "sql_between": q_sql_between,
    "packed_units": q_packed_units,
    "unknown_kinds": q_unknown_kinds,
    "quarantine_retry": q_quarantine_retry,
    "log_order": q_log_order,
}
