"""Typed projection of events onto a table schema."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.contract import COMMON_FIELDS, R_COERCION
from larkspur.functions.coerce import NUMERIC_TYPES, attribute, failed_sql, kind_sql, text_sql, value_sql
from larkspur.functions.ids import event_ulid
from larkspur.sources.catalog import TableSpec, physical_name, quoted


def _product_fields(spec: TableSpec):
    return [(i, name, dt) for i, (_, name, dt) in enumerate(spec.fields) if name not in COMMON_FIELDS]


def attribute_columns(spec: TableSpec) -> list[Column]:
    """Inner projection: each declared attribute's VARIANT (``_a<i>``)."""
    return [attribute("attributes", name).alias(f"_a{i}") for i, name, _ in _product_fields(spec)]


def kind_text_columns(spec: TableSpec) -> list[Column]:
    """Second projection: kind and text of each attribute, computed once."""
    out = []
    for i, _, _ in _product_fields(spec):
        out += [F.expr(kind_sql(f"_a{i}")).alias(f"_k{i}"), F.expr(text_sql(f"_a{i}")).alias(f"_t{i}")]
    return out


def typed_columns(spec: TableSpec) -> list[Column]:
    """Third projection: the typed value of each field."""
    return [
        F.expr(value_sql(f"_a{i}", dt, f"_k{i}", f"_t{i}")).alias(name)
        for i, name, dt in _product_fields(spec)
    ]


def _text(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def failure_columns(spec: TableSpec) -> Column:
    """Outer projection: comma list of fields that were present but did not
    convert (empty when the row is clean)."""
    parts = [
        f"CASE WHEN {failed_sql(f'_k{i}', quoted(name))} THEN {_text(name)} END"
        for i, name, _ in _product_fields(spec)
    ]
    return F.expr(f"concat_ws(',', {', '.join(parts)})") if parts else F.lit("")


@dataclass(frozen=True)
class _SpecColumns:
    attributes: list
    kind_text: list
    typed: list
    failures: Column


@lru_cache(maxsize=256)
def _columns(app_id: str, spec: TableSpec) -> _SpecColumns:
    """The projection columns of one table version, built once per
    application: every micro-batch reuses them instead of rebuilding
    hundreds of expressions on the driver."""
    return _SpecColumns(attribute_columns(spec), kind_text_columns(spec), typed_columns(spec),
                        failure_columns(spec))


def project_typed(events: DataFrame, spec: TableSpec, load_time: Column | None = None) -> DataFrame:
    """Events routed to ``spec`` -> rows of the table schema plus ``reason``
    and ``detail`` (comma list of columns that failed to coerce).

    ``events`` must carry the decode/route columns. Only rows of this table
    that passed every earlier check are projected. The work is split in
    stacked projections (attribute kind/text -> typed values -> failures)
    so that no expression is repeated and generated code stays small.
    """
    if load_time is None:
        load_time = F.localtimestamp()
    cols = _columns(events.sparkSession.sparkContext.applicationId, spec)
    carry = ["namespace", "type", "source_partition", "source_offset", "value",
             *[c for c in ("batch_id",) if c in events.columns]]
    kinds = [f"_k{i}" for i, _, _ in _product_fields(spec)]
    names = [name for _, name, _ in _product_fields(spec)]
    # the log's name, so that equal positions of two logs give two ids
    seed = [F.col(c) for c in ("source_name", "source_partition", "source_offset") if c in events.columns]
    carry += [c for c in ("source_name",) if c in events.columns]
    mine = events.where(
        (F.col("namespace") == spec.namespace) & (F.col("type") == spec.table_name) & F.col("reason").isNull()
    ).select("tenant_id", "event_time", *carry, *cols.attributes).select("*", *cols.kind_text)
    typed = mine.select(
        event_ulid(F.col("event_time"), *seed).alias("event_id"),
        "tenant_id",
        load_time.cast("timestamp_ntz").alias("load_time"),
        "event_time",
        *cols.typed,
        *kinds,
        *carry,
    )
    checked = typed.select("*", cols.failures.alias("_failed"))
    return checked.select(
        "event_id", "tenant_id", "load_time", "event_time", *[quoted(n) for n in names],
        F.when(F.col("_failed") != "", F.lit(R_COERCION)).alias("reason"),
        F.when(F.col("_failed") != "", F.col("_failed")).alias("detail"),
        *carry,
    )


def table_rows(typed: DataFrame, spec: TableSpec) -> DataFrame:
    """Accepted rows, exactly the table columns."""
    return typed.where(F.col("reason").isNull()).select(*map(quoted, spec.struct().fieldNames()),
                                                        *[c for c in ("batch_id",) if c in typed.columns])


@lru_cache(maxsize=64)
def _shared_columns(app_id: str, specs: tuple[TableSpec, ...]):
    """Columns of the one pass over all tables: attributes (each name once),
    their kind and text, typed values (each name and type once), failures."""
    names = sorted({name for s in specs for _, name, _ in _product_fields(s)})
    at = {name: j for j, name in enumerate(names)}
    pairs = sorted({(name, dt) for s in specs for _, name, dt in _product_fields(s)})
    pair = {p: m for m, p in enumerate(pairs)}
    of = {name: [i for i, s in enumerate(specs) if name in s.field_names] for name in names}
    attributes = [F.when(F.col("_table").isin(of[name]), attribute("attributes", name)).alias(f"_a{j}") for j, name in enumerate(names)]
    # a number's text is dear to make, and a numeric type looks at texts of strings only
    worded = {name for name, dt in pairs if dt not in NUMERIC_TYPES}
    text = {name: f"_t{j}" for name, j in at.items() if name in worded}
    kinds = [F.expr(kind_sql(f"_a{j}")).alias(f"_k{j}") for j in at.values()] + [F.expr(text_sql(f"_a{at[n]}")).alias(t) for n, t in text.items()]
    typed = [F.expr(value_sql(f"_a{at[n]}", dt, f"_k{at[n]}", text.get(n))).alias(f"_v{m}") for m, (n, dt) in enumerate(pairs)]
    failed = None
    for i, s in enumerate(specs):
        parts = [f"CASE WHEN {failed_sql(f'_k{at[n]}', f'_v{pair[n, dt]}')} THEN {_text(n)} END" for _, n, dt in _product_fields(s)]
        own = F.expr(f"concat_ws(',', {', '.join(parts)})") if parts else F.lit("")
        failed = F.when(F.col("_table") == i, own) if failed is None else failed.when(F.col("_table") == i, own)
    return attributes, kinds, typed, failed, pair


def project_tables(events: DataFrame, specs: list[TableSpec], load_time: Column | None = None) -> DataFrame:
    """Every event in one pass: ``_table`` (its table's place in ``specs``, null
    if it has none), ``reason`` and ``detail`` (also of values that did not
    convert), the record's own columns, and for each table a struct that holds
    the row as it is stored, null unless the event is accepted for it."""
    load_time = F.localtimestamp() if load_time is None else load_time
    attributes, kinds, typed, failed, pair = _shared_columns(events.sparkSession.sparkContext.applicationId, tuple(specs))
    table = None
    for i, s in enumerate(specs):
        mine = (F.col("namespace") == s.namespace) & (F.col("type") == s.table_name) & F.col("reason").isNull()
        table = F.when(mine, F.lit(i)) if table is None else table.when(mine, F.lit(i))
    log_name = F.col("source_name") if "source_name" in events.columns else F.lit(None).cast("string")
    carry = ["namespace", "type", "source_partition", "source_offset", "value", "key", "source_ts", "batch_id", "attempts", "reason", "tenant_id", "event_time", "log_name"]
    attempts = F.col("attempts") if "attempts" in events.columns else F.lit(0)
    rows = events.withColumn("log_name", log_name).withColumn("attempts", attempts).withColumn("_table", F.lit(None).cast("int") if table is None else table)
    rows = rows.select("_table", *carry, *attributes).select("*", *kinds).select("_table", *carry, *(f"_k{j}" for j in range(len(attributes))), *typed)
    rows = rows.select("*", (F.lit(None).cast("string") if failed is None else failed).alias("_failed"))
    bad = F.coalesce(F.col("_failed") != "", F.lit(False))
    seed = [F.col(c) for c in (("log_name",) if "source_name" in events.columns else ()) + ("source_partition", "source_offset")]
    rows = rows.select("*", F.when(F.col("_table").isNotNull() & ~bad, event_ulid(F.col("event_time"), *seed)).alias("event_id"))
    structs = []
    for i, s in enumerate(specs):
        values = {n: F.col(f"_v{pair[n, dt]}") for _, n, dt in _product_fields(s)}
        product = [values.get(n, F.lit(None)).alias(physical_name(k)) for k, n, _ in s.fields]
        own = F.struct("event_id", "tenant_id", load_time.cast("timestamp_ntz").alias("load_time"), "event_time", *product,
                       "log_name", F.col("source_partition").alias("log_partition"), F.col("source_offset").alias("log_offset"))
        structs.append(F.when(F.col("event_id").isNotNull() & (F.col("_table") == i), own).alias(s.row_name))
    return rows.select(
        "_table", *carry[:9], "log_name", F.when(bad, F.lit(R_COERCION)).otherwise(F.col("reason")).alias("reason"),
        F.when(bad, F.col("_failed")).alias("detail"), *structs,
    )


def unknown_attributes(events: DataFrame, declared: DataFrame) -> DataFrame:
    """Attributes that no declared column picks up.

    ``declared`` has (namespace, table_name, name). Returns one row per (event,
    unknown key): namespace, type, attribute, value (VARIANT) and kind, what the
    value is: text, number, boolean, nested or null."""
    spark = events.sparkSession
    rows = events.select("namespace", "type", "attributes")
    values = rows.lateralJoin(spark.tvf.variant_explode(F.col("attributes").outer())).select("namespace", "type", F.col("key").alias("attribute"), "value")
    # declared columns: one row per catalog field (configuration, not data)
    decl = F.broadcast(declared.select(
        F.col("namespace"), F.col("table_name").alias("type"), F.col("name").alias("attribute")
    ))
    kinds = {"ST": "text", "BO": "boolean", "OB": "nested", "AR": "nested", "VO": "null"}
    kind = F.lit("number")
    for short, name in kinds.items():
        kind = F.when(F.left(F.schema_of_variant("value"), F.lit(2)) == short, F.lit(name)).otherwise(kind)
    return values.join(decl, ["namespace", "type", "attribute"], "left_anti").withColumn("kind", kind)
