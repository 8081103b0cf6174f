"""Catalog of table declarations.

Declarations are JSON files ``{catalog_dir}/{namespace}/{tableName}.json``.
Applying a declaration records a *version* of the live table schema in the
registry (``{root}/registry``); ingest always uses the latest registered
version, re-read for every micro-batch. Plain Parquet tables can neither drop
a column nor partition by an expression, so the registry plus a read schema
does both: dropped columns are hidden on read, added ones read as null in
older files.

The catalog is configuration: a handful of rows per table. Collecting it to
the driver is bounded by the number of declared columns, never by data.
"""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.contract import (
    CATALOG_FILE_DDL,
    COMMON_FIELDS,
    MSG_SCHEMA_APPLIED,
    MSG_SCHEMA_NOT_FOUND,
    PARTITION_HOUR,
    SPARK_TYPES,
    Layout,
)
from larkspur.sources import storage

PACKAGE_CATALOG = str(Path(__file__).resolve().parent.parent / "catalog_data")
PACKAGE_CATALOG_V2 = str(Path(__file__).resolve().parent.parent / "catalog_data_v2")

REGISTRY_DDL = (
    "namespace string, table_name string, version int, bucket_name string, "
    "partition_type string, field_id int, name string, data_type string"
)


class SchemaNotFound(Exception):
    """No declaration file for the requested (namespace, table)."""


class InvalidRequest(ValueError):
    """Blank namespace or table name in an apply request."""


def physical_name(field_id: int) -> str:
    return f"field_{field_id}"


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


#: Where in its log a committed row stood (F1).
POSITION = T.StructType([T.StructField("log_name", T.StringType()), T.StructField("log_partition", T.IntegerType()), T.StructField("log_offset", T.LongType())])


@dataclass(frozen=True)
class TableSpec:
    namespace: str
    table_name: str
    bucket_name: str
    partition_type: str
    version: int
    fields: tuple  # ((field_id, name, data_type), ...) in declaration order

    @property
    def hourly(self) -> bool:
        return (self.partition_type or "").upper() == PARTITION_HOUR

    @property
    def partition_columns(self) -> list[str]:
        return ["event_date", "event_hour"] if self.hourly else ["event_date"]

    @property
    def field_names(self) -> list[str]:
        return [f[1] for f in self.fields]

    def struct(self) -> T.StructType:
        """H3: four common columns + declared product columns (optional)."""
        common = [
            T.StructField("event_id", T.StringType(), False),
            T.StructField("tenant_id", T.StringType(), True),
            T.StructField("load_time", T.TimestampNTZType(), False),
            T.StructField("event_time", T.TimestampNTZType(), False),
        ]
        product = [
            T.StructField(name, T._parse_datatype_string(SPARK_TYPES.get(dt, "string")), True)
            for _, name, dt in self.fields
        ]
        return T.StructType(common + product)

    def physical(self) -> T.StructType:
        """What the files hold: product columns are named by field id, so a
        name that is dropped and declared again reads nothing old."""
        names = [*COMMON_FIELDS, *(physical_name(i) for i, _, _ in self.fields)]
        return T.StructType([T.StructField(n, f.dataType, f.nullable) for n, f in zip(names, self.struct().fields, strict=True)])

    @property
    def row_name(self) -> str:
        """The struct that holds this table's rows in landed files, the same
        for every version of the table."""
        return "t_" + hashlib.sha256(f"{self.namespace}|{self.table_name}".encode()).hexdigest()[:12]

    def stored(self) -> T.StructType:
        """``physical`` and the position in the log that a row came from."""
        return T.StructType([*self.physical().fields, *POSITION.fields])

    def to_physical(self) -> list:
        return [*COMMON_FIELDS, *(F.col(quoted(n)).alias(physical_name(i)) for i, n, _ in self.fields)]

    def from_physical(self) -> list:
        return [*COMMON_FIELDS, *(F.col(physical_name(i)).alias(n) for i, n, _ in self.fields)]

    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.struct().fields)


# --- scanning declarations -------------------------------------------------

def _is_local(path: str) -> bool:
    return "://" not in path and os.path.isdir(path)


def _declarations(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Declaration files on the driver's disk (the package's own, say), which
    executors need not see: read here, a row a table."""
    keep = ("namespace", "tableName", "bucketName", "partitionType")
    rows = []
    for p in paths:
        d = json.loads(Path(p).read_text())
        fields = [tuple(f.get(k) for k in ("id", "name", "dataType", "deprecated")) for f in d.get("fields") or []]
        rows.append((*(d.get(k) for k in keep), fields, Path(p).resolve().as_uri()))
    return spark.createDataFrame(rows, CATALOG_FILE_DDL + ", source_file string")


def load_catalog(spark: SparkSession, catalog_dir: str = PACKAGE_CATALOG) -> DataFrame:
    """Every declaration under ``catalog_dir`` as one DataFrame.

    Unknown JSON properties are ignored (explicit schema); the source file
    name is kept for error reports.
    """
    if _is_local(catalog_dir):
        return _declarations(spark, sorted(map(str, Path(catalog_dir).glob("*/*.json"))))
    return (
        spark.read.schema(CATALOG_FILE_DDL)
        .option("multiLine", True)
        .json(f"{catalog_dir.rstrip('/')}/*/*.json")
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def catalog_fields(catalog: DataFrame) -> DataFrame:
    """One row per declared field (namespace, table_name, field_id, name, data_type)."""
    return catalog.select(
        "namespace",
        F.col("tableName").alias("table_name"),
        F.col("bucketName").alias("bucket_name"),
        F.col("partitionType").alias("partition_type"),
        F.posexplode_outer("fields").alias("pos", "f"),
    ).select(
        "namespace", "table_name", "bucket_name", "partition_type", "pos",
        F.col("f.id").alias("field_id"),
        F.col("f.name").alias("name"),
        F.upper(F.col("f.dataType")).alias("data_type"),
    )


def distinct_buckets(catalog: DataFrame) -> DataFrame:
    """the set of table locations."""
    return catalog.select(F.col("bucketName").alias("bucket_name")).distinct()


def read_declaration(spark: SparkSession, catalog_dir: str, namespace: str, table: str) -> DataFrame:
    """The declaration of one table; missing file raises."""
    path = f"{catalog_dir.rstrip('/')}/{namespace}/{table}.json"
    if _is_local(catalog_dir):
        if not os.path.exists(path):
            raise SchemaNotFound(path)
        return _declarations(spark, [path])
    if not storage.exists(spark, path):
        raise SchemaNotFound(path)
    return spark.read.schema(CATALOG_FILE_DDL).option("multiLine", True).json(path)


def specs_from_catalog(catalog: DataFrame, version: int = 1) -> list[TableSpec]:
    """Declarations -> TableSpec list (driver side, config sized)."""
    out = []
    for r in catalog.collect():
        fields = tuple(
            (f["id"], f["name"], (f["dataType"] or "STRING").upper()) for f in (r["fields"] or [])
        )
        out.append(TableSpec(r["namespace"], r["tableName"], r["bucketName"], r["partitionType"], version, fields))
    return out


# --- schema diff (J3, J4, H9, D9) -------------------------------------------

def schema_diff(declared: DataFrame, live: DataFrame) -> DataFrame:
    """Difference between declared fields and live columns of the same tables.

    Both inputs have (namespace, table_name, name, data_type). Output rows
    (namespace, table_name, name, change, data_type) with change in
    ``add`` (declared, not live), ``drop`` (live, not declared, not common)
    and ``ignored`` (declared with another type: types are not evolved).
    """
    keys = ["namespace", "table_name", "name"]
    live_p = live.where(~F.col("name").isin(*COMMON_FIELDS))
    decl_p = declared.where(~F.col("name").isin(*COMMON_FIELDS))
    added = decl_p.join(live_p.select(*keys), keys, "left_anti").select(
        *keys, F.lit("add").alias("change"), "data_type"
    )
    dropped = live_p.join(decl_p.select(*keys), keys, "left_anti").select(
        *keys, F.lit("drop").alias("change"), "data_type"
    )
    retyped = (
        decl_p.alias("d")
        .join(live_p.alias("l"), keys)
        .where(F.col("d.data_type") != F.col("l.data_type"))
        .select(*keys, F.lit("ignored").alias("change"), F.col("l.data_type").alias("data_type"))
    )
    return added.unionByName(dropped).unionByName(retyped)


# --- registry -----------------------------------------------------------------

def registry(spark: SparkSession, root: str) -> DataFrame:
    path = Layout(root).registry
    if not storage.exists(spark, path):  # nothing applied yet; an unreadable registry raises
        return spark.createDataFrame([], REGISTRY_DDL)
    return spark.read.schema(REGISTRY_DDL).parquet(path)


def latest_registry(spark: SparkSession, root: str) -> DataFrame:
    reg = registry(spark, root)
    last = reg.groupBy("namespace", "table_name").agg(F.max("version").alias("version"))
    return reg.join(last, ["namespace", "table_name", "version"])


def live_tables(spark: SparkSession, root: str) -> list[TableSpec]:
    """Latest registered version of every table (driver side, config sized)."""
    rows = latest_registry(spark, root).orderBy("namespace", "table_name", "field_id").collect()
    grouped: dict = {}
    for r in rows:
        key = (r["namespace"], r["table_name"])
        g = grouped.setdefault(key, {"meta": r, "fields": []})
        if r["name"] is not None:
            g["fields"].append((r["field_id"], r["name"], r["data_type"]))
    return [
        TableSpec(k[0], k[1], g["meta"]["bucket_name"], g["meta"]["partition_type"], g["meta"]["version"], tuple(g["fields"]))
        for k, g in grouped.items()
    ]


@dataclass
class ApplyResult:
    message: str
    version: int | None = None
    created: bool = False
    added: int = 0
    dropped: int = 0
    ignored: int = 0


def ensure_namespace(spark: SparkSession, root: str, namespace: str) -> bool:
    """H2: create the namespace as a Spark database if absent (located under
    the lakehouse root). Returns True when it was created."""
    if spark.catalog.databaseExists(namespace):
        return False
    quoted = namespace.replace("`", "``")
    location = f"{root.rstrip('/')}/_namespaces/{namespace}".replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{quoted}` LOCATION '{location}'")
    return True


def apply_schema(spark: SparkSession, catalog_dir: str, root: str, namespace: str, table: str,
                 create_database: bool = False) -> ApplyResult:
    """H1: apply one declaration to the registry.

    Blank arguments raise ``InvalidRequest`` carrying the reference's message;
    a missing file raises ``SchemaNotFound``. A new table gets version 1; an
    existing one gets a new version only when columns are added or dropped
    (type and partition changes are reported as ``ignored``).
    """
    if not (namespace or "").strip() or not (table or "").strip():
        raise InvalidRequest(MSG_SCHEMA_NOT_FOUND)
    if create_database:
        ensure_namespace(spark, root, namespace)
    return _apply(spark, read_declaration(spark, catalog_dir, namespace, table), root)[0]


def apply_all(spark: SparkSession, catalog_dir: str, root: str) -> list[ApplyResult]:
    """Apply every declaration found under ``catalog_dir`` in one pass, by the
    rules of ``apply_schema``: one diff (anti joins) of all declared tables
    against the latest registered versions, one registry write."""
    return _apply(spark, load_catalog(spark, catalog_dir), root)


def _apply(spark: SparkSession, cat: DataFrame, root: str) -> list[ApplyResult]:
    """The one implementation: all rows here are configuration, one per
    declared or live column. A column added to a live table takes the declared
    id if no version of the table ever used it, else the next free one. A
    version without columns is a row without a name."""
    meta = {(r["namespace"], r["tableName"]): r for r in cat.select(
        "namespace", "tableName", "bucketName", "partitionType").collect()}
    decl = catalog_fields(cat).where(F.col("name").isNotNull()).select(
        "namespace", "table_name", "pos", "field_id", "name", "data_type"
    )
    every = registry(spark, root).collect()
    latest: dict = {}
    for r in every:
        key = (r["namespace"], r["table_name"])
        latest[key] = max(latest.get(key, 0), r["version"])
    live_rows = [r for r in every if r["version"] == latest[(r["namespace"], r["table_name"])]]
    live_meta = {(r["namespace"], r["table_name"]): r for r in live_rows}
    used: dict = {}
    for r in every:
        used.setdefault((r["namespace"], r["table_name"]), set()).add(r["field_id"])
    decl_rows = sorted(decl.collect(), key=lambda r: (r["namespace"], r["table_name"], r["pos"]))
    live = spark.createDataFrame(live_rows, REGISTRY_DDL).where(F.col("name").isNotNull())
    diff_rows = schema_diff(decl.drop("pos"), live).collect() if live_rows else []
    changes: dict = {}
    for r in diff_rows:
        changes.setdefault((r["namespace"], r["table_name"]), []).append(r)

    def with_ids(key, fields) -> list:
        taken = used.setdefault(key, set())
        out = []
        for f in fields:
            i = f["field_id"]
            if i is None or i in taken:
                i = max([100, *(x for x in taken if x is not None), *(d["field_id"] or 0 for d in decl_rows)]) + 1
            taken.add(i)
            out.append((i, f["name"], f["data_type"]))
        return out

    new_rows, results = [], []
    for key, m in sorted(meta.items()):
        fields = [r for r in decl_rows if (r["namespace"], r["table_name"]) == key]
        ch = changes.get(key, [])
        adds = {r["name"] for r in ch if r["change"] == "add"}
        drops = {r["name"] for r in ch if r["change"] == "drop"}
        ignored = sum(1 for r in ch if r["change"] == "ignored")
        created = key not in live_meta
        if created:
            version, place, columns = 1, (m["bucketName"], m["partitionType"]), with_ids(key, fields)
        else:
            lm = live_meta[key]
            version, place = lm["version"] + bool(adds or drops), (lm["bucket_name"], lm["partition_type"])
            kept = [(r["field_id"], r["name"], r["data_type"]) for r in live_rows
                    if (r["namespace"], r["table_name"]) == key and r["name"] is not None and r["name"] not in drops]
            columns = kept + (with_ids(key, [f for f in fields if f["name"] in adds]) if adds else [])
        if created or adds or drops:
            new_rows += [(*key, version, *place, *c) for c in columns or [(None, None, None)]]
        results.append(ApplyResult(MSG_SCHEMA_APPLIED, version=version, created=created,
                                   added=len(fields) if created else len(adds), dropped=len(drops), ignored=ignored))
    if new_rows:
        spark.createDataFrame(new_rows, REGISTRY_DDL).coalesce(1).write.mode("append").parquet(Layout(root).registry)
    return results


def handle_apply_request(spark: SparkSession, catalog_dir: str, root: str, request: dict) -> str:
    """Request ``{namespace, tableName}`` -> message text."""
    try:
        return apply_schema(spark, catalog_dir, root, request.get("namespace"), request.get("tableName")).message
    except InvalidRequest as e:
        return str(e)
    except OSError as e:
        return str(e)
