"""Committed tables in Spark's catalog.

For a declared table there is, in a database named after its namespace, a
partitioned table over the merged files, a view that names the columns as they
are declared now, and a table function that takes a time range. A merge becomes
visible to every session of the catalog when its partitions are registered, all
in one statement; a merge id that is there already is not added again.

The function derives the bounds of ``event_date`` and ``event_hour`` from its
arguments, so SQL that only names times reads only their folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.contract import Layout
from larkspur.operators.publish import read_ledger
from larkspur.sources import storage
from larkspur.sources.catalog import TableSpec, physical_name, quoted


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def database(spec: TableSpec, prefix: str = "") -> str:
    return quoted(f"{prefix}{spec.namespace}")


def table_name(spec: TableSpec, prefix: str = "") -> str:
    return f"{database(spec, prefix)}.{quoted(spec.table_name)}"


def files_name(spec: TableSpec, prefix: str = "") -> str:
    return f"{database(spec, prefix)}.{quoted(spec.table_name + '__files')}"


def function_name(spec: TableSpec, prefix: str = "") -> str:
    """SQL calls table functions without a database, so the name tells it: the
    function is in the database that is current when the table is created."""
    return quoted(f"{prefix}{spec.namespace}__{spec.table_name}_between")


def _partitions(spec: TableSpec) -> str:
    return "merge_id STRING, event_date DATE" + (", event_hour INT" if spec.hourly else "")


def create_table(spark: SparkSession, layout: Layout, spec: TableSpec, prefix: str = "") -> None:
    """H2 H5: the database, the files' table (with columns of all versions so
    far), the view and the function of a declared table."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database(spec, prefix)}")
    files, stored = files_name(spec, prefix), spec.stored().fields
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in stored)
    storage.make_dirs(spark, layout.data(spec))
    keys = "merge_id, event_date" + (", event_hour" if spec.hourly else "")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {files} ({columns}, {_partitions(spec)}) USING parquet PARTITIONED BY ({keys}) LOCATION {_literal(layout.data(spec))}")
    known = set(spark.table(files).columns)
    added = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in stored if f.name not in known]
    if added:
        spark.sql(f"ALTER TABLE {files} ADD COLUMNS ({', '.join(added)})")
    shown = [quoted(c) for c in ("event_id", "tenant_id", "load_time", "event_time")]
    shown += [f"{quoted(physical_name(i))} AS {quoted(n)}" for i, n, _ in spec.fields]
    shown += ["log_name", "log_partition", "log_offset", "event_date"] + (["event_hour"] if spec.hourly else [])
    view = table_name(spec, prefix)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(shown)} FROM {files}")
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in spark.table(view).schema.fields)
    names = ", ".join(quoted(f.name) for f in spark.table(view).schema.fields)
    day = lambda t: f"CAST({t} AS DATE)"
    where = f"event_time >= from_time AND event_time < to_time AND event_date >= {day('from_time')} AND event_date <= {day('to_time')}"
    if spec.hourly:
        where += f" AND (event_date > {day('from_time')} OR event_hour >= hour(from_time)) AND (event_date < {day('to_time')} OR event_hour <= hour(to_time))"
    spark.sql(f"CREATE OR REPLACE FUNCTION {function_name(spec, prefix)}(from_time TIMESTAMP_NTZ, to_time TIMESTAMP_NTZ) RETURNS TABLE ({fields}) RETURN SELECT {names} FROM {view} WHERE {where}")


def _clause(spec: TableSpec, values: dict[str, str]) -> str:
    hour = f", event_hour={int(values['event_hour'])}" if spec.hourly else ""
    return f"PARTITION (merge_id={_literal(values['merge_id'])}, event_date=DATE{_literal(values['event_date'])}{hour})"


def drop_merges(spark: SparkSession, spec: TableSpec, merge_ids: list[str], prefix: str = "") -> int:
    """Take the merges' partitions out of the catalog, in one statement; their
    files stay."""
    rows = spark.sql(f"SHOW PARTITIONS {files_name(spec, prefix)}").where(F.split(F.split("partition", "/")[0], "=")[1].isin(merge_ids)).collect()
    parts = [_clause(spec, dict(p.split("=", 1) for p in r["partition"].split("/"))) for r in rows]
    if parts:
        spark.sql(f"ALTER TABLE {files_name(spec, prefix)} DROP IF EXISTS {', '.join(parts)}")
    return len(parts)


def registered_merges(spark: SparkSession, spec: TableSpec, prefix: str = "") -> set[str]:
    rows = spark.sql(f"SHOW PARTITIONS {files_name(spec, prefix)}").select(F.split(F.split("partition", "/")[0], "=")[1].alias("m")).distinct()
    return {r["m"] for r in rows.collect()}


def register_merge(spark: SparkSession, layout: Layout, spec: TableSpec, merge_id: str, prefix: str = "") -> int:
    """A10: make a merge's folders partitions, in one statement. Returns how
    many there are."""
    depth = "event_date=*/event_hour=*" if spec.hourly else "event_date=*"
    parts = []
    for path, _ in storage.listed(spark, f"{layout.data(spec)}/merge_id={merge_id}/{depth}"):
        values = dict(p.split("=", 1) for p in path.split("/")[-2 if spec.hourly else -1 :])
        parts.append(_clause(spec, {"merge_id": merge_id, **values}))
    if parts:
        spark.sql(f"ALTER TABLE {files_name(spec, prefix)} ADD IF NOT EXISTS {' '.join(parts)}")
    return len(parts)


def sync_tables(spark: SparkSession, layout: Layout, specs: list[TableSpec], prefix: str = "") -> dict[str, int]:
    """Bring the catalog up to the ledger: every committed merge that no
    partition names yet. Returns the number of merges added to each table."""
    added = {}
    for spec in specs:
        create_table(spark, layout, spec, prefix)
        there = registered_merges(spark, spec, prefix)
        committed = [r["merge_id"] for r in read_ledger(spark, layout, spec.namespace, spec.table_name).orderBy("merge_seq").select("merge_id").collect()]
        new = [m for m in committed if m not in there]
        for m in new:
            register_merge(spark, layout, spec, m, prefix)
        added[spec.table_name] = len(new)
    return added


def between(spark: SparkSession, spec: TableSpec, start: str, end: str, prefix: str = "") -> DataFrame:
    """Rows with start <= event_time < end, by the table function."""
    return spark.sql(f"SELECT * FROM {function_name(spec, prefix)}(TIMESTAMP_NTZ{_literal(start)}, TIMESTAMP_NTZ{_literal(end)})")
