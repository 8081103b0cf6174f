"""Commit ledger, commit guard, cleanup and freshness reports
(A10, A14, B13, B15, K3, K6).

A merge becomes visible when its ledger row exists: the row is written after
the data, so readers never see part of a merge. The ledger is keyed by
``merge_id`` (deterministic), so a re-run commit overwrites its own row
instead of appending the same files twice.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.contract import LEDGER_DDL, REJECTED_DDL, Layout
from larkspur.sources import storage


def commit_guard() -> Column:
    """True when a manifest row may be committed.

    Rejects blank type, blank location, ``total_records <= 0`` and
    ``length <= 0`` (blank = empty or whitespace). The namespace is not
    checked.
    """
    def filled(c):
        return F.col(c).isNotNull() & (F.trim(F.col(c)) != "")

    return (
        filled("type")
        & filled("location")
        & F.coalesce(F.col("total_records") > 0, F.lit(False))
        & F.coalesce(F.col("length") > 0, F.lit(False))
    )


def guard_reason() -> Column:
    """First failing guard check, or null."""
    def blank(c):
        return F.col(c).isNull() | (F.trim(F.col(c)) == "")

    return (
        F.when(blank("type"), F.lit("blank_type"))
        .when(blank("location"), F.lit("blank_location"))
        .when(F.coalesce(F.col("total_records") <= 0, F.lit(True)), F.lit("no_records"))
        .when(F.coalesce(F.col("length") <= 0, F.lit(True)), F.lit("no_bytes"))
    )


def ledger_path(layout: Layout, namespace: str, type_: str) -> str:
    return f"{layout.ledger}/namespace={namespace}/type={type_}"


def read_ledger(spark: SparkSession, layout: Layout, namespace: str | None = None,
                type_: str | None = None) -> DataFrame:
    """Ledger rows; with (namespace, type) only that table's directory is listed."""
    one = namespace is not None and type_ is not None
    path = ledger_path(layout, namespace, type_) if one else layout.ledger
    if not storage.exists(spark, path):  # nothing committed yet; an unreadable ledger raises
        return spark.createDataFrame([], LEDGER_DDL)
    return spark.read.schema(LEDGER_DDL).option("basePath", layout.ledger).parquet(path)


def read_rejected(spark: SparkSession, layout: Layout) -> DataFrame:
    """Q3: merges that the commit guard refused, with the reason."""
    if not storage.exists(spark, layout.rejected):
        return spark.createDataFrame([], REJECTED_DDL)
    return spark.read.schema(REJECTED_DDL).parquet(layout.rejected)


def one_row(spark: SparkSession, row: dict, ddl: str) -> DataFrame:
    """A row as literals, so that no Python worker is started for it."""
    def literal(value):
        if isinstance(value, list):
            return F.from_json(F.lit(json.dumps(value)), "array<string>")
        return F.lit(value.isoformat(sep=" ") if isinstance(value, datetime) else value)

    return spark.sql("SELECT 1").select(*(literal(row[f.name]).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(ddl)))


def write_rejected(spark: SparkSession, layout: Layout, row: dict) -> None:
    """Keep a refused merge, once: its batches are no longer pending."""
    df = one_row(spark, row, REJECTED_DDL).drop("merge_id")
    df.coalesce(1).write.mode("overwrite").parquet(f"{layout.rejected}/merge_id={row['merge_id']}")


def settled_batches(spark: SparkSession, layout: Layout, as_of: int | None = None) -> DataFrame:
    """(namespace, type, batch_id) of committed and of refused batches."""
    led = read_ledger(spark, layout)
    if as_of is not None:
        led = led.where(F.col("merge_seq") <= F.lit(int(as_of)))
    parts = [led] if as_of is not None else [led, read_rejected(spark, layout)]
    out = None
    for p in parts:
        p = p.select("namespace", "type", F.explode("child_batches").alias("batch_id"))
        out = p if out is None else out.unionByName(p)
    return out


def write_ledger_row(spark: SparkSession, layout: Layout, row: dict) -> None:
    """A10: the visibility point of one merge."""
    df = one_row(spark, row, LEDGER_DDL).drop("namespace", "type", "merge_id")
    target = f"{ledger_path(layout, row['namespace'], row['type'])}/merge_id={row['merge_id']}"
    df.coalesce(1).write.mode("overwrite").parquet(target)


def cleanup_candidates(spark: SparkSession, layout: Layout) -> DataFrame:
    """Staged files whose batch is committed (safe to delete).

    Report only; nothing is deleted. Matched by batch, not by path, since a
    replay can rename files.
    """
    from larkspur.operators.staging import read_manifest

    committed = read_ledger(spark, layout).select(
        "namespace", "type", F.explode("child_batches").alias("batch_id")
    )
    return read_manifest(spark, layout).join(committed, ["namespace", "type", "batch_id"], "left_semi")


def freshness(spark: SparkSession, layout: Layout) -> DataFrame:
    """K6: per table, lag between the newest loaded row and its commit."""
    return read_ledger(spark, layout).groupBy("namespace", "type").agg(
        F.count(F.lit(1)).alias("n_merges"),
        F.max("committed_at").alias("last_commit"),
        F.max(F.timestamp_diff("SECOND", F.col("max_load_time"), F.col("committed_at"))).alias("max_lag_seconds"),
    )
