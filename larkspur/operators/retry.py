"""Retry of quarantined rows (G8, Q4, Q5): records whose table was not there, or
whose values did not fit it, go through the ingest again under the schemas of
now. What is accepted leaves the quarantine; what is not stays, with one more
attempt and its present reason.

A retried batch has an id of its own, made of the old one and the attempt, so a
retry that is run again replaces what it wrote; the old quarantine rows are
removed last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.contract import R_COERCION, R_UNREGISTERED, Layout, Settings, escaped
from larkspur.operators.ingest import IngestReport, ingest
from larkspur.operators.staging import overwrite_partitions, read_quarantine
from larkspur.sources import storage
from larkspur.sources.catalog import live_tables

#: Reasons that a later schema can lift.
RETRYABLE = (R_UNREGISTERED, R_COERCION)
#: Attempts after which a row is left alone.
MOST_ATTEMPTS = 20


def retryable(spark: SparkSession, layout: Layout, most_attempts: int = MOST_ATTEMPTS) -> DataFrame:
    """Quarantined records to try again, in the shape of raw records; only those
    that a table of now might take."""
    rows = read_quarantine(spark, layout).where(F.col("reason").isin(*RETRYABLE) & (F.coalesce("attempts", F.lit(0)) < most_attempts))
    attempt = (F.coalesce("attempts", F.lit(0)) + 1).cast("int")
    name = F.concat(F.regexp_replace("batch_id", "~[0-9]+$", ""), F.lit("~"), attempt.cast("string"))
    return rows.select("key", "value", "source_partition", "source_offset", "source_ts", F.col("log_name").alias("source_name"), attempt.alias("attempts"), F.col("batch_id").alias("from_batch"), name.alias("batch_id"))


def retry_quarantine(spark: SparkSession, root: str, settings: Settings | None = None, most_attempts: int = MOST_ATTEMPTS) -> IngestReport:
    layout, specs = Layout(root), live_tables(spark, root)
    rows = retryable(spark, layout, most_attempts)
    moved = rows.select("from_batch", "batch_id").distinct().collect()
    if not moved:
        return IngestReport([], [])
    report = ingest(spark, rows.drop("from_batch"), root, specs, settings, batch_ids=sorted({r["batch_id"] for r in moved}))
    # what was not tried again stays under its old batch
    old = sorted({r["from_batch"] for r in moved})
    every = read_quarantine(spark, layout).where(F.col("batch_id").isin(old))
    rest = every.where(~(F.col("reason").isin(*RETRYABLE) & (F.coalesce("attempts", F.lit(0)) < most_attempts)))
    kept = {r["batch_id"] for r in rest.select("batch_id").distinct().collect()}
    scratch = f"{layout.root}/retry-rest"
    rest.write.mode("overwrite").parquet(scratch)
    if kept:
        overwrite_partitions(spark.read.schema(rest.schema).parquet(scratch), layout.quarantine, ["batch_id"])
    for b in set(old) - kept:
        storage.delete(spark, f"{layout.quarantine}/batch_id={escaped(b)}")
    storage.delete(spark, scratch)
    return report
