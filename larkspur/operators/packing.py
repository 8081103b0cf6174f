"""Bin packing of small committed or staged units into rewrite groups (K5).

Units of a table, in order, are laid end to end by their size; a group is what
begins within one stretch of the target size, so a group holds less than the
target and one unit more. The running sum is taken in two levels: totals of
fixed-size blocks of units, and the sum inside a block, so a table with very
many units is not one task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.contract import Layout, Settings
from larkspur.operators.compaction import merge_id_of
from larkspur.operators.tables import drop_merges, files_name, register_merge
from larkspur.sources.catalog import TableSpec

#: Ranges of the order that are windows of their own, cut by a sample by hash.
BLOCKS = 64


def packed(units: DataFrame, size: str, target: int, order: str, table: tuple[str, ...] = ("namespace", "type")) -> DataFrame:
    """Adds ``pack``, the rewrite group of each unit of its table (from 0)."""
    few = units.select(order).distinct().orderBy(F.xxhash64(order)).limit(BLOCKS - 1).collect()
    bounds = sorted(r[order] for r in few if r[order] is not None)
    block = F.lit(0)
    for k, b in enumerate(bounds):
        block = F.when(F.col(order) > F.lit(b), F.lit(k + 1)).otherwise(block)
    rows = units.withColumn("_block", block)
    totals = rows.groupBy(*table, "_block").agg(F.sum(size).alias("_total"))
    before = Window.partitionBy(*table).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*table, "_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*table, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(totals, [*table, "_block"])
    return rows.withColumn("pack", F.floor((F.col("_start") + F.col("_inside")) / F.lit(target)).cast("bigint")).drop("_block", "_inside", "_start")


def rewrite_table(spark: SparkSession, layout: Layout, spec: TableSpec, target_rows: int, settings: Settings | None = None, prefix: str = "") -> list[tuple[str, list[str]]]:
    """Rewrite runs of small merges of a catalog table: each group's rows go to
    one new merge folder, whose partitions replace those of its members. Returns
    (new merge id, the merges it replaces). The old files stay for readers that
    have planned already."""
    files = spark.table(files_name(spec, prefix))
    units = files.groupBy("merge_id").agg(F.count(F.lit(1)).alias("n"), F.min("load_time").alias("at"))
    units = units.withColumn("namespace", F.lit(spec.namespace)).withColumn("type", F.lit(spec.table_name)).withColumn("order", F.concat_ws("/", F.col("at").cast("string"), "merge_id"))
    groups = packed(units, "n", target_rows, "order").groupBy("pack").agg(F.sort_array(F.collect_list("merge_id")).alias("ids")).where("size(ids) > 1").orderBy("pack").collect()
    done = []
    for g in groups:
        new = merge_id_of(spec.namespace, spec.table_name, [f"rewrite:{m}" for m in g["ids"]])
        order = [*spec.partition_columns, "event_time", "event_id"]
        rows = files.where(F.col("merge_id").isin(g["ids"])).drop("merge_id")
        rows = rows.repartition(min(32, spark.sparkContext.defaultParallelism), *spec.partition_columns).sortWithinPartitions(*order)
        rows.write.mode("overwrite").partitionBy(*spec.partition_columns).parquet(f"{layout.data(spec)}/merge_id={new}")
        register_merge(spark, layout, spec, new, prefix)
        drop_merges(spark, spec, g["ids"], prefix)
        spark.catalog.refreshTable(files_name(spec, prefix))
        done.append((new, g["ids"]))
    return done
