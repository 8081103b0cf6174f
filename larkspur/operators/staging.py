"""Landed Parquet files and their manifest.

One write lands a whole input: the rows of every table, each as a struct of its
own, and the rejected records, in folders by outcome, bucket, namespace, table
and batch. The write observes which folders it fills; their rows and bytes come from
the footers of their files, read by a Spark job. A batch that is written again
replaces its folders, and those that the new attempt does not fill go, so a
replay under another schema leaves no stale rows. The manifest (one row per
table and batch) is written last, to ``{root}/manifest/batch_id=<id>/``.

Files name columns by field id (see ``TableSpec.physical``), so a column that
was dropped and declared again does not show what it held before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.contract import MANIFEST_DDL, QUARANTINE_DDL, Layout, escaped
from larkspur.session import settings_of
from larkspur.sources import storage
from larkspur.sources.catalog import TableSpec

#: Batches of one write, at most; a longer backlog is landed in parts.
BATCHES_AT_ONCE = 10_000
#: Splits of the log for each core, at least, as far as it has files or row groups.
SPLITS_PER_CORE = 4
#: Tasks that list the folders of a read, at most for each core. Spark's own limit
#: is a task a folder, which the driver takes longer to send than to list.
LISTERS_PER_CORE = 2
#: Manifest files that one task writes, as far as there are cores.
MANIFESTS_PER_TASK = 50
REJECTED = -1
#: Folders of landed files.
PLACE = ["outcome", "to_bucket", "to_namespace", "to_table", "batch_id"]


def listing(spark: SparkSession) -> dict[str, str]:
    """Settings under which a read of many folders is listed."""
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(LISTERS_PER_CORE * spark.sparkContext.defaultParallelism)}


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str], max_records: int | None = None) -> None:
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if max_records:
        w = w.option("maxRecordsPerFile", int(max_records))
    w.partitionBy(*partition_by).parquet(path)


def land(events: DataFrame, specs: list[TableSpec], layout: Layout, max_records: int) -> set[tuple[int, str]]:
    """A5: write the rows of ``project_tables`` in one pass and return the places
    that got rows: (a table's place in ``specs`` or REJECTED, batch).

    No file is written for a batch without rows (B14). Files hold at most
    ``max_records`` rows, the count bound of an event group."""
    to = {"to_bucket": F.lit("-"), "to_namespace": F.lit("-"), "to_table": F.lit("-")}
    accepted = F.col("reason").isNull()
    for i, s in enumerate(specs):
        mine = accepted & (F.col("_table") == i)
        for name, value in (("to_bucket", s.bucket_name), ("to_namespace", s.namespace), ("to_table", s.table_name)):
            to[name] = F.when(mine, F.lit(value)).otherwise(to[name])
    place = F.when(accepted, F.col("_table")).otherwise(F.lit(REJECTED))
    rejected = [F.when(~accepted, F.col(c)).alias(c) for c in ("reason", "detail", "namespace", "type", "source_partition", "source_offset", "value", "key", "source_ts", "log_name", "attempts")]
    seen = Observation()
    # a set of the filled places costs a row one lookup, however many batches
    # there are. The filter stays above it: below, it would be pushed down with
    # a copy of the whole projection.
    rows = events.withColumn("_place", place).observe(seen, F.collect_set(F.struct("_place", "batch_id")).alias("filled")).where("_place is not null").select(
        *rejected, *(s.row_name for s in specs), F.when(accepted, F.lit("accepted")).otherwise(F.lit("rejected")).alias("outcome"),
        *(c.alias(n) for n, c in to.items()), "batch_id")
    # the columns of all tables are too many for one generated method: without
    # whole-stage code they compile as split functions, and compile once. Files
    # are not packed into a task for each core: a round's rows lie in some of
    # the files only, and tasks that got none would leave their cores idle
    splits = str(SPLITS_PER_CORE * events.sparkSession.sparkContext.defaultParallelism)
    with settings_of(events.sparkSession, {"spark.sql.codegen.wholeStage": "false", "spark.sql.files.minPartitionNum": splits}):
        overwrite_partitions(rows, layout.landing, PLACE, max_records)
    return {(r["_place"], r["batch_id"]) for r in seen.get["filled"] or [] if r["_place"] is not None}


def landed_totals(spark: SparkSession, layout: Layout, paths: list[str]) -> dict[tuple, tuple[int, int]]:
    """Rows and bytes of folders of staged rows, by namespace, table and batch.
    No column is read: a file's footer tells its rows."""
    with settings_of(spark, listing(spark)):
        files = spark.read.schema(", ".join(f"{c} string" for c in PLACE)).option("basePath", layout.landing).parquet(*paths)
    keys = [F.coalesce(c, F.lit("")).alias(c) for c in PLACE[2:]]
    files = files.groupBy(*keys, F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size"))
    rows = files.groupBy(*PLACE[2:]).agg(F.sum("n").alias("n"), F.sum("size").alias("size")).collect()  # a row a folder
    return {tuple(r[c] for c in PLACE[2:]): (int(r["n"]), int(r["size"])) for r in rows}


def publish_landed(spark: SparkSession, specs: list[TableSpec], layout: Layout, batch_ids: list[str], filled: set[tuple[int, str]]) -> None:
    """The manifest of what was landed; folders that an earlier attempt
    at these batches filled and this one did not are removed."""
    staged = {(i, b): layout.staged(specs[i], b) for i, b in sorted(filled) if i != REJECTED}
    wanted = {storage.name_of(p) for p in staged.values()} | {storage.name_of(f"{layout.quarantine}/batch_id={escaped(b)}") for i, b in filled if i == REJECTED}
    for place, _ in storage.listed(spark, f"{layout.landing}/*/*/*/*"):
        for b in batch_ids:
            path = f"{place}/batch_id={escaped(b)}"
            if storage.name_of(path) not in wanted:
                storage.delete(spark, path)
    for b in set(batch_ids) - {b for _, b in staged}:
        storage.delete(spark, f"{layout.manifest}/batch_id={escaped(b)}")
    if staged:
        totals = landed_totals(spark, layout, list(staged.values()))
        rows = [(specs[i].namespace, specs[i].table_name, path, *totals[specs[i].namespace, specs[i].table_name, b], None, b) for (i, b), path in staged.items()]
        write_manifest(spark.createDataFrame(rows, MANIFEST_DDL), layout, len(rows))


def landed_schema(spec: TableSpec) -> T.StructType:
    return T.StructType([T.StructField(spec.row_name, spec.stored()), T.StructField("batch_id", T.StringType())])


def staged_rows(spark: SparkSession, spec: TableSpec, layout: Layout, paths: list[str] | None = None) -> DataFrame:
    """Staged rows as stored (columns by field id, position) with batch_id;
    only this table's columns are read."""
    base = layout.staged(spec)
    with settings_of(spark, listing(spark)):
        rows = spark.read.schema(landed_schema(spec)).option("basePath", base).parquet(*(paths or [base]))
    return rows.select(f"{spec.row_name}.*", "batch_id", "_metadata")


def read_staged(spark: SparkSession, spec: TableSpec, layout: Layout, batch_ids: list[str]) -> DataFrame:
    """Staged rows of ``batch_ids`` with the table's current columns and their
    position in the log.

    Only the named ``batch_id=`` folders are read, never the whole landing
    tree (which grows with every micro-batch); one that is missing raises."""
    if not batch_ids:
        return spark.createDataFrame([], T.StructType([*spec.struct().fields, *spec.stored().fields[-3:], T.StructField("batch_id", T.StringType())]))
    rows = staged_rows(spark, spec, layout, [layout.staged(spec, b) for b in batch_ids])
    return rows.select(*spec.from_physical(), *(f.name for f in spec.stored().fields[-3:]), "batch_id", "_metadata")


def write_manifest(manifest: DataFrame, layout: Layout, n_rows: int) -> None:
    """Publish manifest rows of the batches in ``manifest``, a file a batch."""
    writers = min(manifest.sparkSession.sparkContext.defaultParallelism, -(-n_rows // MANIFESTS_PER_TASK))
    overwrite_partitions(manifest.repartition(max(1, writers), "batch_id"), layout.manifest, ["batch_id"])


def read_manifest(spark: SparkSession, layout: Layout) -> DataFrame:
    """The manifest; empty before the first batch, an error if unreadable."""
    if not storage.exists(spark, layout.manifest):
        return spark.createDataFrame([], MANIFEST_DDL)
    with settings_of(spark, listing(spark)):
        return spark.read.schema(MANIFEST_DDL).parquet(layout.manifest)


def read_quarantine(spark: SparkSession, layout: Layout) -> DataFrame:
    if not storage.exists(spark, layout.quarantine):
        return spark.createDataFrame([], QUARANTINE_DDL)
    with settings_of(spark, listing(spark)):
        return spark.read.schema(QUARANTINE_DDL).parquet(layout.quarantine)
