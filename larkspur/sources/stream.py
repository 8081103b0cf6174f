"""Event log sources.

Both produce the raw record columns of ``contract.RAW_SCHEMA``. The Kafka
connector is not part of this image; ``kafka_source`` only builds the
reader, and tests use ``file_source``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.contract import RAW_SCHEMA

# fixed value: topic of the incoming events
DATA_EVENTS_TOPIC = "dp-data-events"
# Records of one micro-batch at most; None takes all there are, so that the
# first batch of a long topic would be the whole of it.
MAX_OFFSETS_PER_TRIGGER = 1_000_000
MAX_FILES_PER_TRIGGER = 1_000


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str = DATA_EVENTS_TOPIC,
                 max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER, min_partitions: int | None = None,
                 **options) -> DataFrame:
    """Read the event topic from the earliest offset.

    Per-record work (JSON decode, coercion) is heavy compared with reading,
    so offset ranges are split into at least ``min_partitions`` tasks
    (default: the cluster's parallelism) even when the topic has few
    partitions - no shuffle needed.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("minPartitions", int(min_partitions or spark.sparkContext.defaultParallelism))
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        F.col("timestamp").cast("timestamp_ntz").alias("source_ts"),
        F.col("topic").alias("source_name"),
    )


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                name: str | None = None) -> DataFrame:
    """Raw records landed as Parquet files (same columns as the topic) in a
    folder or in the folders right below it.
    ``name`` tells logs apart that number their records alike. What a lake
    lands in the same folder (``outcome=…``) is not part of the log."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if not set(path) & set("*?[{"):  # a folder; a caller's own pattern stays as it is
        own = "outcome="
        others = [*(own[:k] for k in range(1, len(own))), *(f"{own[:k]}[^{own[k]}]*" for k in range(1, len(own))), "[^o_.]*"]
        path = f"{path.rstrip('/')}/{{{','.join(others)}}}"
    records = reader.parquet(path)
    return records if name is None else records.withColumn("source_name", F.lit(name))
