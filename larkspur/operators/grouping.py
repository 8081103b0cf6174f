"""Count-bounded grouping of events per key in arrival order.

The reference appends events per ``namespace|type`` key (per source
partition, since its state is partitioned like the topic) and emits a group
as soon as it holds ``max_records`` events. In arrival order that is: the
n-th event of a key (0-based) belongs to group ``n div max_records``.

A plain ``row_number`` over (namespace, type, partition) would put every
event of a hot key into one task. Instead the rank is computed in two
levels: events are cut into fixed offset *blocks*; a small aggregate counts
events per (key, block) and a running sum over blocks gives each block's
starting rank; the rank inside a block comes from a window bounded by the
block size. Exact, and no task ever sees more than one block of one key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["namespace", "type", "source_partition"]
# Offsets per block: bounds the rows one window task sorts.
DEFAULT_BLOCK_OFFSETS = 1 << 20


def arrival_rank(events: DataFrame, block_offsets: int = DEFAULT_BLOCK_OFFSETS) -> DataFrame:
    """Add ``arrival_rank``: 0-based position of the event within its key,
    ordered by ``source_offset``."""
    blocked = events.withColumn("_block", F.floor(F.col("source_offset") / F.lit(block_offsets)))
    counts = blocked.groupBy(*KEY, "_block").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*KEY).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*KEY, "_block", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    # One row per (key, block): far smaller than the events. No broadcast
    # hint: adaptive execution sees the exact size of this shuffle output and
    # broadcasts it when it is under the threshold, else joins on the
    # (key, block) partitioning the window below already produces.
    local = Window.partitionBy(*KEY, "_block").orderBy("source_offset")
    ranked = blocked.withColumn("_local", F.row_number().over(local) - 1)
    return ranked.join(starts, [*KEY, "_block"]).select(
        *events.columns, (F.col("_start") + F.col("_local")).alias("arrival_rank")
    )


def assign_groups(events: DataFrame, max_records: int, block_offsets: int = DEFAULT_BLOCK_OFFSETS) -> DataFrame:
    """Add ``group_seq``: the count-bounded group of each event."""
    if max_records < 1:
        raise ValueError("max_records must be >= 1")
    ranked = arrival_rank(events, block_offsets)
    return ranked.withColumn("group_seq", F.floor(F.col("arrival_rank") / F.lit(max_records)).cast("bigint"))


def group_sizes(grouped: DataFrame) -> DataFrame:
    """Size and offset span of each group."""
    return grouped.groupBy(*KEY, "group_seq").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("source_offset").alias("first_offset"),
        F.max("source_offset").alias("last_offset"),
    )
