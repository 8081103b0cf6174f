"""Count-bounded grouping."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.operators.grouping import assign_groups, group_sizes


def test_limit_two_emits_one_full_group(spark):
    df = spark.createDataFrame(
        [("site", "page_actions", 0, 10), ("site", "page_actions", 0, 11)],
        "namespace string, type string, source_partition int, source_offset bigint",
    )
    g = group_sizes(assign_groups(df, 2)).collect()
    assert len(g) == 1 and g[0]["n_events"] == 2


def test_two_level_rank_equals_row_number_on_hot_key(spark):
    # one hot key holding most rows, tiny blocks so ranks cross many blocks
    df = spark.range(0, 5000).select(
        F.lit("site").alias("namespace"),
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("type"),
        (F.col("id") % 2).cast("int").alias("source_partition"),
        (F.col("id") * 3).alias("source_offset"),
    )
    got = assign_groups(df, 7, block_offsets=64)
    w = Window.partitionBy("namespace", "type", "source_partition").orderBy("source_offset")
    want = df.withColumn("want", F.floor((F.row_number().over(w) - 1) / 7))
    bad = got.join(want, ["namespace", "type", "source_partition", "source_offset"]).where(
        F.col("group_seq") != F.col("want")
    )
    assert bad.count() == 0
    assert got.count() == 5000
