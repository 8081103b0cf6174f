"""A file source reads a folder's files and those of its folders, but not what a lake lands there."""

from larkspur.contract import RAW_SCHEMA
from larkspur.sources.stream import file_source


def test_landed_folders_are_not_part_of_the_log(spark, root):
    folders = ["more", "o", "out", "other", "outcomes", "d=1", "outcome=accepted/to_bucket=b", "outcome=rejected", "_ckpt"]
    for k, place in enumerate(["", *folders]):
        rows = spark.createDataFrame([(None, "v", 0, k, None)], RAW_SCHEMA).coalesce(1)
        rows.write.mode("append").parquet(f"{root}/log/{place}")
    for n, path in enumerate((f"{root}/log", f"{root}/log/", f"{root}/log/*.parquet")):
        query = file_source(spark, path, 1).writeStream.format("parquet").option("path", f"{root}/got{n}").option(
            "checkpointLocation", f"{root}/ckpt{n}").trigger(availableNow=True).start()
        query.awaitTermination()
        got = sorted(r["source_offset"] for r in spark.read.parquet(f"{root}/got{n}").collect())
        assert got == ([0] if n == 2 else list(range(7)))
