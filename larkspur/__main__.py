"""Command line: ``python -m larkspur <command> ...``.

  apply  CATALOG_DIR ROOT [NAMESPACE TABLE]   apply one or all schema declarations
  ingest ROOT (--kafka SERVERS [--topic T] [--max-offsets N] | --files PATH [--max-files N])
         [--checkpoint DIR] [--once]
                                              run the ingest query (foreachBatch)
  merge  ROOT                                 merge and commit pending staged files
  report ROOT (pending|cleanup|freshness|quarantine)
  read   ROOT NAMESPACE TABLE [--start TS] [--end TS] [--as-of SEQ] [--out PATH]

ROOT defaults below the cluster's ``spark.checkpoint.dir`` when given as ``-``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _root(spark, root: str) -> str:
    from larkspur.session import shared_dir

    return f"{shared_dir(spark)}/lake" if root == "-" else root


def _print_all(df) -> None:
    """Every row as a line of JSON, a partition at a time."""
    for line in df.toJSON().toLocalIterator():
        print(line)


def main(argv=None) -> int:
    from larkspur.sources.stream import MAX_FILES_PER_TRIGGER, MAX_OFFSETS_PER_TRIGGER

    p = argparse.ArgumentParser(prog="larkspur")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("apply")
    a.add_argument("catalog_dir")
    a.add_argument("root")
    a.add_argument("namespace", nargs="?")
    a.add_argument("table", nargs="?")
    i = sub.add_parser("ingest")
    i.add_argument("root")
    src = i.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka")
    src.add_argument("--files")
    i.add_argument("--topic", default=None)
    i.add_argument("--max-offsets", type=int, default=MAX_OFFSETS_PER_TRIGGER, help="records per micro-batch (Kafka)")
    i.add_argument("--min-partitions", type=int, default=None, help="tasks per micro-batch (Kafka)")
    i.add_argument("--max-files", type=int, default=MAX_FILES_PER_TRIGGER, help="files per micro-batch (file source)")
    i.add_argument("--checkpoint", default=None)
    i.add_argument("--once", action="store_true", help="availableNow: process what is there and stop")
    i.add_argument("--max-buffer-records", type=int, default=None)
    i.add_argument("--max-buffer-time", default=None)
    i.add_argument("--merge-window", default=None)
    m = sub.add_parser("merge")
    m.add_argument("root")
    r = sub.add_parser("report")
    r.add_argument("root")
    r.add_argument("what", choices=["pending", "cleanup", "freshness", "quarantine"])
    rd = sub.add_parser("read")
    rd.add_argument("root")
    rd.add_argument("namespace")
    rd.add_argument("table")
    rd.add_argument("--start")
    rd.add_argument("--end")
    rd.add_argument("--as-of", type=int)
    rd.add_argument("--out")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"larkspur-{args.cmd}").getOrCreate()
    from larkspur.contract import Layout, Settings
    from larkspur.operators.staging import read_quarantine
    from larkspur.sources.catalog import apply_all, apply_schema, live_tables

    root = _root(spark, args.root)
    layout = Layout(root)
    if args.cmd == "apply":
        if args.namespace:
            print(apply_schema(spark, args.catalog_dir, root, args.namespace, args.table))
        else:
            for res in apply_all(spark, args.catalog_dir, root):
                print(res)
    elif args.cmd == "ingest":
        from larkspur.sources.stream import DATA_EVENTS_TOPIC, file_source, kafka_source
        from larkspur.streaming.ingest import final_merge, run_ingest

        kw = {k: v for k, v in {
            "max_buffer_records": args.max_buffer_records, "max_buffer_time": args.max_buffer_time,
            "pre_commit_merge_window": args.merge_window}.items() if v is not None}
        settings = Settings(**kw)
        source = (kafka_source(spark, args.kafka, args.topic or DATA_EVENTS_TOPIC,
                               max_offsets_per_trigger=args.max_offsets, min_partitions=args.min_partitions)
                  if args.kafka else file_source(spark, args.files, args.max_files, name=args.files))
        q = run_ingest(source, root, args.checkpoint or f"{root}/_checkpoint", settings,
                       trigger={"availableNow": True} if args.once else None)
        q.awaitTermination()
        if args.once:
            final_merge(spark, root, settings)
    elif args.cmd == "merge":
        from larkspur.operators.compaction import merge_pending

        for res in merge_pending(spark, layout, live_tables(spark, root)):
            print(res)
    elif args.cmd == "report":
        from larkspur.operators.compaction import pending_manifest
        from larkspur.operators.publish import cleanup_candidates, freshness

        if args.what == "pending":
            df = pending_manifest(spark, layout).groupBy("namespace", "type").agg(
                F.count_distinct("batch_id").alias("batches"), F.sum("total_records").alias("records"))
        elif args.what == "cleanup":
            df = cleanup_candidates(spark, layout).groupBy("namespace", "type").agg(
                F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        elif args.what == "freshness":
            df = freshness(spark, layout)
        else:
            df = read_quarantine(spark, layout).groupBy(
                "reason", "namespace", "type").count()
        _print_all(df)
    elif args.cmd == "read":
        from larkspur.operators.read import read_table

        spec = next(s for s in live_tables(spark, root)
                    if (s.namespace, s.table_name) == (args.namespace, args.table))
        df = read_table(spark, root, spec, start=args.start, end=args.end, as_of=args.as_of)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            _print_all(df)
    return 0


if __name__ == "__main__":
    sys.exit(main())
