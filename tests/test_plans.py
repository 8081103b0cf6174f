"""Plan shape checks: the properties the design relies on at scale."""

from larkspur.operators.grouping import assign_groups
from larkspur.operators.validate import route
from larkspur.plans.lake import raw_batches
from larkspur.plans.queries import _decoded_for_grouping, _specs
from larkspur.sources.envelope import decode_envelope

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_routing_broadcasts_the_table_list(spark):
    plan = _plan(route(decode_envelope(raw_batches(spark, SF)), _specs(spark)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_grouping_window_is_bounded_by_blocks(spark):
    plan = _plan(assign_groups(_decoded_for_grouping(spark, SF), 500))
    windows = [line for line in plan.splitlines() if "row_number()" in line]
    assert windows and all("_block" in line for line in windows)


def test_ingest_scan_reads_only_needed_columns(spark):
    df = decode_envelope(raw_batches(spark, SF)).select("namespace", "type")
    plan = _plan(df)
    assert "ReadSchema: struct<value:string>" in plan


def test_merged_files_cover_disjoint_time_ranges(spark, root):
    from pyspark.sql import functions as F

    from larkspur.contract import Layout, Settings
    from larkspur.operators.compaction import merge_pending
    from larkspur.operators.ingest import ingest
    from larkspur.operators.read import read_table
    from larkspur.sources.catalog import PACKAGE_CATALOG, apply_all, live_tables

    apply_all(spark, PACKAGE_CATALOG, root)
    specs = live_tables(spark, root)
    ingest(spark, raw_batches(spark, "/root/testdata/sf0.01"), root, specs)
    # small target: several files per merge, so the range cut is exercised
    merge_pending(spark, Layout(root), specs, Settings(target_file_rows=500))
    for spec in specs:
        files = (
            read_table(spark, root, spec)
            .groupBy(F.col("_metadata.file_path").alias("f"), "event_date")
            .agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi"))
            .orderBy("event_date", "lo")
            .collect()
        )
        assert len(files) > len({r["event_date"] for r in files})  # several files on some day
        for a, b in zip(files, files[1:]):
            if a["event_date"] == b["event_date"]:
                assert a["hi"] <= b["lo"], (a, b)


def test_roundtrip_writes_attributes_once_a_decode(spark):
    """one text for the envelope and the comparison, one of what was decoded
    again; canonical text only where these two differ."""
    from larkspur.plans.queries import q_envelope_roundtrip

    plan = q_envelope_roundtrip(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJsonEvaluator(Map(),VariantType") == 3


def test_landing_makes_no_text_of_numeric_attributes(spark):
    from larkspur.operators.project import _shared_columns

    specs = tuple(_specs(spark))
    _, kinds, typed, _, pair = _shared_columns("test", specs)
    types: dict = {}
    for name, dt in pair:
        types.setdefault(name, set()).add(dt)
    worded = [name for name, dts in types.items() if dts - {"INT", "LONG", "FLOAT", "DOUBLE"}]
    assert 0 < len(worded) < len(types) and len(typed) == len(pair)
    assert len(kinds) == len(types) + len(worded)


def test_ledger_rows_need_no_python_worker(spark):
    import datetime as dt

    from larkspur.contract import LEDGER_DDL
    from larkspur.operators.publish import one_row

    row = {"namespace": "n", "type": "t'", "merge_id": "m", "merge_seq": 3, "committed_at": dt.datetime(2024, 3, 31, 2, 30), "schema_version": 1,
           "total_records": 5, "length": 7, "child_items": None, "child_batches": ["b\"1", "b\\2"], "max_load_time": None,
           "min_event_time": dt.datetime(2024, 1, 1, 0, 0, 0, 120001), "max_event_time": dt.datetime(1969, 12, 31, 23, 59, 59)}
    df = one_row(spark, row, LEDGER_DDL)
    assert "Scan OneRowRelation" in _plan(df) and df.first().asDict() == row
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in spark.createDataFrame([], LEDGER_DDL).schema]


def test_log_is_written_without_whole_stage_code(spark, monkeypatch):
    from tools import event_log

    seen = []
    monkeypatch.setattr(event_log, "_LANDED", {})
    monkeypatch.setattr(event_log, "settings_of", _spy(event_log.settings_of, seen))
    assert event_log.landed_records(spark, SF).count() == event_log.fixture_records(spark, SF).count()
    assert seen == [{"spark.sql.codegen.wholeStage": "false"}]
    assert spark.conf.get("spark.sql.codegen.wholeStage", "true") == "true"


def _spy(context, seen):
    def spied(spark, settings):
        seen.append(settings)
        return context(spark, settings)
    return spied


def test_folders_are_listed_by_few_tasks(spark, root):
    from larkspur.contract import MANIFEST_DDL, Layout
    from larkspur.operators.staging import LISTERS_PER_CORE, read_manifest, write_manifest

    rows = [("n", "t", f"/x/{k}", 1, 1, None, f"b{k:04d}") for k in range(150)]
    write_manifest(spark.createDataFrame(rows, MANIFEST_DDL), Layout(root), len(rows))
    sc = spark.sparkContext
    sc.setJobGroup("listing-test", "")
    try:
        assert read_manifest(spark, Layout(root)).schema.names == ["namespace", "type", "location", "total_records", "length", "child_items", "batch_id"]
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("listing-test")]
        tasks = [sc.statusTracker().getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert tasks and max(tasks) <= max(LISTERS_PER_CORE * sc.defaultParallelism, 1) < 150
