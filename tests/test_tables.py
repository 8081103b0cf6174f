"""Tables in Spark's catalog, table functions, packing, the manifest as a stream,
retry of the quarantine, and that written rows are not read again."""

import pytest
from pyspark.sql import functions as F

from larkspur.contract import Layout, Settings
from larkspur.operators import compaction, packing, tables
from larkspur.operators.compaction import merge_pending
from larkspur.operators.ingest import ingest
from larkspur.operators.project import project_tables
from larkspur.operators.publish import read_ledger
from larkspur.operators.read import read_table
from larkspur.operators.retry import retry_quarantine
from larkspur.operators.staging import read_quarantine
from larkspur.operators.validate import route
from larkspur.sources.catalog import apply_schema, live_tables
from larkspur.sources.envelope import decode_envelope
from larkspur.streaming.merges import run_merges
from tests.test_staging import AT, declare, lake, records, table, values  # noqa: F401


def commit(spark, root, rows, batch):
    ingest(spark, records(spark, rows, batch), root, live_tables(spark, root))
    merge_pending(spark, Layout(root), live_tables(spark, root))


def test_another_session_reads_by_name_and_follows_the_schema(spark, lake):  # noqa: F811
    root, cat = lake
    layout, prefix = Layout(root), "t1x_"
    commit(spark, root, [("t1", {"k": k}, AT) for k in range(3)], "b0")
    assert tables.sync_tables(spark, layout, live_tables(spark, root), prefix) == {"t1": 1, "t2": 0}
    other = spark.newSession()
    assert other.table("t1x_ns.t1").agg(F.sum("k")).first()[0] == 3
    assert tables.sync_tables(spark, layout, live_tables(spark, root), prefix) == {"t1": 0, "t2": 0}
    declare(cat, "t1", [("k", "INT"), ("s", "STRING")])
    apply_schema(spark, cat, root, "ns", "t1")
    commit(spark, root, [("t1", {"k": 10, "s": "new"}, AT)], "b1")
    assert other.table("t1x_ns.t1").count() == 3  # not registered yet
    assert tables.sync_tables(spark, layout, live_tables(spark, root), prefix)["t1"] == 1
    got = spark.newSession().table("t1x_ns.t1").select("k", "s", "log_offset").collect()
    assert sorted((r["k"], r["s"]) for r in got) == [(0, None), (1, None), (2, None), (10, "new")]


def test_functions_prune_by_time_alone(spark, lake):  # noqa: F811
    root, cat = lake
    declare(cat, "t3", [("k", "INT")], partition="HOUR")
    apply_schema(spark, cat, root, "ns", "t3")
    commit(spark, root, [("t3", {"k": k}, f"2025-03-0{1 + k % 3} {10 + k % 4}:00:00") for k in range(24)], "b0")
    spec = table(spark, root, "t3")
    tables.sync_tables(spark, Layout(root), [spec], "t3x_")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    rows = tables.between(spark, spec, "2025-03-02 11:00:00", "2025-03-02 13:00:00", "t3x_")
    want = [k for k in range(24) if k % 3 == 1 and 11 <= 10 + k % 4 < 13]
    assert sorted(r["k"] for r in rows.collect()) == want
    plan = rows._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "event_date" in filters and "event_hour" in filters


def test_packing_and_a_rewrite_that_keeps_every_row(spark, lake):  # noqa: F811
    root, _ = lake
    for n in range(5):
        commit(spark, root, [("t1", {"k": 10 * n + k}, f"2025-03-0{1 + k % 3} 10:00:00") for k in range(4)], f"b{n}")
    spec, layout = table(spark, root), Layout(root)
    tables.sync_tables(spark, layout, [spec], "pk_")
    name = tables.table_name(spec, "pk_")
    before = sorted(tuple(r) for r in spark.table(name).collect())
    done = packing.rewrite_table(spark, layout, spec, 10, prefix="pk_")
    assert [len(ids) for _, ids in done] == [3, 2]
    assert sorted(tuple(r) for r in spark.newSession().table(name).collect()) == before
    assert tables.registered_merges(spark, spec, "pk_") == {m for m, _ in done}


def test_packs_against_a_running_sum(spark):
    rows = [("n", "t", f"b{k:04d}", (k * 37) % 11) for k in range(500)]
    got = packing.packed(spark.createDataFrame(rows, "namespace string, type string, batch string, n long").repartition(5), "n", 40, "batch").collect()
    total, want = 0, {}
    for _, _, b, n in rows:
        want[b], total = total // 40, total + n
    assert {r["batch"]: r["pack"] for r in got} == want


def test_manifest_stream_reads_only_what_is_new(spark, lake, monkeypatch):  # noqa: F811
    root, _ = lake
    layout, seen = Layout(root), []
    monkeypatch.setattr(compaction, "read_manifest", lambda *a: pytest.fail("the whole manifest was read"))
    monkeypatch.setattr(compaction, "read_ledger", lambda *a: pytest.fail("the ledger was read"))
    real = compaction.merge_table

    def failing(session, lay, spec, *rest):
        if spec.table_name == "t2" and len(seen) == 1:
            raise OSError("t2 is broken")
        return real(session, lay, spec, *rest)

    from larkspur.streaming import merges

    monkeypatch.setattr(compaction, "merge_table", failing)
    for n in range(4):
        rows = [("t1", {"k": n}, AT), ("t2", {"k": n}, AT)]
        ingest(spark, records(spark, rows, f"b{n}"), root, live_tables(spark, root))
        if n == 2:  # published a second time: taken once
            ingest(spark, records(spark, [("t1", {"k": 0}, AT)], "b0"), root, live_tables(spark, root))
        query = merges.run_merges(spark, root, f"{root}/merges", trigger={"availableNow": True})
        query.awaitTermination()
        assert query.exception() is None
        seen.append(sum(p["numInputRows"] for p in query.recentProgress))
    monkeypatch.undo()
    assert seen == [2, 2, 3, 2]
    assert values(spark, root, "t1") == [0, 1, 2, 3] and values(spark, root, "t2") == [0, 1, 2, 3]
    ledger = read_ledger(spark, layout).groupBy("type").agg(F.count("*").alias("n"), F.count_distinct("merge_seq").alias("s")).orderBy("type").collect()
    assert [tuple(r) for r in ledger] == [("t1", 4, 4), ("t2", 3, 3)]  # the failed one came with the next
    assert run_merges is merges.run_merges


def test_retry_moves_rows_when_a_schema_takes_them(spark, lake):  # noqa: F811
    root, cat = lake
    rows = [("t1", {"k": 1}, AT), ("t1", {"k": "x"}, AT), ("t9", {"k": 5}, AT), ("t9", {"k": "y"}, AT), ("t8", {"k": 5}, AT)]
    ingest(spark, records(spark, rows), root, live_tables(spark, root))
    layout = Layout(root)
    state = lambda: sorted((r["type"], r["reason"], r["attempts"]) for r in read_quarantine(spark, layout).collect())
    assert state() == [("t1", "coercion_failed", 0), ("t8", "unregistered_type", 0), ("t9", "unregistered_type", 0), ("t9", "unregistered_type", 0)]
    declare(cat, "t9", [("k", "INT")])
    apply_schema(spark, cat, root, "ns", "t9")
    retry_quarantine(spark, root)
    assert state() == [("t1", "coercion_failed", 1), ("t8", "unregistered_type", 1), ("t9", "coercion_failed", 1)]
    declare(cat, "t9", [("k", "STRING")])
    retry_quarantine(spark, root, most_attempts=1)  # none is left to try
    assert state() == [("t1", "coercion_failed", 1), ("t8", "unregistered_type", 1), ("t9", "coercion_failed", 1)]
    merge_pending(spark, layout, live_tables(spark, root), Settings())
    assert values(spark, root, "t1") == [1] and values(spark, root, "t9") == [5]


def test_one_scan_for_any_number_of_tables_and_positions(spark, lake):  # noqa: F811
    root, _ = lake
    rows = [("t1", {"k": k}, AT) for k in range(5)] + [("t2", {"k": k}, AT) for k in range(3)]
    specs = live_tables(spark, root)
    records(spark, rows).write.parquet(f"{root}/raw")
    raw = spark.read.parquet(f"{root}/raw")
    plan = project_tables(route(decode_envelope(raw), specs), specs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange hash" not in plan
    commit(spark, root, rows, "b0")
    got = read_table(spark, root, table(spark, root, "t2"), positions=True).orderBy("log_offset").select("k", "log_partition", "log_offset").collect()
    assert [tuple(r) for r in got] == [(0, 0, 5), (1, 0, 6), (2, 0, 7)]
