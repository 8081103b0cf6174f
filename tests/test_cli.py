"""The command line drives the same functions (apply, ingest --once, report, read)."""

from larkspur.__main__ import main
from larkspur.sources.catalog import PACKAGE_CATALOG
from tools.event_log import landed_records


def test_cli_round_trip(spark, root, capsys):
    landing = f"{root}/landing"
    landed_records(spark, "/root/testdata/sf0.001").repartition(2).write.parquet(landing)
    assert main(["apply", PACKAGE_CATALOG, root]) == 0
    assert main(["ingest", root, "--files", landing, "--once", "--max-buffer-records", "300"]) == 0
    assert main(["report", root, "pending"]) == 0
    assert main(["report", root, "quarantine"]) == 0
    assert main(["read", root, "site", "page_actions", "--start", "2024-01-02", "--end", "2024-01-03"]) == 0
    out = capsys.readouterr().out
    assert "coercion_failed" in out and "event_id" in out
