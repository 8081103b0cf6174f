"""Session helpers: a local session for tests/bench, and the shared work
folder taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "larkspur", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a single-process local session may leave it unset (tests): a fresh
    folder is then created and set. On a cluster a machine-local folder would
    be invisible to the executors, so that raises.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="larkspur-ckpt-"))
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def work_root(spark: SparkSession, name: str) -> str:
    """A new, unique lakehouse root below the shared folder."""
    from larkspur.sources.storage import make_dirs

    root = f"{shared_dir(spark)}/larkspur/{name}-{uuid.uuid4().hex[:12]}"
    make_dirs(spark, root)
    return root


@contextmanager
def settings_of(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session while something is planned and run."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
