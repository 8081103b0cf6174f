"""Reads of committed tables.

Only files of merges named in the ledger are visible. ``read_table`` lists
exactly those merge directories (the ledger is filtered first, so the tree
is never listed as a whole) and adds an ``event_date`` predicate derived
from the ``event_time`` bounds, which prunes date directories; the
``event_time`` predicate itself is pushed to the Parquet reader and skips
row groups by their min/max statistics.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.contract import Layout
from larkspur.operators.publish import read_ledger
from larkspur.sources.catalog import POSITION, TableSpec


def _as_datetime(x) -> datetime | None:
    if x is None or isinstance(x, datetime):
        return x
    if isinstance(x, date):
        return datetime(x.year, x.month, x.day)
    return datetime.fromisoformat(str(x))


def _ntz(x: datetime):
    """TIMESTAMP_NTZ literal from text: independent of driver and session zones."""
    return F.lit(x.isoformat(sep=" ")).cast("timestamp_ntz")


def table_schema(spec: TableSpec, physical: bool = False) -> T.StructType:
    s = spec.physical() if physical else spec.struct()
    s = s.add("merge_id", T.StringType()).add("event_date", T.DateType())
    if spec.hourly:
        s = s.add("event_hour", T.IntegerType())
    return s


def visible_ledger(spark: SparkSession, layout: Layout, spec: TableSpec, as_of: int | None = None) -> DataFrame:
    led = read_ledger(spark, layout, spec.namespace, spec.table_name)
    if as_of is not None:
        led = led.where(F.col("merge_seq") <= F.lit(int(as_of)))
    return led


def time_predicate(start=None, end=None, hourly: bool = False):
    """``start <= event_time < end`` plus the derived ranges of ``event_date``
    and, in an hourly layout, of ``event_hour`` within the first and last day."""
    s, e = _as_datetime(start), _as_datetime(end)
    cond = F.lit(True)
    if s is not None:
        day = F.lit(s.date().isoformat()).cast("date")
        cond = cond & (F.col("event_time") >= _ntz(s)) & (F.col("event_date") >= day)
        if hourly:
            cond = cond & ((F.col("event_date") > day) | (F.col("event_hour") >= s.hour))
    if e is not None:
        last = e - timedelta(microseconds=1)
        day = F.lit(last.date().isoformat()).cast("date")
        cond = cond & (F.col("event_time") < _ntz(e)) & (F.col("event_date") <= day)
        if hourly:
            cond = cond & ((F.col("event_date") < day) | (F.col("event_hour") <= last.hour))
    return cond


def overlapping(ledger: DataFrame, start=None, end=None) -> DataFrame:
    """Ledger rows whose [min, max] event_time can hold rows in [start, end)."""
    s, e = _as_datetime(start), _as_datetime(end)
    if s is not None:
        ledger = ledger.where(F.col("max_event_time").isNull() | (F.col("max_event_time") >= _ntz(s)))
    if e is not None:
        ledger = ledger.where(F.col("min_event_time").isNull() | (F.col("min_event_time") < _ntz(e)))
    return ledger


def read_table(spark: SparkSession, root: str, spec: TableSpec, start=None, end=None,
               as_of: int | None = None, positions: bool = False) -> DataFrame:
    """Committed rows of one table, optionally in ``[start, end)`` and as of
    ledger sequence ``as_of`` (time travel, K4).

    Merges whose event-time span misses the range are not even listed: the
    ledger keeps each merge's min/max event_time, like a table manifest.
    ``positions`` adds where each row stood in its log (F1).
    """
    layout = Layout(root)
    led = overlapping(visible_ledger(spark, layout, spec, as_of), start, end)
    ids = [r["merge_id"] for r in led.select("merge_id").collect()]
    schema = table_schema(spec)
    position = POSITION.fields if positions else []
    if not ids:
        return spark.createDataFrame([], T.StructType([*schema.fields, *position]))
    base = layout.data(spec)
    df = (
        spark.read.schema(T.StructType([*table_schema(spec, physical=True).fields, *position]))
        .option("basePath", base)
        .parquet(*[f"{base}/merge_id={m}" for m in sorted(ids)])
    )
    if start is not None or end is not None:
        df = df.where(time_predicate(start, end, spec.hourly))
    return df.select(*spec.from_physical(), *schema.fieldNames()[len(spec.struct().fields):], *(f.name for f in position))


def view_name(spec: TableSpec) -> str:
    return f"{spec.namespace}__{spec.table_name}"


def register_views(spark: SparkSession, root: str, specs: list[TableSpec], as_of: int | None = None) -> dict:
    """Expose committed tables to SQL as temp views ``<namespace>__<table>``.

    Each view is the visible state at registration time (or ``as_of``).
    Filters on ``event_time`` push down to Parquet; add an ``event_date``
    predicate to prune date directories as well.
    """
    names = {}
    for spec in specs:
        read_table(spark, root, spec, as_of=as_of).createOrReplaceTempView(view_name(spec))
        names[(spec.namespace, spec.table_name)] = view_name(spec)
    return names
