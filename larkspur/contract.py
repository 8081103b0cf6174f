"""Schemas, layout and settings shared by every module."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import timedelta

# --- fixed values that must equal the reference ---------------------------
# Columns every table carries ahead of its declared fields (field ids 1-4).
COMMON_FIELDS = ("event_id", "tenant_id", "load_time", "event_time")
# Data types a catalog file may declare, and the extra ones the ingest path
# still coerces when a live table has them.
DECLARABLE_TYPES = ("STRING", "INT", "LONG", "TIMESTAMP", "DATE")
COERCIBLE_TYPES = DECLARABLE_TYPES + ("FLOAT", "DOUBLE", "BOOLEAN")
# Partition transforms: HOUR gives an hourly layout, anything else is daily.
PARTITION_HOUR = "HOUR"
PARTITION_DAY = "DAY"
# Envelope time format (UTC).
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# README defaults for the tuning knobs.
DEFAULT_MAX_BUFFER_RECORDS = 2000
DEFAULT_MAX_BUFFER_TIME = "PT2M"
DEFAULT_PRE_COMMIT_MERGE_WINDOW = "PT3M"
# Message texts of the schema-apply request.
MSG_SCHEMA_APPLIED = "Schema applied"
MSG_SCHEMA_NOT_FOUND = "Schema namespace or event name not found"
# ---------------------------------------------------------------------------

SPARK_TYPES = {
    "STRING": "string",
    "INT": "int",
    "LONG": "bigint",
    "FLOAT": "float",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}

# Raw record as it comes off the log (Kafka value cast to string plus its
# position). A file source delivers the same columns.
RAW_SCHEMA = (
    "key string, value string, source_partition int, source_offset bigint, "
    "source_ts timestamp_ntz"
)

# Envelope fields; attributes stay semi-structured (number vs text matters).
ENVELOPE_DDL = (
    "namespace string, type string, tenantId string, eventTime string, "
    "attributes variant, _corrupt string"
)

MANIFEST_DDL = (
    "namespace string, type string, location string, total_records bigint, "
    "length bigint, child_items array<string>, batch_id string"
)

REJECTED_DDL = (
    "namespace string, type string, merge_id string, reason string, total_records bigint, "
    "length bigint, child_batches array<string>, rejected_at timestamp_ntz"
)

LEDGER_DDL = (
    "namespace string, type string, merge_id string, merge_seq bigint, "
    "committed_at timestamp_ntz, schema_version int, total_records bigint, "
    "length bigint, child_items array<string>, child_batches array<string>, "
    "max_load_time timestamp_ntz, min_event_time timestamp_ntz, max_event_time timestamp_ntz"
)

QUARANTINE_DDL = (
    "reason string, detail string, namespace string, type string, "
    "source_partition int, source_offset bigint, value string, key string, source_ts timestamp_ntz, "
    "log_name string, attempts int, batch_id string"
)

CATALOG_FILE_DDL = (
    "namespace string, tableName string, bucketName string, partitionType string, "
    "fields array<struct<id:int, name:string, dataType:string, deprecated:boolean>>"
)

# Rejection reasons, in the order they are checked.
R_NULL_EVENT = "null_event"              # B1: null/empty value, dropped by the reference
R_UNDECODABLE = "undecodable_envelope"   # Q1
R_BAD_EVENT_TIME = "bad_event_time"      # Q1 (eventTime text not in the envelope format)
R_EMPTY_TYPE = "empty_type"              # B1
R_NULL_NAMESPACE = "null_namespace"      # V3
R_UNREGISTERED = "unregistered_type"     # Q5 / J1
R_NULL_TENANT = "null_tenant"            # Q2 / B3
R_COERCION = "coercion_failed"           # Q4
R_COMMIT_GUARD = "commit_guard"          # Q3 / B13


def escaped(value: str) -> str:
    """A partition value as Spark writes it in a folder's name."""
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return re.sub(r"""[\x00-\x1f\x7f"#%'*/:=?\\{}\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)


class Layout:
    """Directory layout of one lakehouse root (see README)."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def table(self, spec) -> str:
        """A table's own folder: several tables may share a bucket."""
        return f"{self.root}/{spec.bucket_name}/{spec.namespace}/{spec.table_name}"

    @property
    def landing(self) -> str:
        """What ingest writes, accepted rows and rejected ones, in one pass."""
        return f"{self.root}/landing"

    def staged(self, spec, batch_id: str | None = None) -> str:
        """Staged rows of a table, or of one batch of it."""
        parts = [("outcome", "accepted"), ("to_bucket", spec.bucket_name or ""), ("to_namespace", spec.namespace), ("to_table", spec.table_name)]
        parts += [("batch_id", batch_id)] if batch_id is not None else []
        return "/".join([self.landing, *(f"{k}={escaped(v)}" for k, v in parts)])

    def data(self, spec) -> str:
        return f"{self.table(spec)}/data"

    @property
    def rejected(self) -> str:
        """Merges that the commit guard refused (Q3)."""
        return f"{self.root}/rejected_merges"

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def quarantine(self) -> str:
        return f"{self.landing}/outcome=rejected/to_bucket=-/to_namespace=-/to_table=-"

    @property
    def registry(self) -> str:
        return f"{self.root}/registry"


_DURATION = re.compile(
    r"^P(?:(?P<d>\d+)D)?(?:T(?:(?P<h>\d+)H)?(?:(?P<m>\d+)M)?(?:(?P<s>\d+(?:\.\d+)?)S)?)?$"
)


def parse_iso_duration(text: str) -> timedelta:
    """ISO-8601 duration as used by the tuning knobs (``PT2M``, ``PT30S``)."""
    m = _DURATION.match(text.strip().upper())
    if not m or text.strip().upper() in ("P", "PT"):
        raise ValueError(f"not an ISO-8601 duration: {text!r}")
    return timedelta(
        days=int(m["d"] or 0),
        hours=int(m["h"] or 0),
        minutes=int(m["m"] or 0),
        seconds=float(m["s"] or 0),
    )


@dataclass(frozen=True)
class Settings:
    max_buffer_records: int = DEFAULT_MAX_BUFFER_RECORDS
    max_buffer_time: str = DEFAULT_MAX_BUFFER_TIME
    pre_commit_merge_window: str = DEFAULT_PRE_COMMIT_MERGE_WINDOW
    # Target size of a merged file; drives the file count of a merge.
    target_file_bytes: int = 128 * 1024 * 1024
    # Rows per merged file when byte sizes are not known yet.
    target_file_rows: int = 2_000_000
    # Staged batches of one commit. A longer backlog takes several commits, all
    # made in the same run, so that what a commit lists stays bounded.
    max_batches_per_merge: int = 500

    @property
    def buffer_interval(self) -> str:
        return _as_trigger(parse_iso_duration(self.max_buffer_time))

    @property
    def merge_interval(self) -> timedelta:
        return parse_iso_duration(self.pre_commit_merge_window)


def _as_trigger(d: timedelta) -> str:
    return f"{int(d.total_seconds())} seconds"
