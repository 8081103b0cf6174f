"""Event-time parsing and partition transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the envelope's eventTime text, 'yyyy-MM-dd HH:mm:ss' (UTC)
EVENT_TIME_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def parse_event_time(text: Column) -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss`` -> TIMESTAMP_NTZ; anything else null.

    Parsed with a cast to TIMESTAMP_NTZ, so the result does not depend on
    the session time zone.
    """
    return F.when(text.rlike(EVENT_TIME_TEXT), text.try_cast("timestamp_ntz"))


def format_event_time(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> envelope text (second resolution), zone independent."""
    return F.substring(ts.cast("string"), 1, 19)


def event_date(ts: Column) -> Column:
    """Day transform of ``event_time``."""
    return F.to_date(ts)


def event_hour(ts: Column) -> Column:
    """Hour transform of ``event_time`` as TIMESTAMP_NTZ.

    ``date_trunc`` on NTZ yields a zoned timestamp; going through the text
    form keeps the wall-clock hour whatever the session zone is.
    """
    return F.concat(F.substring(ts.cast("string"), 1, 13), F.lit(":00:00")).try_cast(
        "timestamp_ntz"
    )
