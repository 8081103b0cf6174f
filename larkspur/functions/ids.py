"""Event ids (B7): 26-character ULID text from built-in expressions.

The first 10 characters encode the event time in milliseconds (48 bits),
the last 16 encode 80 bits taken from a SHA-256 of a seed. The reference
seeds with a random UUID; here the seed is the source position, so a replay
of the same record produces the same id.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: base-32 digits as produced by conv(), and Crockford's alphabet
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
CROCKFORD = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"


def _b32(expr: Column, base: int, width: int) -> Column:
    return F.lpad(F.translate(F.conv(expr, base, 32), _CONV_DIGITS, CROCKFORD), width, "0")


def event_ulid(event_time: Column, *seed: Column) -> Column:
    # milliseconds since the epoch of a TIMESTAMP_NTZ, from its calendar
    # fields, so the result does not depend on the session time zone
    days = F.datediff(F.to_date(event_time), F.lit("1970-01-01").cast("date")).cast("bigint")
    millis = (
        days * 86_400_000
        + F.hour(event_time).cast("bigint") * 3_600_000
        + F.minute(event_time).cast("bigint") * 60_000
        + F.floor(F.date_part(F.lit("SECOND"), event_time) * 1000).cast("bigint")
    )
    digest = F.sha2(F.concat_ws("/", *[s.cast("string") for s in seed]), 256)
    return F.concat(
        _b32(millis.cast("string"), 10, 10),
        _b32(F.substring(digest, 1, 10), 16, 8),
        _b32(F.substring(digest, 11, 10), 16, 8),
    )
