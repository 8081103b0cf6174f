"""Column builders. Every function returns a ``Column`` made of built-in
Spark expressions, so it stays inside whole-stage codegen."""

from larkspur.functions.coerce import attribute, coerce
from larkspur.functions.ids import event_ulid
from larkspur.functions.keys import group_key, split_key
from larkspur.functions.times import event_date, event_hour, parse_event_time

__all__ = [
    "attribute",
    "coerce",
    "event_ulid",
    "group_key",
    "split_key",
    "event_date",
    "event_hour",
    "parse_event_time",
]
