"""Group key ``namespace|type`` and its split (B2, C11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def group_key(namespace: Column, type_: Column) -> Column:
    """Display form of the key; grouping itself uses the two columns."""
    return F.concat_ws("|", namespace, type_)


def split_key(key: Column) -> tuple[Column, Column]:
    """``a|b|c`` -> (``a``, ``b``); parts after the second are ignored."""
    parts = F.split(key, r"\|")
    return parts.getItem(0), parts.getItem(1)
