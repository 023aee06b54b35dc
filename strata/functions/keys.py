"""Deterministic content keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

# Separator and null rendering inside a content key.
KEY_SEPARATOR = "|"
KEY_NULL_TEXT = "None"


def row_key(*cols, length: int = 12) -> Column:
    """First ``length`` hex digits of md5 over ``a|b|c`` (null rendered ``None``).

    Dates render as ``yyyy-MM-dd``.  The same expression is used by every table
    that needs to recompute the key (matches and goals), so they join exactly.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(KEY_NULL_TEXT)) for c in cols]
    return F.substring(F.md5(F.concat_ws(KEY_SEPARATOR, *parts)), 1, length)
