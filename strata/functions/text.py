"""Text normalisation as Column expressions (no Python UDFs).

Python's ``str.strip`` and ``\\s`` are Unicode-aware while Spark's ``trim`` only
removes ASCII spaces and Java's ``\\s`` is ASCII by default, so whitespace is
matched with an explicit class of every character Python treats as space.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's ``str.isspace`` defines it (29 characters, all
# below U+3001), derived from that rule rather than listed by hand.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
_OTHER_WS = PY_WHITESPACE.replace(" ", "")
# The same set as a regex class, for the few patterns that need it.
_WS = "[" + "".join(f"\\x{{{ord(ch):X}}}" for ch in PY_WHITESPACE) + "]"

# A white space that is no space, or two spaces.
_ODD_WS = "[" + "".join(f"\\x{{{ord(ch):X}}}" for ch in _OTHER_WS) + "]|  "

# Words substituted for symbols in snake_case names, in order.
SNAKE_SYMBOL_WORDS = (("%", "_pct"), ("+", "_plus_"), ("/", "_per_"))

# Fixed value: the marker removed from venues and turned into a flag.
NEUTRAL_SITE_MARKER = "(Neutral Site)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading and trailing Unicode whitespace (Python ``str.strip``).

    ``btrim`` with a character set: no regex on the hot path.
    """
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def collapse_ws(c) -> Column:
    """Collapse every whitespace run to one space, then strip.

    Other whitespace characters become spaces with ``translate`` and runs one
    space, but only in values that hold any: one regex tells.
    """
    t = F.translate(_c(c), _OTHER_WS, " " * len(_OTHER_WS))
    t = F.when(_c(c).rlike(_ODD_WS), F.regexp_replace(t, " {2,}", " ")).otherwise(_c(c))
    return F.btrim(t, F.lit(" "))


def canonical_label(c, mapping: dict[str, str] | None = None) -> Column:
    """Collapse whitespace, then replace exact matches through ``mapping``.

    Labels absent from the mapping are kept; null stays null.  The mapping is
    a literal map folded into the expression, which suits configuration-sized
    dictionaries; large ones belong in :func:`canonicalize_with_table`.
    """
    norm = collapse_ws(c)
    if not mapping:
        return norm
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, norm), norm)


def map_label(c, mapping: dict[str, str]) -> Column:
    """Exact-match replacement through ``mapping`` of an already normalised label."""
    if not mapping:
        return _c(c)
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, _c(c)), _c(c))


def canonicalize_with_table(df, column: str, table, key: str = "label",
                            value: str = "canonical"):
    """Canonicalise ``column`` of ``df`` through a mapping DataFrame.

    For dictionaries too large for a literal map.  The mapping is joined on the
    whitespace-collapsed label; Catalyst/AQE pick broadcast or shuffle from the
    measured size of the mapping table.
    """
    norm = "__strata_norm"
    out = df.withColumn(norm, collapse_ws(column))
    m = table.select(F.col(key).alias(norm), F.col(value).alias("__strata_canon"))
    out = out.join(m, on=norm, how="left")
    return (out.withColumn(column, F.coalesce(F.col("__strata_canon"), F.col(norm)))
               .drop(norm, "__strata_canon"))


def snake_name(label) -> str:
    """snake_case for a header label (driver side, one string).

    ``G+A`` gives ``g_plus_a``; an empty result gives ``col``.
    """
    text = str(label).strip()
    for sym, word in SNAKE_SYMBOL_WORDS:
        text = text.replace(sym, word)
    words = [w for w in re.split(r"[^0-9A-Za-z]+", text) if w]
    return "_".join(words).lower() or "col"


def snake_case(c) -> Column:
    """snake_case of a string column, same rule as :func:`snake_name`."""
    t = strip_ws(c)
    for sym, word in SNAKE_SYMBOL_WORDS:
        t = F.replace(t, F.lit(sym), F.lit(word))
    t = F.regexp_replace(t, r"[^0-9A-Za-z]+", "_")
    t = F.regexp_replace(t, r"^_+|_+$", "")
    return F.coalesce(F.nullif(F.lower(t), F.lit("")), F.lit("col"))


def empty_to_null(c) -> Column:
    return F.nullif(_c(c), F.lit(""))


def null_to_empty(c) -> Column:
    return F.coalesce(_c(c), F.lit(""))


def rsplit_last(c, sep: str) -> tuple[Column, Column]:
    """Split at the last ``sep``: (head, tail), both stripped.

    Without ``sep`` the head is the whole text and the tail is null (unlike
    ``substring_index``, which would return the whole text as the tail).
    """
    parts = F.split(_c(c), re.escape(sep))
    n = F.size(parts)
    head = F.when(n > 1, F.array_join(F.slice(parts, 1, n - 1), sep)).otherwise(_c(c))
    tail = F.when(n > 1, F.element_at(parts, -1))
    return strip_ws(head), strip_ws(tail)


def flag_and_strip(c, marker: str = NEUTRAL_SITE_MARKER) -> tuple[Column, Column]:
    """(contains-marker flag, text with marker and preceding spaces removed)."""
    flag = F.coalesce(F.contains(_c(c), F.lit(marker)), F.lit(False))
    removed = F.regexp_replace(_c(c), rf"{_WS}*{re.escape(marker)}", "")
    text = strip_ws(F.when(flag, removed).otherwise(_c(c)))
    return flag, text
