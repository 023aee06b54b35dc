"""Parsing of dates, times, scores, minutes and packed goal cells.

Every parser maps bad input to null instead of failing (ANSI mode is on in
Spark 4, so only ``try_*`` forms are used).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _WS, _c, strip_ws

# Labels of the match period, by base minute (<=45, <=90, later).
PERIOD_FIRST_HALF = "1re mi-temps"
PERIOD_SECOND_HALF = "2e mi-temps"
PERIOD_EXTRA_TIME = "prolongation"

# Separators of a packed goal cell and the penalty marker.
GOAL_SEPARATOR = "|"
MINUTE_SEPARATOR = "·"
PENALTY_MARKER = "(P)"


# A calendar date, alone or followed by a time of day.
_ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def to_date_coerce(c, formats=("yyyy-MM-dd",), stripped: bool = False) -> Column:
    """Text to DATE trying each format in turn; unparsable gives null.

    ``stripped`` says that ``c`` is stripped text already.

    The default takes every ISO form: one or two digits for month and day, and
    a time of day behind it, which is dropped.
    """
    s = _c(c) if stripped else strip_ws(_c(c).cast("string"))
    if tuple(formats) != ("yyyy-MM-dd",):
        return F.coalesce(*[F.try_to_date(s, f) for f in formats])
    # The common form is told by its characters; only other texts meet the regex.
    plain = ((F.length(s) == 10) & (F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-")
             & (F.btrim(s, F.lit("0123456789-")) == "") & ~F.contains(s, F.lit("--")))
    return F.when(plain | s.rlike(_ISO_DATE), F.substring_index(F.substring_index(s, "T", 1), " ", 1).try_cast("date"))


def norm_time(c) -> Column:
    """``9:00`` → ``09:00``; anything that is not a time of day gives null."""
    s = strip_ws(_c(c))
    # Attempt the parse only on text shaped like ``H:mm`` / ``HH:mm``.
    shaped = (F.length(s).between(4, 5) & (F.substring(s, -3, 1) == ":")
              & (F.btrim(s, F.lit("0123456789:")) == ""))
    return F.when(shaped, F.date_format(F.try_to_timestamp(s, F.lit("H:mm")), "HH:mm"))


def parse_kickoff(c) -> tuple[Column, Column]:
    """``13:00 (22:00)`` → (``13:00``, ``22:00``); ``17:00`` → (``17:00``, null).

    The pattern is matched at the start of the text only.
    """
    pat = rf"^{_WS}*(\d{{1,2}}:\d{{2}})(?:{_WS}*\((\d{{1,2}}:\d{{2}})\))?"
    local = F.nullif(F.regexp_extract(_c(c), pat, 1), F.lit(""))
    other = F.nullif(F.regexp_extract(_c(c), pat, 2), F.lit(""))
    return norm_time(local), norm_time(other)


def local_timestamp(date_text, time_text) -> Column:
    """Date text + ``HH:MM`` → TIMESTAMP_NTZ; null when either is missing or no date."""
    day = F.date_format(to_date_coerce(date_text), "yyyy-MM-dd")
    joined = F.concat_ws(" ", day, _c(time_text))
    return F.when(_c(time_text).isNotNull() & day.isNotNull(), joined.try_cast("timestamp_ntz"))


def split_score(c) -> tuple[Column, Column]:
    """Drop ``(n)`` shoot-out groups, then the first two integers; else nulls."""
    cleaned = F.regexp_replace(_c(c), r"\(\d+\)", "")
    nums = F.regexp_extract_all(cleaned, F.lit(r"(\d+)"), 1)
    ok = F.size(nums) >= 2
    return (F.when(ok, F.get(nums, 0).try_cast("bigint")),
            F.when(ok, F.get(nums, 1).try_cast("bigint")))


def _all_digits(t) -> Column:
    # Non-empty and made of ASCII digits only (no regex, no per-character map).
    return (F.length(t) > 0) & (F.btrim(t, F.lit("0123456789")) == "")


def parse_minute(c) -> Column:
    """``45`` → (45, 0, 45); ``90+7`` → (90, 7, 97); else (null, null, null).

    Returns a struct ``<minute, stoppage_time, minute_absolute>`` of bigints.
    The token must be digits, optionally ``+`` digits, once stripped.
    """
    parts = F.split(strip_ws(_c(c)), r"\+")
    return minute_of_parts(parts)


def minute_of_parts(parts) -> Column:
    """:func:`parse_minute` of a stripped token that is already split at ``+``."""
    parts = _c(parts)
    n = F.size(parts)
    head, tail = F.get(parts, 0), F.get(parts, 1)
    ok = F.coalesce(_all_digits(head) & ((n == 1) | ((n == 2) & _all_digits(tail))), F.lit(False))
    base = F.when(ok, head.try_cast("bigint"))
    added = F.when(ok, F.when(n == 2, tail.try_cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return F.struct(base.alias("minute"), added.alias("stoppage_time"),
                    (base + added).alias("minute_absolute"))


def period_of_minute(c) -> Column:
    base = _c(c)
    return (F.when(base.isNull(), F.lit(None).cast("string"))
             .when(base <= 45, F.lit(PERIOD_FIRST_HALF))
             .when(base <= 90, F.lit(PERIOD_SECOND_HALF))
             .otherwise(F.lit(PERIOD_EXTRA_TIME)))


def goal_chunks(c) -> Column:
    """Packed cell → array of raw chunks split on ``|`` (a null cell gives [])."""
    return F.when(_c(c).isNotNull(), F.split(_c(c), r"\|")).otherwise(
        F.array().cast("array<string>"))


def parse_goal_chunk(x) -> Column:
    """One chunk ``name · minute`` → struct<scorer, minute_token>.

    The name and the minute are split at the last ``·`` (no separator: the
    whole chunk is the name and the minute is empty); ``(P)`` is removed.
    """
    x = _c(x)
    has_sep = F.contains(x, F.lit(MINUTE_SEPARATOR))
    minute = F.substring_index(x, MINUTE_SEPARATOR, -1)
    name = F.when(has_sep, F.substring(x, F.lit(1), F.length(x) - F.length(minute) - F.lit(1))) \
            .otherwise(x)
    name = strip_ws(F.replace(name, F.lit(PENALTY_MARKER), F.lit("")))
    return F.struct(name.alias("scorer"),
                    F.when(has_sep, strip_ws(minute)).otherwise(F.lit("")).alias("minute_token"))


def parse_goal_cell(c) -> Column:
    """Packed cell → array<struct<scorer, minute_token>> (empty chunks dropped).

    Chunks are separated by ``|``; the name and the minute are split at the
    last ``·``; the ``(P)`` marker is removed from the name.  A null cell
    gives an empty array.  Table jobs explode :func:`goal_chunks` and apply
    :func:`parse_goal_chunk` per row instead, which avoids lambda functions.
    """
    chunks = F.filter(F.transform(goal_chunks(c), strip_ws), lambda x: x != "")
    return F.transform(chunks, parse_goal_chunk)


def snapshot_date_from_name(c) -> Column:
    """First ``YYYY-MM-DD`` found in a file name, as DATE (null if none)."""
    txt = F.regexp_extract(_c(c), r"(\d{4}-\d{2}-\d{2})", 1)
    return F.try_to_date(F.nullif(txt, F.lit("")), "yyyy-MM-dd")


