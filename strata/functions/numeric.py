"""Number coercion, rounding and indicators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, strip_ws


class FractionalValueError(ValueError):
    """Raised (as a Spark error) when strict integer coercion meets a fraction."""


# A failed text-to-number cast is handled with an exception inside Spark and
# costs ~100x a successful one, so cheap string checks decide which cast to
# attempt: only text that can be a number of that kind is ever cast.
_NUMBER_CHARS = "0123456789+-.eE"
# The words that stand for infinity, in lower case.
_INFINITY = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]


def _digits_only(t) -> Column:
    # All characters in the set <=> trimming the set leaves nothing (byte scan).
    return (F.length(t) > 0) & (F.btrim(t, F.lit("0123456789")) == "")


def to_double(c, stripped: bool = False) -> Column:
    """Text to DOUBLE; unparsable, NaN and empty give null.

    ``stripped`` says that ``c`` is stripped text already: wide jobs strip a
    column once, in a projection of its own, since each use of an expression
    computes it again.

    Only digits, sign, point and a decimal exponent, or a word for infinity:
    the type suffixes (``12d``) and hexadecimal forms that a cast also takes
    are not numbers here.
    """
    s = _c(c) if stripped else strip_ws(_c(c).cast("string"))
    decimal = (F.length(s) > 0) & (F.btrim(s, F.lit(_NUMBER_CHARS)) == "")
    return F.when(decimal | F.lower(s).isin(*_INFINITY), s.try_cast("double"))


def to_long(c, strict: bool = False, stripped: bool = False) -> Column:
    """Text to nullable BIGINT.

    Integers parse exactly (no detour through double); ``64.0`` gives 64;
    non-numbers give null.  A fractional value is an error when ``strict``
    (the source semantics) and null otherwise.
    """
    s = _c(c) if stripped else strip_ws(_c(c).cast("string"))
    exact = F.when(_digits_only(F.ltrim(s, F.lit("+-"))), s.try_cast("bigint"))
    # "64.0", "-3.00", "17.": integer part plus a fraction of zeros, by text.
    head = F.substring_index(s, ".", 1)
    tail = F.substring_index(s, ".", -1)
    one_dot = (F.instr(s, ".") > 0) & (F.length(head) + F.length(tail) + 1 == F.length(s))
    dotted = F.when(one_dot & _digits_only(F.ltrim(head, F.lit("+-")))
                    & (F.btrim(tail, F.lit("0")) == ""), head.try_cast("bigint"))
    # Anything else that may be a number ("1e3", "12.5") goes through double.
    d = to_double(s, stripped)
    whole = F.when(d == F.floor(d), d.try_cast("bigint"))
    value = F.coalesce(exact, dotted, whole)
    if strict:
        bad = value.isNull() & to_double(s, stripped).isNotNull()
        return F.when(bad, F.raise_error(F.concat(F.lit("fractional value for integer column: "), s))
                      .cast("bigint")).otherwise(value)
    return value


def round_half_even(c, digits: int) -> Column:
    """Round by scale, round-half-even, unscale (numpy's algorithm).

    0.125 → 0.12 and 1.005 → 1.0 for two digits, unlike Spark's ``round``.
    """
    scale = float(10 ** digits)
    if digits == 0:
        return F.rint(_c(c))
    return F.rint(_c(c) * F.lit(scale)) / F.lit(scale)


def indicator(cond: Column) -> Column:
    """Boolean condition as 0/1; a null comparison counts as 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def sum_or_zero(c) -> Column:
    """SUM that gives 0 over an all-null or empty group."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def both_present(a, b) -> Column:
    return _c(a).isNotNull() & _c(b).isNotNull()
