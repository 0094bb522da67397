"""Tolerant conversions: bad input gives null or a default, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from doselake.functions.text import WHITE_SPACE

_DATE = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_INT = r"^[+-]?[0-9]+(_[0-9]+)*$"
_INT_SPACE = "".join(c for c in WHITE_SPACE if not "\x1c" <= c <= "\x1f")
_INT64_MIN, _INT64_MAX = -(2**63), 2**63 - 1


def date_prefix(c: Column) -> Column:
    """The calendar date before the first space; anything else is null.

    The zone suffix is dropped, not applied: going through a timestamp would
    move late-evening doses to the next day.
    """
    day = F.substring_index(c, " ", 1)
    valid = day.rlike(_DATE) & ~day.startswith("0000")
    return F.when(valid, day.try_cast("date"))


def whole_number(c: Column, default: int = 0) -> Column:
    """Text to bigint the way Python's ``int`` reads it; failures give ``default``.

    Numbers beyond 64 bits saturate, so that a later range check still rejects them.
    ``int`` does not take the separators U+001C..1F for white space.
    """
    s = F.trim(c, F.lit(_INT_SPACE))
    digits = F.replace(s, F.lit("_"), F.lit(""))
    saturated = F.when(digits.startswith("-"), F.lit(_INT64_MIN)).otherwise(F.lit(_INT64_MAX))
    parsed = F.coalesce(digits.try_cast("bigint"), saturated)
    return F.when(s.rlike(_INT), parsed).otherwise(F.lit(default).cast("bigint"))


def fits_byte(c: Column) -> Column:
    """True where a number fits an unsigned byte."""
    return c.between(0, 255)


def small_int(c: Column) -> Column:
    """Text to signed byte, null when it is not one."""
    return c.try_cast("tinyint")


def dose_digits(c: Column) -> Column:
    """Dose code as a number if it is plain digits in 0..127, else null."""
    n = c.try_cast("bigint")
    return F.when(c.rlike("^[0-9]+$") & n.between(0, 127), n.cast("tinyint"))
