"""Reproducible draws.

A draw is a function of a row's identity, not of the task that computes it: the
same row gets the same values whatever the partitioning, and a lost task can be
computed again. All sampling on top of draws is integer arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 15  # 60 bits: always a non-negative bigint


def digest(identity: Sequence[Column], salt: str) -> Column:
    """32 hex digits for (identity, salt)."""
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in identity], F.lit(salt)))


def hex_draw(d: Column, start: int = 1) -> Column:
    """A 60-bit draw from 15 digits of a digest. A digest holds two, at 1 and 16."""
    return F.conv(F.substring(d, start, HEX_DIGITS), 16, 10).cast("bigint")


def draw(identity: Sequence[Column], salt: str, method: str = "md5") -> Column:
    """A 60-bit draw. ``md5`` can be repeated by other engines, ``xxhash64`` is faster."""
    if method == "md5":
        return hex_draw(digest(identity, salt))
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(*identity, F.lit(salt)), 4)
    raise ValueError(f"unknown draw method {method!r}")


def digit(d: Column, below: int, scale: int = 1) -> Column:
    """One mixed-radix digit of a draw: uniform in ``[0, below)``.

    Several small draws can share one 60-bit draw by giving each the product of
    the ranges before it as ``scale``.
    """
    scaled = d if scale == 1 else int_div(d, F.lit(scale).cast("bigint"))
    return F.pmod(scaled, F.lit(below).cast("bigint"))


def int_div(a: Column, b: Column) -> Column:
    """Integer division; ``/`` would go through a double and lose the low bits."""
    return F.call_function("div", a, b)


def choose(d: Column, weighted: Sequence[tuple], position: int = 0, scale: int = 1) -> Column:
    """Pick from a short literal list of ``(value, ..., weight)`` tuples."""
    x = digit(d, sum(item[-1] for item in weighted), scale)
    out, upto = None, 0
    for item in weighted:
        upto += item[-1]
        cond, value = x < upto, F.lit(item[position])
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out
