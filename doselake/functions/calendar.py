"""Month arithmetic and month labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from doselake.functions.text import zero_pad


def yyyymm(d: Column) -> Column:
    """Date to an integer such as 202501."""
    return F.year(d) * 100 + F.month(d)


def month_label(d: Column) -> Column:
    """Date to a partition label such as ``2025-01``."""
    return F.date_format(d, "yyyy-MM")


def split_yyyymm(m: Column) -> tuple[Column, Column]:
    """Month integer to (year, month)."""
    return F.floor(m / 100).cast("int"), (m % 100).cast("int")


def label_of(m: Column) -> Column:
    """Month integer to its partition label."""
    year, month = split_yyyymm(m)
    return F.concat_ws("-", zero_pad(year, 4), zero_pad(month, 2))
