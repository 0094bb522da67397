"""Code to name lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side within both bounds is broadcast; beyond them Spark picks the join.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def size_of(df: DataFrame) -> tuple[Column, Column]:
    """Aggregates that measure ``df``: rows and bytes of its values."""
    width = sum(
        (
            F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
            if isinstance(f.dataType, T.StringType)
            else F.lit(8)
            for f in df.schema.fields
        ),
        F.lit(0),
    )
    return F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")


def fits_broadcast(rows: int, size: int) -> bool:
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Hint a broadcast after measuring that ``df`` is within the bounds.

    A larger side is returned as it is, for a shuffled join with AQE's skew handling.
    """
    rows, size = df.agg(*size_of(df)).first()
    return F.broadcast(df) if fits_broadcast(rows, size) else df


def first_names(dim: DataFrame, code: str, name: str, ordinal: str) -> DataFrame:
    """One name per code: of duplicates, the one with the lowest ordinal."""
    return (
        dim.where(F.col(code).isNotNull())
        .groupBy(code)
        .agg(F.min_by(name, ordinal).alias(name))
    )


def lookup_name(
    df: DataFrame, code: str, dim: DataFrame, dim_code: str, dim_name: str, ordinal: str, out: str
) -> DataFrame:
    """Add column ``out`` with the name of ``code``; unknown codes get the empty string."""
    names = first_names(dim, dim_code, dim_name, ordinal).select(
        F.col(dim_code).alias("_code"), F.col(dim_name).alias("_name")
    )
    joined = df.join(broadcast_if_small(names), F.col(code) == F.col("_code"), "left")
    return joined.withColumn(out, F.coalesce("_name", F.lit(""))).drop("_code", "_name")
