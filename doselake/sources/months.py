"""Month-partitioned Parquet: scan, prune, discover, count, take stock."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doselake.functions.calendar import month_label, yyyymm
from doselake.schema import EXCHANGE_SCHEMA, FACT_SCHEMA, MONTH, WRITER


def _with_month(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(MONTH, T.StringType())])


def as_label(month: int | str) -> str:
    """``202501`` or ``"2025-01"`` to ``"2025-01"``."""
    s = str(month)
    return s if "-" in s else f"{s[:4]}-{s[4:6]}"


def read_months(
    spark: SparkSession,
    root: str,
    months: Iterable[int | str] | None = None,
    start: date | None = None,
    end: date | None = None,
    schema: T.StructType = FACT_SCHEMA,
) -> DataFrame:
    """Scan month partitions.

    ``months`` prunes partitions. ``start`` and ``end`` (inclusive) filter dose
    dates and, because a date filter alone prunes nothing, also add the month
    range it implies. The schema is given, never inferred: columns a file lacks
    read as null, and no file footer is opened for planning.
    """
    df = spark.read.schema(_with_month(schema)).parquet(root)
    # the fact table has writers below its months, a live table batches
    df = df.drop(*set(df.columns).difference(schema.names, [MONTH]))
    return in_months(df, months, start, end)


def in_months(
    df: DataFrame, months: Iterable[int | str] | None = None, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Rows of some months, of the days from ``start`` to ``end``."""
    if months is not None:
        df = df.where(F.col(MONTH).isin([as_label(m) for m in months]))
    if start is not None:
        df = df.where((F.col(MONTH) >= f"{start:%Y-%m}") & (F.col("data_vacina") >= F.lit(start)))
    if end is not None:
        df = df.where((F.col(MONTH) <= f"{end:%Y-%m}") & (F.col("data_vacina") <= F.lit(end)))
    return df


def read_exchange(spark: SparkSession, root: str, months=None) -> DataFrame:
    """Scan month files written elsewhere, whose columns may be missing or narrower."""
    return read_months(spark, root, months, schema=EXCHANGE_SCHEMA)


def read_parts(
    spark: SparkSession, root: str, schema: T.StructType = FACT_SCHEMA, months: Iterable[int | str] | None = None
) -> DataFrame:
    """Scan month partitions together with who wrote the rows."""
    keys = [T.StructField(MONTH, T.StringType()), T.StructField(WRITER, T.StringType())]
    return in_months(spark.read.schema(T.StructType(schema.fields + keys)).parquet(root), months)


def discover_months(spark: SparkSession, root: str) -> DataFrame:
    """The month labels present, sorted. Scans files; ``catalog_months`` does not."""
    found = spark.read.schema(_with_month(FACT_SCHEMA)).parquet(root)
    return found.select(MONTH).distinct().orderBy(MONTH)


def catalog_months(spark: SparkSession, name: str) -> DataFrame:
    """The month labels whose partitions the catalog lists for a table, sorted. Opens no file."""
    month = F.regexp_extract("partition", f"{MONTH}=([^/]*)", 1).alias(MONTH)
    return spark.sql(f"SHOW PARTITIONS {name}").select(month).distinct().orderBy(MONTH)


def count_records(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def count_by_month(df: DataFrame) -> DataFrame:
    """Rows per month, keyed by the month of the dose date itself."""
    month = yyyymm(F.col("data_vacina")).alias("yyyymm")
    return df.groupBy(month).agg(F.count(F.lit(1)).alias("n"))


def misplaced(df: DataFrame) -> DataFrame:
    """Rows whose dose date does not belong to the month they are stored in."""
    actual = month_label(F.col("data_vacina"))
    return df.where(~actual.eqNullSafe(F.col(MONTH)))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row per data file below a folder: path, bytes. From the listing; no file is read, files without rows count."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = files.option("pathGlobFilter", "*.parquet").load(root)
    return files.select("path", F.col("length").alias("bytes"))


def inventory_totals(files: DataFrame) -> DataFrame:
    """Number of files and bytes in an inventory."""
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes"),
    )


def inventory_sample(files: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` files by path."""
    return files.orderBy("path").limit(n)
