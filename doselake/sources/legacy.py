"""The older table shape: surrogate first column, textual dose code, wider age."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doselake.operators.cleaning import accepted, load_judge
from doselake.schema import CANONICAL, LEGACY_SCHEMA, SURROGATE, to_schema


def judge_legacy(df: DataFrame) -> DataFrame:
    """Legacy rows with ``raw`` and ``problem``, ready for ``accepted`` and ``rejected``.

    Ages and dose codes outside 0 to 255 and dose codes that are no number are problems.
    """
    code = F.col("codigo_dose_vacina").cast("string")
    plain = code.rlike("^[0-9]{1,9}$")
    rows = df.drop(SURROGATE).withColumn(
        "codigo_dose_vacina", F.when(plain, code.try_cast("int")).when(code.isNotNull(), -1)
    )
    return load_judge(rows)


def from_legacy(df: DataFrame) -> DataFrame:
    """The legacy rows the fact table can hold; the others are left to ``rejected``."""
    return accepted(judge_legacy(df))


def to_legacy(df: DataFrame) -> DataFrame:
    """Canonical rows in the legacy shape, with a constant surrogate."""
    with_surrogate = df.select(F.lit(0).cast("bigint").alias(SURROGATE), *CANONICAL)
    return to_schema(with_surrogate, LEGACY_SCHEMA)
