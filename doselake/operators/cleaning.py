"""Raw text records to typed fact rows, with bad rows set aside instead of lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doselake.functions.convert import date_prefix, fits_byte, whole_number
from doselake.functions.text import optional_text, required_text
from doselake.schema import CANONICAL, FACT_SCHEMA, FIELDS, Field, to_schema

PROBLEM = "problem"
MALFORMED = "malformed record"


def _clean(f: Field, raw: Column) -> Column:
    if f.kind == "date":
        return date_prefix(raw)
    if f.kind == "byte":
        return whole_number(raw)
    return optional_text(raw) if f.nullable else required_text(raw)


def clean_columns(raw: DataFrame, fields: list[Field] = FIELDS) -> list[Column]:
    """The cleaning expression of each field; a column the input lacks counts as null."""
    have = set(raw.columns)
    return [
        _clean(f, F.col(f.name) if f.name in have else F.lit(None).cast("string")).alias(f.name)
        for f in fields
    ]


def _problem(corrupt: bool = False) -> Column:
    """The first reason the fact table cannot hold a row, or null."""
    checks = [F.when(F.col("corrupt").isNotNull(), F.lit(MALFORMED))] if corrupt else []
    for f in FIELDS:
        if f.key:
            checks.append(F.when(F.col(f.name).isNull(), F.lit(f"no valid {f.name}")))
        elif f.kind == "byte":
            checks.append(F.when(~fits_byte(F.col(f.name)), F.lit(f"{f.name} out of range")))
    return F.coalesce(*checks)


def judge(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cleaned columns, the ``keep`` columns, ``raw`` and ``problem`` (null for a good row).

    Numbers stay wide here, so that one out of range can be told from a good
    one. ``raw`` is the record as JSON, built for bad rows only. A ``corrupt``
    column in the input marks records that were not readable and holds their text.
    """
    corrupt = "corrupt" in raw.columns
    record = F.struct(*[c for c in raw.columns if c not in (*keep, "corrupt")])
    extra = [*keep, "corrupt"] if corrupt and "corrupt" not in keep else list(keep)
    judged = raw.select(*clean_columns(raw), *extra, record.alias("_record")).withColumn(
        PROBLEM, _problem(corrupt)
    )
    text = F.to_json("_record", {"ignoreNullFields": "false"})
    text = F.coalesce("corrupt", text) if corrupt else text
    return judged.withColumn("raw", F.when(F.col(PROBLEM).isNotNull(), text)).drop("_record")


def accepted(judged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Good rows in the canonical shape."""
    return to_schema(judged.where(F.col(PROBLEM).isNull()), FACT_SCHEMA, keep)


def rejected(judged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bad rows: the first problem found and the record as it came."""
    return judged.where(F.col(PROBLEM).isNotNull()).select(PROBLEM, "raw", *keep)


def clean_records(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw records to fact rows; rows that ``judge`` finds bad are left to ``rejected``."""
    return accepted(judge(raw, keep), keep)


def default_nulls(df: DataFrame) -> DataFrame:
    """Typed rows to fact rows: null becomes the type's default where null is not allowed.

    A null key date has no sensible default and numbers beyond a byte no faithful
    form, so both stay as they are for ``load_judge`` to set aside.
    """
    have = set(df.columns)
    cols = []
    for f in FIELDS:
        c = F.col(f.name) if f.name in have else F.lit(None)
        if f.kind == "byte":
            c = F.coalesce(c.try_cast("int"), F.lit(0))
        elif f.kind == "text":
            c = c.cast("string") if f.nullable else F.coalesce(c.cast("string"), F.lit(""))
        else:
            c = c.cast("date")
        cols.append(c.alias(f.name))
    return df.select(*cols, *[c for c in df.columns if c not in set(CANONICAL)])


def load_judge(df: DataFrame) -> DataFrame:
    """``default_nulls`` plus ``raw`` and ``problem``, ready for ``accepted`` and ``rejected``."""
    rows = default_nulls(df)
    judged = rows.withColumn(PROBLEM, _problem())
    record = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    text = F.when(F.col(PROBLEM).isNotNull(), record)
    return judged.withColumn("raw", text)
