"""Exact distinct patients as bitmaps, which merge like the sketches do.

A sketch is exact up to 65,536 patients and an estimate beyond. Where exact counts are needed, patients get numbers
once, in a table of their own, and a state is a row of bitmaps: for each block of 32,768 numbers that
occur, one of 4 kB. Blocks of a key are counted and united apart, so a key with very many patients is spread over its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATIENT, NUMBER, BUCKET, STATE = "codigo_paciente", "patient_number", "bucket", "patients"
NUMBERS = f"{PATIENT} string, {NUMBER} bigint"


def number_patients(fact: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(codigo_paciente, patient_number) of patients ``known`` does not list yet. Store it: numbers are given anew each time.

    Numbers are dense within a task, so that few blocks hold them.
    """
    new = fact.select(PATIENT).where(F.col(PATIENT).isNotNull()).distinct()
    number = F.monotonically_increasing_id() + 1
    if known is not None:
        new = new.join(known, PATIENT, "left_anti")
        number = number + F.coalesce(known.agg(F.max(NUMBER)).scalar(), F.lit(0))
    return new.withColumn(NUMBER, number)


def patient_states(fact: DataFrame, numbers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, bucket, patients): bitmaps of the patients of every key.

    A patient is looked up once per key, so one with very many doses is no hot key.
    """
    pairs = fact.select(*keys, PATIENT).distinct().join(numbers, PATIENT)
    bucket = F.bitmap_bucket_number(NUMBER).alias(BUCKET)
    position = F.bitmap_bit_position(NUMBER)
    return pairs.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(position).alias(STATE))


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of fewer keys, or of rows from several tables."""
    return states.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(STATE).alias(STATE))


def count_patients(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct patients of each key, exactly. ``states`` are merged to ``keys`` before."""
    counts = F.coalesce(F.sum(F.bitmap_count(STATE)), F.lit(0)).alias("unique_patients")
    return merge_states(states, keys).groupBy(*keys).agg(counts)
