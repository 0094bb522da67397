"""Identifier-shaped values from draws and digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from doselake.functions.draws import digit, int_div
from doselake.functions.text import zero_pad

# Parts of a vaccine lot code.
LOT_PREFIXES = ("23", "24", "25")
LOT_SUFFIXES = ("NA", "NB", "NC", "")


def _one_of(d: Column, values: Sequence[str], scale: int) -> Column:
    array = F.array(*[F.lit(v) for v in values])
    return F.get(array, digit(d, len(values), scale).cast("int"))


def patient_id(*identity: Column) -> Column:
    """64 hex digits."""
    return F.sha2(F.concat_ws(":", *[c.cast("string") for c in identity]), 256)


def pool_size(rows: Column) -> Column:
    """Patients per shard: 60 % of its rows, at least one, so that some get several doses."""
    return F.greatest(F.lit(1).cast("bigint"), int_div(rows.cast("bigint") * 6, F.lit(10)))


def pooled_patient(d: Column, rows: Column, *shard: Column) -> Column:
    """A patient of the shard's pool; ids repeat within a shard only."""
    return patient_id(*shard, F.lit("patient"), F.pmod(d, pool_size(rows)))


def document_id(hex32: Column) -> Column:
    """UUID shape plus version suffix, 41 characters, from 32 hex digits."""
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(hex32, p, n) for p, n in cuts], F.lit("i0b0"))


def lot_code(d: Column) -> Column:
    """Two digits, four letters, a number 001..999, and a suffix that may be empty."""
    letters = [F.chr(digit(d, 26, 12 * 26**i) + 65) for i in range(4)]
    number = zero_pad(digit(d, 999, 12 * 26**4) + 1, 3)
    return F.concat(_one_of(d, LOT_PREFIXES, 1), *letters, number, _one_of(d, LOT_SUFFIXES, 3))


def establishment_code(d: Column, scale: int = 1) -> Column:
    """Seven digits, 1000000..9999999."""
    return zero_pad(digit(d, 9_000_000, scale) + 1_000_000, 7)


def postal_code(d: Column, scale: int = 1) -> Column:
    """Five digits, 10000..99999."""
    return zero_pad(digit(d, 90_000, scale) + 10_000, 5)
