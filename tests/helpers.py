from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

from doselake.schema import CANONICAL


def plan(df: DataFrame) -> str:
    """The formatted physical plan as text."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def rows(df: DataFrame) -> list[tuple]:
    """All rows as tuples, in an order independent of the plan."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def raw_row(**values) -> dict:
    """A raw record that is good unless ``values`` says otherwise."""
    good = {c: "x" for c in CANONICAL} | {
        "data_vacina": "2025-01-06 00:00:00-03",
        "data_entrada_rnds": "2025-01-17 15:24:53-03",
        "data_deletado_rnds": None,
        "numero_idade_paciente": "1",
        "codigo_dose_vacina": "9",
    }
    return good | values
