from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from helpers import raw_row, rows
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from doselake.functions import convert, text
from doselake.operators import cleaning
from doselake.schema import CANONICAL, FACT_SCHEMA, FIELDS, RAW_SCHEMA, to_schema
from doselake.sources import legacy


def column(spark, values, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [tuple(r)[1:] for r in df.select("i", *exprs).orderBy("i").collect()]


def python_date(v):
    if v is None or v == "":
        return None
    try:
        return datetime.strptime(v.split(" ")[0], "%Y-%m-%d").date()
    except ValueError:
        return None


def python_int(v):
    try:
        return int(v)
    except (ValueError, TypeError):
        return 0


def test_contract_shape():
    assert len(CANONICAL) == len(set(CANONICAL)) == 56
    assert sum(f.kind == "text" and f.nullable for f in FIELDS) == 12
    assert sum(f.kind == "text" and not f.nullable for f in FIELDS) == 39
    assert [f.name for f in FIELDS if f.key] == ["data_vacina"]


@pytest.mark.parametrize(
    "value, want",
    [
        (None, None),
        ("", None),
        ("2025-13-06", None),
        ("2025-02-30", None),
        ("2025-01-06T00", None),
        (" 2025-01-06", None),
        ("25-01-06", None),
        ("12025-01-06", None),
        ("0000-01-01", None),
        ("2025-01", None),
        ("2025-1-6", date(2025, 1, 6)),
        ("2025-01-06 23:59:59-03", date(2025, 1, 6)),
        ("2024-02-29", date(2024, 2, 29)),
        ("2025-02-29", None),
    ],
)
def test_date_prefix(spark, value, want):
    assert column(spark, [value], convert.date_prefix(F.col("v"))) == [(want,)]
    assert python_date(value) == want


@pytest.mark.parametrize(
    "value, want",
    [
        (None, 0),
        ("", 0),
        ("abc", 0),
        ("1.5", 0),
        (" 12 ", 12),
        ("+7", 7),
        ("-3", -3),
        ("1_000", 1000),
        ("_1", 0),
        ("1__0", 0),
        (" 42　", 42),
        ("1e3", 0),
    ],
)
def test_whole_number(spark, value, want):
    assert column(spark, [value], convert.whole_number(F.col("v"))) == [(want,)]
    assert python_int(value) == want


def test_whole_number_saturates(spark):
    got = column(spark, ["9" * 30, "-" + "9" * 30], convert.whole_number(F.col("v")))
    assert got == [(2**63 - 1,), (-(2**63),)]


def test_text_rules(spark):
    values = [None, "\t a b \n", "  ", " y ", "　y", "\x1cz\x85"]
    got = column(
        spark, values, text.required_text(F.col("v")), text.optional_text(F.col("v"))
    )
    assert got == [("", None), ("a b", "a b"), ("", ""), ("y", "y"), ("y", "y"), ("z", "z")]


def test_strip_covers_python_white_space():
    assert set(text.WHITE_SPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


_PIECES = st.lists(
    st.sampled_from(list(text.WHITE_SPACE) + list("ab09-+_. é中")), max_size=12
).map("".join)


@settings(max_examples=4, deadline=None, phases=[Phase.generate])
@given(st.lists(_PIECES, min_size=100, max_size=200))
def test_strip_and_int_agree_with_python(spark, values):
    got = column(spark, values, text.strip(F.col("v")), convert.whole_number(F.col("v")))
    assert got == [(v.strip(), python_int(v)) for v in values]


def test_dates_agree_with_python(spark):
    rng = random.Random(7)
    values = [
        "-".join(
            str(rng.choice([rng.randint(0, 40), f"{rng.randint(0, 40):02d}", 2025, 1999, "x"]))
            for _ in range(rng.choice([2, 3, 3, 3, 3, 4]))
        )
        + rng.choice(["", " 00:00:00-03", "T1", "\t"])
        for _ in range(3000)
    ] + [f"{y}-{m}-{d}" for y in (1900, 2000, 2024) for m in range(0, 14) for d in (0, 1, 29, 30, 31)]
    got = column(spark, values, convert.date_prefix(F.col("v")))
    assert got == [(python_date(v),) for v in values]


def test_dose_conversions(spark):
    values = ["9", "200", "x", None, "127", "128", "-1", "+5", ""]
    got = column(spark, values, convert.small_int(F.col("v")), convert.dose_digits(F.col("v")))
    assert [g[0] for g in got] == [9, None, None, None, 127, None, -1, 5, None]
    assert [g[1] for g in got] == [9, None, None, None, 127, None, None, None, None]


def test_clean_record_defaults_and_unknown_fields(spark):
    df = spark.createDataFrame(
        [("2025-01-06 22:00:00-03", " SP ", "extra")],
        "data_vacina string, sigla_uf_paciente string, something_else string",
    )
    got = cleaning.clean_records(df)
    assert got.columns == CANONICAL
    assert [f.dataType for f in got.schema] == [f.dataType for f in FACT_SCHEMA]
    row = got.first()
    assert row["data_vacina"] == date(2025, 1, 6)
    assert row["sigla_uf_paciente"] == "SP"
    assert row["nome_pais_paciente"] == "" and row["codigo_troca_documento"] is None
    assert row["numero_idade_paciente"] == 0 and row["codigo_dose_vacina"] == 0


def test_bad_rows_are_set_aside_with_their_record(spark):
    records = [
        raw_row(codigo_documento="good"),
        raw_row(codigo_documento="no date", data_vacina="2025-02-30"),
        raw_row(codigo_documento="old", numero_idade_paciente="256"),
        raw_row(codigo_documento="huge", numero_idade_paciente="9" * 25),
        raw_row(codigo_documento="dose", codigo_dose_vacina="-1"),
        raw_row(codigo_documento="edge", numero_idade_paciente="255", codigo_dose_vacina="200"),
    ]
    df = spark.createDataFrame([[r[c] for c in CANONICAL] for r in records], RAW_SCHEMA)
    judged = cleaning.judge(df)
    kept = {r["codigo_documento"] for r in cleaning.accepted(judged).collect()}
    assert kept == {"good", "edge"}
    bad = cleaning.rejected(judged)
    got = {
        (r["d"], r["problem"])
        for r in bad.select("problem", F.get_json_object("raw", "$.codigo_documento").alias("d"))
        .collect()
    }
    assert got == {
        ("no date", "no valid data_vacina"),
        ("old", "numero_idade_paciente out of range"),
        ("huge", "numero_idade_paciente out of range"),
        ("dose", "codigo_dose_vacina out of range"),
    }
    assert "2025-02-30" in "".join(r["raw"] for r in bad.collect())


def test_load_defaults(spark):
    df = spark.createDataFrame(
        [("2025-01-06", None, None, None), (None, 5, 1, "SP"), ("2025-01-07", 300, 1, "RJ")],
        "data_vacina string, numero_idade_paciente int, codigo_dose_vacina int, "
        "sigla_uf_paciente string",
    ).withColumn("data_vacina", F.col("data_vacina").cast("date"))
    judged = cleaning.load_judge(df)
    row = cleaning.accepted(judged).first()
    assert (row["numero_idade_paciente"], row["codigo_dose_vacina"]) == (0, 0)
    assert row["sigla_uf_paciente"] == "" and row["codigo_troca_documento"] is None
    assert {r["problem"] for r in cleaning.rejected(judged).collect()} == {
        "no valid data_vacina",
        "numero_idade_paciente out of range",
    }


def test_legacy_round_trip(fact):
    assert rows(legacy.from_legacy(legacy.to_legacy(fact))) == rows(fact)
    assert len(legacy.to_legacy(fact).columns) == 57


def test_to_schema_keeps_order_and_fills(spark):
    df = spark.createDataFrame([(7, "2025-01-01")], "numero_idade_paciente long, data_vacina string")
    out = to_schema(df, FACT_SCHEMA)
    assert out.columns == CANONICAL
    assert out.first()["numero_idade_paciente"] == 7
