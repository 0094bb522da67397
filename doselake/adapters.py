"""The driver tables seen as vaccination data.

The tables at hand hold no vaccination records, so the registered queries run on
two views of them. A column is one expression in the common subset of Spark SQL
and ANSI SQL, so the same text also makes the view in the checking database.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doselake.schema import CANONICAL, ENVELOPE_KEY, FIELDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(expr: str) -> str:
    return f"cast({expr} as string)"


# ---- lineitem as fact rows ------------------------------------------------------

# every age band at its edges
AGES = (0, 17, 18, 29, 30, 49, 50, 64, 65, 90)
_AGE_CASES = " ".join(f"when {i} then {a}" for i, a in enumerate(AGES))
_UF, _UF2, _CITY, _KIND = "l_suppkey % 3", "l_suppkey % 4", "l_suppkey % 25", "l_orderkey % 4"
_MAKER, _HAS_MAKER = "l_partkey % 5 + 100", "l_orderkey % 10 < 7"
_VACCINE = "concat(l_returnflag, '-', l_linestatus)"

_DOSE_EVENTS = {
    "sigla_uf_paciente": f"concat('U', {_s(_UF)})",
    "nome_uf_paciente": f"concat('State ', {_s(_UF)})",
    "nome_municipio_paciente": f"concat('City ', {_s(_CITY)})",
    "codigo_municipio_paciente": f"concat('35', lpad({_s(_CITY)}, 4, '0'))",
    "codigo_paciente": _s("l_partkey % 40"),
    "tipo_sexo_paciente": "case when l_orderkey % 100 < 52 then 'F' "
    "when l_orderkey % 100 < 99 then 'M' else 'I' end",
    "numero_idade_paciente": f"cast(case cast(l_quantity as int) % 10 {_AGE_CASES} end as smallint)",
    "nome_raca_cor_paciente": f"concat('R', {_s('l_orderkey % 3')})",
    "codigo_raca_cor_paciente": _s("l_orderkey % 3 + 1"),
    "codigo_pais_paciente": "'10'",
    "nome_pais_paciente": "'BRASIL'",
    "descricao_nacionalidade_paciente": "'B'",
    "numero_cep_paciente": f"lpad({_s('l_partkey % 10000')}, 5, '0')",
    "sigla_vacina": _VACCINE,
    "descricao_vacina": f"concat('Vaccine ', {_VACCINE})",
    "codigo_vacina": f"concat('v', {_VACCINE})",
    "codigo_dose_vacina": "cast(l_linenumber as smallint)",
    "descricao_dose_vacina": f"concat('Dose ', {_s('l_linenumber')})",
    "codigo_vacina_fabricante": f"case when {_HAS_MAKER} then {_s(_MAKER)} end",
    "descricao_vacina_fabricante": f"case when {_HAS_MAKER} then concat('Maker ', {_s(_MAKER)}) "
    "else '' end",
    "codigo_lote_vacina": f"concat('LOT', {_s('l_partkey')})",
    "codigo_via_administracao": _s("l_linenumber % 5"),
    "descricao_via_administracao": f"concat('Route ', {_s('l_linenumber % 5')})",
    "codigo_local_aplicacao": _s("l_linenumber % 2"),
    "descricao_local_aplicacao": f"concat('Site ', {_s('l_linenumber % 2')})",
    "codigo_estrategia_vacinacao": _s("l_orderkey % 9"),
    "descricao_estrategia_vacinacao": f"concat('Strategy ', {_s('l_orderkey % 9')})",
    "codigo_condicao_maternal": f"case when l_orderkey % 13 = 0 then {_s('l_orderkey % 2')} end",
    "sigla_uf_estabelecimento": f"concat('U', {_s(_UF2)})",
    "nome_uf_estabelecimento": f"concat('State ', {_s(_UF2)})",
    "nome_municipio_estabelecimento": f"concat('City ', {_s(_CITY)})",
    "codigo_municipio_estabelecimento": f"concat('35', lpad({_s(_CITY)}, 4, '0'))",
    "codigo_cnes_estabelecimento": f"lpad({_s('l_suppkey')}, 7, '0')",
    "nome_razao_social_estabelecimento": f"concat('HOUSE OF CITY ', {_s(_CITY)})",
    "nome_fantasia_estalecimento": f"concat('UNIT ', {_s(_CITY)})",
    "codigo_tipo_estabelecimento": f"lpad({_s(_KIND)}, 2, '0')",
    "descricao_tipo_estabelecimento": f"concat('Kind ', {_s(_KIND)})",
    "codigo_natureza_estabelecimento": _s("l_suppkey % 4 + 1"),
    "descricao_natureza_estabelecimento": f"concat('Nature ', {_s('l_suppkey % 4 + 1')})",
    "codigo_documento": "md5(concat_ws(':', "
    + ", ".join(_s(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    + "))",
    "status_documento": "'final'",
    "codigo_sistema_origem": _s("l_orderkey % 6"),
    "descricao_sistema_origem": f"concat('System ', {_s('l_orderkey % 6')})",
    "codigo_origem_registro": "case when l_orderkey % 17 = 0 then '99' end",
}

# days since 1995-01-01 folded into the first quarter of 2025
_SPARK_DOSE_DATE = (
    "date_add(date'2025-01-01', cast(pmod(datediff(cast(l_shipdate as date), "
    "date'1995-01-01'), 90) as int))"
)
_ANSI_DOSE_DATE = (
    "(date '2025-01-01' + cast(((cast(l_shipdate as date) - date '1995-01-01') % 90 + 90) % 90 "
    "as integer))"
)
_SPARK_ENTRY_DATE = f"date_add({_SPARK_DOSE_DATE}, cast(l_linenumber as int))"
_ANSI_ENTRY_DATE = f"({_ANSI_DOSE_DATE} + l_linenumber)"


def _dose_event_columns(dose_date: str, entry_date: str) -> dict[str, str]:
    special = {
        "data_vacina": f"cast({dose_date} as date)",
        "data_entrada_rnds": f"cast({entry_date} as date)",
        "data_deletado_rnds": "cast(null as date)",
    }
    return {c: special.get(c) or _DOSE_EVENTS.get(c, "cast(null as string)") for c in CANONICAL}


DOSE_EVENTS = _dose_event_columns(_SPARK_DOSE_DATE, _SPARK_ENTRY_DATE)
DOSE_EVENTS_ANSI = _dose_event_columns(_ANSI_DOSE_DATE, _ANSI_ENTRY_DATE)


def _view(df: DataFrame, columns: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.expr(e).alias(c) for c, e in columns.items()], *keep)


def dose_events(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fact rows from ``lineitem``; ``keep`` adds columns of the table itself."""
    return _view(table(spark, sf_dir, "lineitem"), DOSE_EVENTS, keep)


#: What ``DOSE_EVENTS`` reads, and the columns that rows are brought together and sorted by.
_LINE = "l_orderkey l_partkey l_suppkey l_linenumber l_returnflag l_linestatus l_shipdate".split()
_ORDERED = (
    "data_vacina sigla_uf_paciente sigla_vacina numero_idade_paciente sigla_uf_estabelecimento".split()
)


def dose_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that ``as_doses`` turns into fact rows: a few columns to shuffle and sort instead of 56."""
    made = [F.expr(DOSE_EVENTS[c]).alias(c) for c in _ORDERED]
    return table(spark, sf_dir, "lineitem").select(*_LINE, *made)


def as_doses(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The fact rows of ``dose_lines``, in their order, with the ``keep`` columns."""
    have = set(lines.columns)
    return lines.select(*[F.col(c) if c in have else F.expr(e).alias(c) for c, e in DOSE_EVENTS.items()], *keep)


# ---- events as raw records ------------------------------------------------------

NBSP, WIDE_SPACE = " ", "　"


def _raw_text(name: str, i: int) -> str:
    """A text field with planted nulls, blanks and padding."""
    if name == "codigo_documento":
        return f"concat(' doc-', {_s('event_id')}, '\t')"
    value = f"concat('{name[:12]} ', {_s('user_id % 50')})"
    return (
        f"case (event_id + {i}) % 11 when 0 then cast(null as string) when 1 then '' "
        f"when 2 then concat('\t ', {value}, ' \n') when 3 then concat('{NBSP}', {value}, '{NBSP}') "
        f"when 4 then concat('{WIDE_SPACE}', {value}) when 5 then '  ' else {value} end"
    )


_DAY = "cast(cast(ts as date) as string)"
_RAW_SPECIAL = {
    "data_vacina": "case event_id % 29 when 0 then null when 1 then '' when 2 then '2025-13-06' "
    "when 3 then '2025-1-6' when 4 then '2025-01-06 23:59:59-03' when 5 then ' 2025-01-06' "
    "when 6 then '2025-02-30' when 7 then '2025-01-06T00' "
    f"else concat({_DAY}, ' 00:00:00-03') end",
    "data_entrada_rnds": f"case event_id % 7 when 0 then null when 1 then {_DAY} "
    f"else concat({_DAY}, ' 15:24:53-03') end",
    "data_deletado_rnds": f"case event_id % 19 when 0 then {_DAY} when 1 then 'never' end",
    "numero_idade_paciente": "case event_id % 31 when 0 then null when 1 then '' "
    "when 2 then ' 12 ' when 3 then '1.5' when 4 then 'abc' when 5 then '+7' when 6 then '300' "
    "when 7 then '-1' when 8 then '1_0' when 9 then '99999999999999999999' "
    f"else {_s('user_id % 120')} end",
    "codigo_dose_vacina": "case event_id % 23 when 0 then null when 1 then 'x' when 2 then '200' "
    "when 3 then '9' when 4 then '-1' when 5 then '+5' when 6 then '300' when 7 then '127' "
    "when 8 then '128' when 9 then '1.5' "
    f"else {_s('event_id % 5')} end",
}

RAW_EVENTS = {
    f.name: _RAW_SPECIAL.get(f.name) or _raw_text(f.name, i) for i, f in enumerate(FIELDS)
}


def raw_events(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw all-text records from ``events``, with planted faults."""
    return as_records(table(spark, sf_dir, "events"), keep)


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that ``as_records`` turns into raw records: three columns to shuffle instead of 56, or their text."""
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts")


def as_records(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return _view(events, RAW_EVENTS, keep)


PAGE_LIMIT = 100
#: Rows that a landed file holds, about: a file packed with gzip is read by one task.
FILE_ROWS = 25_000
PACKED = {"compression": "gzip"}


def file_count(events: DataFrame, multiple: int = 1) -> int:
    """Files for so many records, a multiple of the given number."""
    return multiple * max(1, math.ceil(events.count() / (multiple * FILE_ROWS)))


def land_events(spark: SparkSession, sf_dir: str, path: str, files_multiple: int = 8) -> int:
    """The raw records as packed pages, as a fetcher would leave them; the number of files, a multiple of the given one.

    ``event_id`` is unique, so a page collects at most 100 rows. The few columns of ``events`` are shuffled; they become
    the 56 of a record, and text, in the task that writes them.
    """
    events = event_rows(spark, sf_dir)
    files = file_count(events, files_multiple)
    of_record = {c: re.sub(r"\b(event_id|user_id|ts)\b", r"x.\1", e) for c, e in RAW_EVENTS.items()}
    record = ", ".join(f"'{c}', {e}" for c, e in of_record.items())
    page = F.expr(f"event_id div {PAGE_LIMIT}").alias("offset")
    envelope = F.struct(
        "offset",
        F.lit(PAGE_LIMIT).cast("bigint").alias("limit"),
        F.expr(f"transform(records, x -> named_struct({record}))").alias(ENVELOPE_KEY),
    )
    (
        events.withColumn("offset", page)
        .repartitionByRange(files, "offset")
        .groupBy("offset")
        .agg(F.sort_array(F.collect_list(F.struct("event_id", "user_id", "ts"))).alias("records"))
        .select(F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"))
        .write.options(**PACKED)
        .text(path)
    )
    return files


# ---- orders as row identities ---------------------------------------------------

SHARD = 1000
GENERATED_MONTHS = ("2025-01", "2025-02", "2025-03")


def order_rows(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Row identities of a generator run: three months in shards of 1000 rows."""
    k = F.expr("o_orderkey div 3")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("2025-0"), (F.col("o_orderkey") % 3 + 1).cast("string")).alias("year_month"),
        F.call_function("div", k, F.lit(SHARD).cast("bigint")).alias("shard"),
        (k % SHARD).alias("row"),
        F.lit(SHARD).cast("bigint").alias("n_rows"),
        *keep,
    )
