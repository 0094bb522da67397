"""The fixed record contract and the shapes it takes on its way into the fact table.

Every other module builds its projections from ``FIELDS``, so a column is
declared once, here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH = "year_month"
#: Second partition key of the fact table: who wrote the rows.
WRITER = "writer"
ENVELOPE_KEY = "doses_aplicadas_pni"
SURROGATE = "Unnamed: 0"

# Column names, kinds and order of the fact table.
#   date   calendar date that keys the row, never null
#   date?  nullable calendar date
#   text   string, null means ""
#   text?  nullable string
#   byte   unsigned byte, null means 0
CONTRACT = """
data_vacina                             date
sigla_uf_paciente                       text
nome_uf_paciente                        text
nome_municipio_paciente                 text
codigo_municipio_paciente               text
codigo_paciente                         text
tipo_sexo_paciente                      text
numero_idade_paciente                   byte
nome_raca_cor_paciente                  text
codigo_raca_cor_paciente                text
codigo_pais_paciente                    text
nome_pais_paciente                      text
descricao_nacionalidade_paciente        text
numero_cep_paciente                     text
codigo_etnia_indigena_paciente          text?
nome_etnia_indigena_paciente            text?
sigla_vacina                            text
descricao_vacina                        text
codigo_vacina                           text
codigo_dose_vacina                      byte
descricao_dose_vacina                   text
codigo_vacina_fabricante                text?
descricao_vacina_fabricante             text
codigo_lote_vacina                      text
codigo_via_administracao                text
descricao_via_administracao             text
codigo_local_aplicacao                  text
descricao_local_aplicacao               text
codigo_estrategia_vacinacao             text
descricao_estrategia_vacinacao          text
codigo_vacina_categoria_atendimento     text?
descricao_vacina_categoria_atendimento  text?
codigo_vacina_grupo_atendimento         text?
descricao_vacina_grupo_atendimento      text?
codigo_condicao_maternal                text?
descricao_condicao_maternal             text?
sigla_uf_estabelecimento                text
nome_uf_estabelecimento                 text
nome_municipio_estabelecimento          text
codigo_municipio_estabelecimento        text
codigo_cnes_estabelecimento             text
nome_razao_social_estabelecimento       text
nome_fantasia_estalecimento             text
codigo_tipo_estabelecimento             text
descricao_tipo_estabelecimento          text
codigo_natureza_estabelecimento         text
descricao_natureza_estabelecimento      text
codigo_documento                        text
status_documento                        text
codigo_sistema_origem                   text
descricao_sistema_origem                text
codigo_origem_registro                  text?
descricao_origem_registro               text?
codigo_troca_documento                  text?
data_entrada_rnds                       date?
data_deletado_rnds                      date?
"""


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # date | text | byte
    nullable: bool
    key: bool = False

    @property
    def spark_type(self) -> T.DataType:
        # Spark has no unsigned byte: a short holds 0..255.
        return {"date": T.DateType(), "text": T.StringType(), "byte": T.ShortType()}[self.kind]


def _fields() -> list[Field]:
    out = []
    for line in CONTRACT.split("\n"):
        if line.strip():
            name, kind = line.split()
            optional = kind.endswith("?")
            kind = kind.rstrip("?")
            out.append(Field(name, kind, optional, key=kind == "date" and not optional))
    return out


FIELDS = _fields()
CANONICAL = [f.name for f in FIELDS]

FACT_SCHEMA = T.StructType([T.StructField(f.name, f.spark_type, f.nullable) for f in FIELDS])

#: Records as they arrive: every scalar is a string or null.
RAW_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in FIELDS])

#: One landed page. ``offset`` is a page number, not a row number.
PAGE_SCHEMA = T.StructType(
    [
        T.StructField("offset", T.LongType()),
        T.StructField("limit", T.LongType()),
        T.StructField(ENVELOPE_KEY, T.ArrayType(RAW_SCHEMA)),
    ]
)

#: Month files: narrow integers may be null there, and no column is promised to exist.
EXCHANGE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.IntegerType() if f.kind == "byte" else f.spark_type)
        for f in FIELDS
    ]
)


def _legacy_type(f: Field) -> T.DataType:
    if f.name == "codigo_dose_vacina":
        return T.StringType()
    return T.IntegerType() if f.kind == "byte" else f.spark_type


#: The older 57-column table: a surrogate first column and a textual dose code.
LEGACY_SCHEMA = T.StructType(
    [T.StructField(SURROGATE, T.LongType())]
    + [T.StructField(f.name, _legacy_type(f), f.nullable) for f in FIELDS]
)


def to_schema(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` to ``schema``: same names, order and types.

    Columns ``df`` lacks become typed nulls and columns the schema lacks are
    dropped, except those named in ``keep``. A cast to the type a column already
    has is removed by the optimizer, so aligned input costs nothing.
    """
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        src = F.col(f"`{f.name}`") if f.name in have else F.lit(None)
        numeric = isinstance(f.dataType, T.IntegralType)
        cols.append((src.try_cast(f.dataType) if numeric else src.cast(f.dataType)).alias(f.name))
    return df.select(*cols, *[F.col(k) for k in keep if k in have])
