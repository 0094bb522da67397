"""Frequency profile of a fact table: the weights synthetic records are drawn from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITEMS = ("item_1", "item_2", "item_3")

# The dimensions of the weight table and the columns of their items.
DIMENSIONS = {
    "vacina": ("sigla_vacina", "descricao_vacina", "codigo_vacina"),
    "dose": ("codigo_dose_vacina", "descricao_dose_vacina"),
    "municipio": (
        "codigo_municipio_estabelecimento",
        "nome_municipio_estabelecimento",
        "sigla_uf_estabelecimento",
    ),
    "uf": ("sigla_uf_paciente", "nome_uf_paciente"),
    "tipo_estabelecimento": ("codigo_tipo_estabelecimento", "descricao_tipo_estabelecimento"),
    "fabricante": ("codigo_vacina_fabricante", "descricao_vacina_fabricante"),
    "raca": ("codigo_raca_cor_paciente", "nome_raca_cor_paciente"),
    "idade": ("numero_idade_paciente",),
}


def frequency_profile(fact: DataFrame) -> DataFrame:
    """Rows per distinct item of every dimension: ``dimension, item_1..3, weight``.

    One scan serves all dimensions. Rows without a manufacturer do not count for
    that dimension, because its absence is drawn separately.
    """
    cells = []
    for name, columns in DIMENSIONS.items():
        values = [F.col(c).cast("string") for c in columns]
        values += [F.lit("")] * (len(ITEMS) - len(values))
        cells += [F.lit(name), *values]
    long = fact.select(F.stack(F.lit(len(DIMENSIONS)), *cells).alias("dimension", *ITEMS))
    return (
        long.where(F.col("item_1").isNotNull())
        .groupBy("dimension", *ITEMS)
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    """The weight table from a JSON file of lists ``{dimension: [[item, ..., count], ...]}``.

    ``ordinal`` keeps the position in the list: of duplicate codes the first name wins.
    """
    lists = T.ArrayType(T.ArrayType(T.StringType()))
    schema = T.StructType([T.StructField(name, lists) for name in DIMENSIONS])
    document = spark.read.schema(schema).option("multiLine", True).json(path)
    named = F.array(
        *[F.struct(F.lit(n).alias("dimension"), F.col(n).alias("rows")) for n in DIMENSIONS]
    )
    rows = document.select(F.explode(named).alias("d")).select(
        "d.dimension", F.posexplode("d.rows").alias("ordinal", "row")
    )
    has = F.size("row") - 1  # the last entry is the count
    items = [
        F.when(has > i, F.get("row", F.lit(i))).otherwise(F.lit("")).alias(c)
        for i, c in enumerate(ITEMS)
    ]
    weight = F.element_at("row", -1).cast("bigint").alias("weight")
    return rows.select("dimension", *items, weight, F.col("ordinal").cast("bigint"))


def weights_from_lists(spark: SparkSession, distributions: dict) -> DataFrame:
    """The same table from lists in memory."""
    rows = []
    for name in DIMENSIONS:
        for i, (*items, count) in enumerate(distributions[name]):
            items = [str(x) for x in items] + [""] * (len(ITEMS) - len(items))
            rows.append((name, *items, int(count), i))
    schema = "dimension string, item_1 string, item_2 string, item_3 string, weight long, ordinal long"
    return spark.createDataFrame(rows, schema)
