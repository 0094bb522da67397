"""The two pre-aggregated tables, their merge, and their read-out.

A rollup row holds additive counters and the state of a distinct-patient count.
Counters add up and sketch states unite, so partial rows of the same key (from
stream batches, months or shards) merge to what one pass over all rows would
have given. Distinct counts themselves are never added: the estimate is the last
step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doselake.functions.calendar import month_label
from doselake.schema import FACT_SCHEMA, MONTH
from doselake.session import fan_in, remove

PATIENTS = "unique_patients"
#: 2^16 entries: distinct counts are exact up to 65,536 patients per state.
SKETCH_LG = 16

_SALT, _SET = "_salt", "_set"


@dataclass(frozen=True)
class Rollup:
    """Keys, and counters as (name, condition or summed column)."""

    name: str
    keys: tuple[str, ...]
    counts: tuple[tuple[str, str], ...]
    sums: tuple[tuple[str, str], ...] = ()

    @property
    def counters(self) -> list[str]:
        return ["total_doses", *[n for n, _ in self.sums], *[n for n, _ in self.counts]]

    def measures(self) -> list[Column]:
        return (
            [F.count(F.lit(1)).alias("total_doses")]
            + [F.sum(F.col(c).cast("bigint")).alias(n) for n, c in self.sums]
            + [F.count_if(F.expr(cond)).alias(n) for n, cond in self.counts]
        )

    @property
    def columns(self) -> list[str]:
        return [*self.keys, "total_doses", PATIENTS, *self.counters[1:]]

    @property
    def schema(self) -> T.StructType:
        """Of stored rows, whose distinct patients are states."""
        kinds = {PATIENTS: T.BinaryType()} | {k: FACT_SCHEMA[k].dataType for k in self.keys}
        return T.StructType([T.StructField(c, kinds.get(c, T.LongType())) for c in self.columns])


# The conditions of both rollups.
_DOSE_COUNTS = (
    ("first_doses", "codigo_dose_vacina = 1"),
    ("second_doses", "codigo_dose_vacina = 2"),
    ("boosters", "codigo_dose_vacina >= 3"),
)

# Dose code 9 ("single dose") satisfies ">= 3" and ">= 2": it counts as booster
# and as completed series. Deleted documents count too. Both are kept on purpose,
# as is a missing age, which was stored as 0 and so counts as a child.
STATE_VACCINE_DATE = Rollup(
    "state_vaccine_date",
    keys=("sigla_uf_paciente", "sigla_vacina", "data_vacina"),
    sums=(("sum_age", "numero_idade_paciente"),),
    counts=(
        ("count_age", "numero_idade_paciente is not null"),
        ("female_count", "tipo_sexo_paciente = 'F'"),
        ("male_count", "tipo_sexo_paciente = 'M'"),
        *_DOSE_COUNTS,
        ("children", "numero_idade_paciente < 18"),
        ("young_adults", "numero_idade_paciente between 18 and 29"),
        ("adults", "numero_idade_paciente between 30 and 49"),
        ("middle_aged", "numero_idade_paciente between 50 and 64"),
        ("seniors", "numero_idade_paciente >= 65"),
    ),
)

STATE_DEMOGRAPHICS = Rollup(
    "state_demographics",
    keys=(
        "sigla_uf_paciente",
        "numero_idade_paciente",
        "tipo_sexo_paciente",
        "nome_raca_cor_paciente",
        "data_vacina",
    ),
    counts=(*_DOSE_COUNTS, ("completed_series", "codigo_dose_vacina >= 2")),
)

ROLLUPS = (STATE_VACCINE_DATE, STATE_DEMOGRAPHICS)
#: The columns of fact rows that the rollups are built from: their keys, what their counters read, and the patient.
INPUTS = (
    *dict.fromkeys(k for spec in ROLLUPS for k in spec.keys),
    "codigo_dose_vacina",
    "codigo_paciente",
)


def _patient() -> Column:
    """Sketches leave out empty strings, so that the patient without a code would not count."""
    return F.concat(F.lit("="), F.col("codigo_paciente"))


def build(fact: DataFrame, spec: Rollup, salts: int | None = None) -> DataFrame:
    """One mergeable row per key.

    Tasks aggregate before anything is shuffled. A hot key would still send one
    partial state per task to a single reducer, so partial states are first
    united in ``salts`` groups per key and those few united in a second, small
    step. The salt is the task number: it spreads the partial states and
    adds no rows to the first shuffle.
    """
    salts = salts or fan_in(fact.sparkSession)
    salted = fact.withColumn(_SALT, F.spark_partition_id() % salts)
    first = salted.groupBy(*spec.keys, _SALT).agg(
        *spec.measures(), F.theta_sketch_agg(_patient(), SKETCH_LG).alias(PATIENTS)
    )
    return regroup(first, spec, spec.keys)


def build_all(fact: DataFrame, specs: Sequence[Rollup], path: str, salts: int | None = None) -> list[DataFrame]:
    """The rows ``build`` gives for each rollup, from one scan of the fact rows.

    One aggregation over the grouping sets of all rollups makes their partial states, salted as in ``build``. They
    are written below ``path``, and each rollup is united from its share.
    """
    salts = salts or fan_in(fact.sparkSession)
    keys = list(dict.fromkeys(k for spec in specs for k in spec.keys))
    measures = {n: m for spec in specs for n, m in zip(spec.counters, spec.measures(), strict=True)}
    salted = fact.withColumn(_SALT, F.spark_partition_id() % salts)
    sets = [[*spec.keys, _SALT] for spec in specs]
    first = salted.groupingSets(sets, *keys, _SALT).agg(
        F.grouping_id().cast("bigint").alias(_SET),
        *measures.values(),
        F.theta_sketch_agg(_patient(), SKETCH_LG).alias(PATIENTS),
    )
    first.write.partitionBy(_SET).parquet(path)
    states = fact.sparkSession.read.parquet(path)
    out = []
    for spec in specs:
        # a bit for every key, the first one highest, set where it is not in the set; the salt always is
        number = sum(1 << (len(keys) - i) for i, k in enumerate(keys) if k not in spec.keys)
        out.append(regroup(states.where(F.col(_SET) == number), spec, spec.keys))
    return out


def build_exact(fact: DataFrame, spec: Rollup) -> DataFrame:
    """The rollup with exact distinct counts; these rows cannot be merged further.

    Spark first shuffles on key and patient together, so a hot key is spread
    over its patients.
    """
    exact = F.count_distinct("codigo_paciente").alias(PATIENTS)
    return fact.groupBy(*spec.keys).agg(*spec.measures(), exact).select(*spec.columns)


def merged_measures(counters: Sequence[str]) -> list[Column]:
    """Aggregates that merge rollup rows: counters add, patient states unite."""
    return [F.sum(c).alias(c) for c in counters] + [
        F.theta_union_agg(PATIENTS, SKETCH_LG).alias(PATIENTS)
    ]


def regroup(rows: DataFrame, spec: Rollup, keys: Sequence[str | Column]) -> DataFrame:
    """Merge rollup rows to ``keys``: the rollup's own, fewer, or derived ones."""
    out = rows.groupBy(*keys).agg(*merged_measures(spec.counters))
    names = out.columns[: len(keys)]
    return out.select(*names, "total_doses", PATIENTS, *spec.counters[1:])


def merge(partials: DataFrame, spec: Rollup) -> DataFrame:
    """Merge partial rollup rows of equal keys."""
    return regroup(partials, spec, spec.keys)


def estimate(rows: DataFrame) -> DataFrame:
    """Replace the patient state by its distinct count."""
    return rows.withColumn(PATIENTS, F.theta_sketch_estimate(PATIENTS))


def store(rows: DataFrame, spec: Rollup, path: str, months: Sequence[str] | None = None) -> None:
    """Replace a stored rollup: month partitions, rows in key order.

    Months are replaced one by one, each complete before its old rows go. Given ``months``, the others stay;
    else months that lost all their rows are removed afterwards.
    """
    spark = rows.sparkSession
    with_month = rows.withColumn(MONTH, month_label(F.col("data_vacina")))
    before = set() if months is not None else stored_months(spark, path)
    (
        with_month.hint("rebalance", MONTH)
        .sortWithinPartitions(MONTH, *spec.keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )
    if before:
        for label in before - {r[0] for r in with_month.select(MONTH).distinct().collect()}:
            remove(spark, f"{path}/{MONTH}={label}")


def stored_months(spark: SparkSession, path: str) -> set[str]:
    """Month labels of a stored rollup; none if it is not there yet."""
    try:
        return {r[0] for r in spark.read.schema(f"{MONTH} string").parquet(path).select(MONTH).distinct().collect()}
    except AnalysisException:
        return set()
