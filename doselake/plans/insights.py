"""Dashboard queries, answered from the rollups.

Each takes stored or freshly built rollup rows. Days are dropped before states
are combined further, so that sketches are united once per group and not once
per combination.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doselake.functions.text import has_token
from doselake.operators.rollups import (
    PATIENTS,
    STATE_DEMOGRAPHICS,
    STATE_VACCINE_DATE,
    estimate,
    merged_measures,
    regroup,
)
from doselake.schema import MONTH
from doselake.session import fan_in

A, B = STATE_VACCINE_DATE, STATE_DEMOGRAPHICS
STATE, VACCINE, DAY = A.keys
SEX, RACE = B.keys[2:4]


def narrow(
    rollup: DataFrame,
    states: Sequence[str] | None = None,
    vaccines: Sequence[str] | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Dashboard filters. Dates also select month partitions where the table has them."""
    months = MONTH in rollup.columns
    if states is not None:
        rollup = rollup.where(F.col(STATE).isin(list(states)))
    if vaccines is not None:
        rollup = rollup.where(F.col(VACCINE).isin(list(vaccines)))
    if start is not None:
        rollup = rollup.where(F.col(DAY) >= F.lit(start))
        rollup = rollup.where(F.col(MONTH) >= f"{start:%Y-%m}") if months else rollup
    if end is not None:
        rollup = rollup.where(F.col(DAY) <= F.lit(end))
        rollup = rollup.where(F.col(MONTH) <= f"{end:%Y-%m}") if months else rollup
    return rollup


def _average_age() -> Column:
    return F.round(F.try_divide(F.col("sum_age"), F.col("count_age")), 6)


def kpi_overview(rollup: DataFrame, **filters) -> DataFrame:
    """One row of totals for a filter: doses, patients, average age, sexes, doses by kind."""
    # in two levels: tasks unite shares of the states first
    rows = narrow(rollup, **filters).withColumn("_share", F.spark_partition_id() % fan_in(rollup.sparkSession))
    shares = rows.groupBy("_share").agg(*merged_measures(A.counters))
    total = shares.agg(*merged_measures(A.counters))
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in A.counters}
    total = estimate(total).withColumns(zero)
    return total.select(
        "total_doses",
        F.coalesce(PATIENTS, F.lit(0)).alias(PATIENTS),
        _average_age().alias("average_age"),
        *A.counters[3:],
    )


def vaccine_performance(rollup: DataFrame, **filters) -> DataFrame:
    """Per vaccine: doses, patients, doses by kind, average age."""
    out = estimate(regroup(narrow(rollup, **filters), A, [VACCINE]))
    return out.select(
        VACCINE,
        "total_doses",
        PATIENTS,
        "first_doses",
        "second_doses",
        "boosters",
        _average_age().alias("average_age"),
    )


def _period(grain: str) -> Column:
    return F.col(DAY) if grain == "day" else F.trunc(DAY, grain)


def trends(
    rollup: DataFrame, grains: Sequence[str] = ("day", "week", "month"), **filters
) -> DataFrame:
    """Doses and patients per day, week (from Monday) and month, in one long table."""
    daily = regroup(narrow(rollup, **filters), A, [DAY])
    periods = F.explode(
        F.array(
            *[F.struct(F.lit(g).alias("grain"), _period(g).alias("period")) for g in grains]
        )
    )
    rows = daily.withColumn("p", periods).select("p.grain", "p.period", *A.counters, PATIENTS)
    out = estimate(regroup(rows, A, ["grain", "period"]))
    return out.select(
        "grain", "period", "total_doses", PATIENTS, "first_doses", "second_doses", "boosters"
    )


def state_vaccine_cube(rollup: DataFrame, **filters) -> DataFrame:
    """Totals by state and vaccine with all their subtotals; null keys mean "all"."""
    base = regroup(narrow(rollup, **filters), A, [STATE, VACCINE])
    cubed = base.cube(STATE, VACCINE).agg(
        F.grouping_id().cast("int").alias("level"), *merged_measures(A.counters)
    )
    return estimate(cubed).select(
        STATE, VACCINE, "level", "total_doses", PATIENTS, "female_count", "male_count", "boosters"
    )


def demographics(
    rollup: DataFrame,
    min_age: int = 0,
    max_age: int = 255,
    states: Sequence[str] | None = None,
    sexes: Sequence[str] | None = None,
    races: Sequence[str] | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """By sex and race, for an inclusive age range, some states, sexes and races, and days from ``start`` to ``end``."""
    rows = narrow(rollup, states=states, start=start, end=end)
    rows = rows.where(F.col("numero_idade_paciente").between(min_age, max_age))
    if sexes is not None:
        rows = rows.where(F.col(SEX).isin(list(sexes)))
    if races is not None:
        rows = rows.where(F.col(RACE).isin(list(races)))
    return estimate(regroup(rows, B, [SEX, RACE]))


def last_days(rollup: DataFrame, days: int = 30, as_of: date | None = None) -> DataFrame:
    """Rollup rows of the ``days`` days up to ``as_of``, by default the last day present.

    Month partitions are pruned, without ``as_of`` by what scalar subqueries find when the query runs: the
    newest month, read from partition values alone, then the newest day in it.
    """
    if as_of is None:
        last = rollup
        if MONTH in rollup.columns:
            last = rollup.where(F.col(MONTH) == rollup.agg(F.max(MONTH)).scalar())
        newest = last.agg(F.max(DAY)).scalar()
        if MONTH in rollup.columns:
            rollup = rollup.where(F.col(MONTH) >= F.date_format(F.date_sub(newest, days - 1), "yyyy-MM"))
        return rollup.where(F.col(DAY) > F.date_sub(newest, days))
    start = date.fromordinal(as_of.toordinal() - days + 1)
    return narrow(rollup, start=start, end=as_of)


def last_30_days(rollup: DataFrame, as_of: date | None = None) -> DataFrame:
    """Doses and patients per state over the last 30 days."""
    out = estimate(regroup(last_days(rollup, 30, as_of), A, [STATE]))
    return out.select(STATE, "total_doses", PATIENTS, "first_doses", "second_doses", "boosters")


def daily_stats(rollup: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Per day: doses, patients and their make-up."""
    out = estimate(regroup(narrow(rollup, start=start, end=end), A, [DAY]))
    return out.select(
        DAY,
        "total_doses",
        PATIENTS,
        "female_count",
        "male_count",
        "children",
        "young_adults",
        "adults",
        "middle_aged",
        "seniors",
    )


def with_name_token(
    df: DataFrame, token: str, column: str = "nome_razao_social_estabelecimento"
) -> DataFrame:
    """Rows whose name contains a whole word."""
    return df.where(has_token(F.col(column), token))
