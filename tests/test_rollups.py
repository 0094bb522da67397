from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from doselake.operators import patients, rollups
from doselake.operators.rollups import STATE_DEMOGRAPHICS as B
from doselake.operators.rollups import STATE_VACCINE_DATE as A
from doselake.plans import insights, load
from doselake.schema import FACT_SCHEMA, to_schema


def facts(spark, data):
    """Fact rows from (state, vaccine, patient, sex, age, dose, day)."""
    df = spark.createDataFrame(
        [(*r[:6], date(2025, 1, r[6])) for r in data],
        "sigla_uf_paciente string, sigla_vacina string, codigo_paciente string, "
        "tipo_sexo_paciente string, numero_idade_paciente int, codigo_dose_vacina int, "
        "data_vacina date",
    )
    return to_schema(df, FACT_SCHEMA).fillna("", subset=["nome_raca_cor_paciente"])


def test_classes(spark):
    ages = [17, 18, 29, 30, 49, 50, 64, 65]
    doses = [0, 1, 2, 3, 9, 1, 1, 1]
    sexes = ["F", "M", "I", "F", "M", "F", "F", "M"]
    data = [("SP", "V", str(i), sexes[i], ages[i], doses[i], 1) for i in range(8)]
    df = facts(spark, data)
    a = rollups.estimate(rollups.build(df, A)).first().asDict()
    want = dict(
        total_doses=8, unique_patients=8, female_count=4, male_count=3, sum_age=sum(ages),
        count_age=8, first_doses=4, second_doses=1, boosters=2, children=1, young_adults=2,
        adults=2, middle_aged=2, seniors=1,
    )
    assert {k: a[k] for k in want} == want
    b = rollups.estimate(rollups.build(df, B))
    assert b.agg(F.sum("completed_series")).first()[0] == 3


def test_merge_adds_counters_and_unites_patients(spark):
    one = facts(spark, [("SP", "V", p, "F", 20, 1, 1) for p in "abc"])
    two = facts(spark, [("SP", "V", p, "M", 40, 2, 1) for p in "bcd"])
    both = rollups.merge(rollups.build(one, A).unionByName(rollups.build(two, A)), A)
    row = rollups.estimate(both).first()
    assert (row["total_doses"], row["unique_patients"]) == (6, 4)
    assert (row["female_count"], row["male_count"], row["sum_age"]) == (3, 3, 180)


@pytest.mark.parametrize("spec", [A, B], ids=["state_vaccine_date", "state_demographics"])
def test_sketch_equals_exact_below_its_size(fact, spec):
    assert rows(rollups.estimate(rollups.build(fact, spec))) == rows(rollups.build_exact(fact, spec))


@pytest.mark.parametrize("salts", [1, 3, 64])
def test_salts_change_nothing(fact, salts):
    got = rollups.estimate(rollups.build(fact.repartition(7), A, salts))
    assert rows(got) == rows(rollups.build_exact(fact, A))


def test_one_key_with_a_third_of_all_rows(spark):
    ids = spark.range(0, 300_000, 1, 24)
    hot = F.col("id") % 3 == 0
    df = ids.select(
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("S"), F.col("id") % 20)).alias("k"),
        (F.col("id") % 50_000).cast("string").alias("codigo_paciente"),
    )
    spec = rollups.Rollup("hot", keys=("k",), counts=(("n_even", "codigo_paciente % 2 = 0"),))
    got = rollups.build(df, spec)
    assert rows(rollups.estimate(got)) == rows(rollups.build_exact(df, spec))
    # two levels, both with a task-side step before the shuffle
    text = plan(got)
    assert text.count("partial_theta_sketch_agg") == 1 and "partial_theta_union_agg" in text


def test_estimate_is_close_beyond_the_sketch_size(spark):
    df = spark.range(0, 200_000, 1, 8).select(
        F.lit("k").alias("k"), F.col("id").cast("string").alias("codigo_paciente")
    )
    spec = rollups.Rollup("big", keys=("k",), counts=())
    n = rollups.estimate(rollups.build(df, spec)).first()["unique_patients"]
    assert abs(n - 200_000) < 0.02 * 200_000


def test_merge_of_blocks_equals_one_pass(fact):
    blocks = fact.withColumn("block", F.pmod(F.hash("codigo_documento"), F.lit(5)))
    partial = rollups.build(blocks, replace(A, keys=("block", *A.keys)))
    assert rows(rollups.estimate(rollups.merge(partial, A))) == rows(
        rollups.estimate(rollups.build(fact, A))
    )


def test_empty_input(spark):
    empty = spark.createDataFrame([], FACT_SCHEMA)
    assert rollups.build(empty, A).count() == 0
    row = insights.kpi_overview(rollups.build(empty, A)).first()
    assert (row["total_doses"], row["unique_patients"], row["average_age"]) == (0, 0, None)


def test_scan_reads_only_rollup_columns(spark, sf_dir):
    from doselake.operators.layout import write_months
    from doselake.session import work_dir
    from doselake.sources.months import read_months

    root = work_dir(spark, "scan")
    from doselake.adapters import dose_events

    write_months(dose_events(spark, sf_dir), root)
    text = plan(rollups.build(read_months(spark, root, [202502]), A))
    read = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert read.count(":") == 1 + 7  # the label and seven columns
    assert "PartitionFilters: [isnotnull(year_month" in text or "year_month" in text


def test_stored_rollup_is_replaced_whole(spark, fact, tmp_path):
    path = load.rollup_path(str(tmp_path), A)
    rollups.store(rollups.build(fact, A), A, path)
    january = fact.where(F.month("data_vacina") == 1)
    rollups.store(rollups.build(january, A), A, path)
    stored = load.read_rollup(spark, str(tmp_path), A)
    assert {r["year_month"] for r in stored.select("year_month").distinct().collect()} == {"2025-01"}


def test_last_days_prunes_months_when_told_the_day(spark, fact, tmp_path):
    path = load.rollup_path(str(tmp_path), A)
    rollups.store(rollups.build(fact, A), A, path)
    stored = load.read_rollup(spark, str(tmp_path), A)
    newest = stored.agg(F.max("data_vacina")).first()[0]
    assert rows(insights.last_30_days(stored, newest)) == rows(insights.last_30_days(stored))
    assert "year_month" in plan(insights.last_30_days(stored, newest)).split("PartitionFilters")[1][:200]


def test_demographics_age_range_is_inclusive(fact):
    b = rollups.build(fact, B)
    got = insights.demographics(b, 18, 49).agg(F.sum("total_doses")).first()[0]
    assert got == fact.where("numero_idade_paciente between 18 and 49").count()


def test_filters(fact):
    a = rollups.build(fact, A)
    start, end = date(2025, 1, 10), date(2025, 2, 3)
    got = insights.kpi_overview(a, states=["U1"], vaccines=["A-F"], start=start, end=end).first()
    want = fact.where(
        (F.col("sigla_uf_paciente") == "U1")
        & (F.col("sigla_vacina") == "A-F")
        & F.col("data_vacina").between(start, end)
    )
    assert got["total_doses"] == want.count()
    assert got["unique_patients"] == want.select("codigo_paciente").distinct().count()


def scans(df):
    """Places where a plan reads the fact rows."""
    return plan(df).count("Scan parquet") or plan(df).count("FileScan")


def test_all_rollups_from_one_scan(spark, fact, tmp_path, monkeypatch):
    root = str(tmp_path / "fact")
    fact.withColumn("numero_idade_paciente", F.when(F.col("codigo_dose_vacina") > 1, F.col("numero_idade_paciente"))).write.parquet(root)
    seen = []
    monkeypatch.setattr(rollups, "fan_in", lambda spark: seen.append(1) or 3)
    read = spark.read.schema(FACT_SCHEMA).parquet(root)
    built = rollups.build_all(read, [A, B], str(tmp_path / "states"))
    assert len(seen) == 1
    for spec, got in zip((A, B), built, strict=True):
        assert rows(rollups.estimate(got)) == rows(rollups.estimate(rollups.build(read, spec)))
        # what is read is the states
        assert "states" in plan(got) and root not in plan(got).replace(str(tmp_path / "states"), "")


def test_patient_without_code_counts(spark):
    df = facts(spark, [("SP", "V", "", "F", 20, 1, 1), ("SP", "V", "a", "F", 20, 1, 1)])
    assert rollups.estimate(rollups.build(df, A)).first()["unique_patients"] == 2


def test_stored_months_go_when_they_lose_their_rows(spark, fact, tmp_path):
    path = str(tmp_path / "r")
    rollups.store(rollups.build(fact, A), A, path)
    rollups.store(rollups.build(fact.where(F.month("data_vacina") == 2), A), A, path)
    assert rollups.stored_months(spark, path) == {"2025-02"}


def test_exact_patients_merge_and_take_new_numbers(spark, tmp_path):
    def some(low, high, key):
        return spark.range(low, high).select(F.concat(F.lit("p"), "id").alias("codigo_paciente"), F.lit(key).alias("k"))

    def numbered(rows_, known, name):
        patients.number_patients(rows_, known).write.parquet(str(tmp_path / name))
        return spark.read.schema(patients.NUMBERS).parquet(str(tmp_path / name))

    one, two = some(0, 70_000, "a"), some(60_000, 140_000, "b")
    known = numbered(one, None, "one")
    numbers = known.unionByName(numbered(two, known, "two"))
    assert numbers.select(patients.NUMBER).distinct().count() == numbers.count() == 140_000
    states = patients.patient_states(one.unionAll(two).unionAll(one), numbers, ["k"])
    by_key = {r["k"]: r["unique_patients"] for r in patients.count_patients(states, ["k"]).collect()}
    assert by_key == {"a": 70_000, "b": 80_000}
    assert patients.count_patients(states, []).first()[0] == 140_000
    nobody = spark.createDataFrame([(None, "a")], "codigo_paciente string, k string")
    assert patients.count_patients(patients.patient_states(nobody, numbers, ["k"]), []).first()[0] == 0


def test_last_days_prune_months_at_run_time(spark, tmp_path):
    path = str(tmp_path / "r")
    days = [date(2025, m, 15) for m in range(1, 7)] + [date(2025, 6, 30)]
    df = facts(spark, [("SP", "V", "a", "F", 20, 1, 1)]).drop("data_vacina")
    df = df.crossJoin(spark.createDataFrame([(d,) for d in days], "data_vacina date"))
    rollups.store(rollups.build(to_schema(df, FACT_SCHEMA), A), A, path)
    got = insights.last_days(spark.read.parquet(path), 30)
    assert sorted(r["data_vacina"] for r in got.collect()) == days[-2:]
    filters = [x for x in plan(got).splitlines() if "PartitionFilters" in x]
    assert any("year_month" in x and "ubquery" in x for x in filters)
    read = {r[0].split("year_month=")[1][:7] for r in got.select("_metadata.file_path").distinct().collect()}
    assert read == {"2025-06"}


def test_demographics_filters(spark):
    df = facts(spark, [("SP", "V", "a", "F", 20, 1, 1), ("SP", "V", "b", "M", 20, 1, 2), ("RJ", "V", "c", "F", 40, 1, 3)])
    rollup = rollups.build(df, B)

    def total(**filters):
        return sum(r["total_doses"] for r in insights.demographics(rollup, **filters).collect())

    assert total() == 3 and total(sexes=["F"]) == 2 and total(states=["RJ"]) == 1 and total(races=["x"]) == 0
    assert total(start=date(2025, 1, 2)) == 2 and total(end=date(2025, 1, 2), sexes=["M"]) == 1
