from __future__ import annotations

import glob
import json
import math
import re
from datetime import date

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from doselake.functions import draws
from doselake.operators import ids, profile, sampling
from doselake.operators import layout
from doselake.plans import synth
from doselake.sources import months
from doselake.schema import CANONICAL
from doselake.session import work_dir
from doselake.sources.months import read_months

LISTS = {
    "vacina": [["COV", "Covid", "1", 60], ["FLU", "Influenza", "2", 39], ["ZERO", "Never", "3", 0]],
    "dose": [["1", "First", 50], ["2", "Second", 30], ["x", "Odd", 10], ["200", "Large", 10]],
    "municipio": [["11", "ALFA", "AA", 70], ["22", "BETA", "BB", 29], ["33", "GAMA", "ZZ", 1]],
    "uf": [["AA", "Alpha", 5], ["AA", "Alpha again", 90], ["BB", "Beta", 5]],
    "tipo_estabelecimento": [["02", "Centre", 1], ["05", "Hospital", 1]],
    "fabricante": [["149", "Maker A", 3], ["165", "Maker B", 1]],
    "raca": [["1", "R1", 1], ["99", "R99", 1]],
    "idade": [[a, 10 + a % 7] for a in range(0, 100)],
}


@pytest.fixture(scope="module")
def sampler(spark):
    weights = profile.weights_from_lists(spark, LISTS)
    return sampling.Sampler.prepare(weights, work_dir(spark, "weights"))


@pytest.fixture(scope="module")
def records(sampler):
    df = synth.generate(sampler, [202501, 202502], 20_000, 5_000).persist()
    df.count()
    return df


def test_weights_from_file_equal_weights_from_lists(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps(LISTS, indent=1))
    got = profile.read_weights(spark, str(tmp_path / "d.json"))
    want = profile.weights_from_lists(spark, LISTS)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_shape(records):
    assert records.columns == [*CANONICAL, "year_month"]
    assert dict(records.dtypes)["codigo_dose_vacina"] == "tinyint"
    assert dict(records.dtypes)["numero_idade_paciente"] == "int"
    assert {(r["year_month"], r["count"]) for r in records.groupBy("year_month").count().collect()} == {
        ("2025-01", 20_000),
        ("2025-02", 20_000),
    }
    bad = records.where(F.date_format("data_vacina", "yyyy-MM") != F.col("year_month"))
    assert bad.count() == 0


def test_identifier_shapes(records):
    shapes = {
        "codigo_documento": r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}-i0b0",
        "codigo_paciente": r"[0-9a-f]{64}",
        "codigo_lote_vacina": r"2[345][A-Z]{4}[0-9]{3}(NA|NB|NC)?",
        "codigo_cnes_estabelecimento": r"[1-9][0-9]{6}",
        "numero_cep_paciente": r"[1-9][0-9]{4}",
    }
    for row in records.select(*shapes).limit(2000).collect():
        for c, shape in shapes.items():
            assert re.fullmatch(shape, row[c]), (c, row[c])
    assert records.where("substr(codigo_lote_vacina, 7, 3) = '000'").count() == 0
    assert records.select("codigo_documento").distinct().count() == 40_000


def test_weights_are_met(records):
    def share(cond):
        return records.where(cond).count() / 40_000

    assert share("sigla_vacina = 'ZERO'") == 0
    assert share("sigla_vacina = 'COV'") == pytest.approx(60 / 99, abs=0.01)
    assert share("codigo_municipio_estabelecimento = '33'") == pytest.approx(0.01, abs=0.003)
    assert share("tipo_sexo_paciente = 'F'") == pytest.approx(0.5168, abs=0.01)
    assert share("codigo_vacina_fabricante is null") == pytest.approx(0.3, abs=0.01)
    assert share("descricao_vacina_fabricante = ''") == share("codigo_vacina_fabricante is null")
    assert share("codigo_dose_vacina is null") == pytest.approx(0.2, abs=0.01)
    assert records.select("numero_idade_paciente").distinct().count() == 100


def test_state_names(records):
    got = {
        (r[0], r[1])
        for r in records.select("sigla_uf_estabelecimento", "nome_uf_estabelecimento").distinct().collect()
    }
    # the first of two names wins; an unknown state has none
    assert got == {("AA", "Alpha"), ("BB", "Beta"), ("ZZ", "")}


def test_week_days_three_times_as_likely(records):
    r = records.agg(
        F.count_if(F.weekday("data_vacina") >= 5).alias("w"), F.count(F.lit(1)).alias("n")
    ).first()
    days = [date(2025, 1, d + 1) for d in range(31)] + [date(2025, 2, d + 1) for d in range(28)]
    per_month = []
    for m in (1, 2):
        w = sum(d.weekday() >= 5 for d in days if d.month == m)
        k = sum(d.weekday() < 5 for d in days if d.month == m)
        per_month.append(w / (w + 3 * k))
    assert r["w"] / r["n"] == pytest.approx(sum(per_month) / 2, abs=0.01)


def test_entry_dates(records):
    r = records.select(F.datediff("data_entrada_rnds", "data_vacina").alias("d")).agg(
        F.min("d"), F.max("d"), F.count_distinct("d")
    ).first()
    assert tuple(r) == (1, 60, 60)


def test_patients_repeat_within_a_shard_only(spark, records):
    distinct = records.select("codigo_paciente").distinct().count()
    assert distinct / 40_000 == pytest.approx(0.6 * (1 - math.exp(-1 / 0.6)), abs=0.01)
    shards = synth.with_draws(synth.shard_identities(spark, [202501], 20_000, 5_000), 42, "xxhash64")
    who = ids.pooled_patient(F.col("d_patient"), F.col("n_rows"), F.col("shard_seed"), F.col("year_month"))
    per = shards.select("shard", who.alias("p")).distinct().groupBy("p").count()
    assert per.where("count > 1").count() == 0


def test_pool_has_at_least_one_patient(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (10,)], "n long").select(ids.pool_size(F.col("n")))
    assert [r[0] for r in df.collect()] == [1, 1, 1, 6]


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_rows_do_not_depend_on_partitioning(sampler, method):
    spark = sampler.spark
    ids_ = synth.shard_identities(spark, [202503], 3_000, 1_000)
    one = synth.build_records(ids_, sampler, [202503], method=method)
    two = synth.build_records(ids_.repartition(5), sampler, [202503], method=method)
    assert rows(one) == rows(two)


def test_a_month_alone_is_the_same_month(sampler, records):
    alone = synth.generate(sampler, ["2025-02"], 20_000, 5_000)
    month = records.where("year_month = '2025-02'")
    assert alone.exceptAll(month).count() == 0 and alone.count() == month.count()


def test_generation_needs_no_shuffle(sampler):
    text = plan(synth.generate(sampler, [202501], 3_000, 1_000))
    assert not re.search(r"\) Exchange|ShuffleExchange|SortMergeJoin", text)


def test_write_shards_one_sorted_file_per_shard(sampler, tmp_path):
    root = str(tmp_path)
    df = synth.generate(sampler, [202501, 202502], 2_500, 1_000)
    synth.write_shards(df, root)
    synth.write_shards(df, root)
    for m in ("2025-01", "2025-02"):
        assert len(glob.glob(f"{root}/year_month={m}/*.parquet")) == 3
    got = read_months(sampler.spark, root)
    assert got.count() == 5_000
    synth.write_shards(synth.generate(sampler, [202501], 1_000, 1_000, seed=7), root, mode="append")
    assert read_months(sampler.spark, root, [202501]).count() == 3_500


def test_joined_and_inline_lookups_agree(spark, sampler):
    weights = profile.weights_from_lists(spark, LISTS)
    joined = sampling.Sampler.prepare(weights, work_dir(spark, "joined"), inline_rows=0)
    assert not joined.inline and set(sampler.inline) == set(LISTS)
    df = synth.with_draws(synth.shard_identities(spark, [202501], 4_000, 1_000), 42)
    assert rows(joined.pick(df, synth.SAMPLED)) == rows(sampler.pick(df, synth.SAMPLED))


def test_sampling_a_large_dimension_shuffles_on_even_cells(spark, monkeypatch):
    # one item with a third of the weight among many light ones
    items = spark.range(3_000).select(
        F.lit("vacina").alias("dimension"),
        F.concat(F.lit("i"), F.col("id")).alias("item_1"),
        F.lit("").alias("item_2"),
        F.lit("").alias("item_3"),
        F.when(F.col("id") == 0, 1_500).otherwise(1).cast("long").alias("weight"),
    )
    s = sampling.Sampler.prepare(items, work_dir(spark, "large"), inline_rows=0)
    monkeypatch.setattr(sampling, "fits_broadcast", lambda rows, size: False)
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    try:
        df = synth.with_draws(synth.shard_identities(spark, [202501], 60_000, 10_000), 42)
        got = s.pick(df, {"vacina": {"item_1": "v"}})
        assert "SortMergeJoin" in plan(got) or "ShuffledHashJoin" in plan(got)
        assert got.count() == 60_000
        assert got.where("v = 'i0'").count() / 60_000 == pytest.approx(1 / 3, abs=0.01)
        total, width, _, _ = s.stats["vacina"]
        cells = df.select(F.expr(f"(d_vacina % {total}) div {width}").alias("c")).groupBy("c").count()
        assert cells.agg(F.max("count")).first()[0] < 60_000 / 100
    finally:
        spark.conf.unset(key)


def test_ranges_cover_the_line_without_gaps(spark):
    weights = profile.weights_from_lists(spark, LISTS)
    got = sampling.ranges(weights).orderBy("dimension", "lo").collect()
    at = {}
    for r in got:
        assert r["lo"] == at.get(r["dimension"], 0) and r["hi"] > r["lo"]
        at[r["dimension"]] = r["hi"]
    assert at == {name: sum(row[-1] for row in rows_) for name, rows_ in LISTS.items()}


def test_shard_plan(spark):
    months = spark.createDataFrame([(202501, 10), (202512, 4), (202511, 0)], "yyyymm int, month_rows long")
    got = synth.shard_plan(months, 4, seed=42).orderBy("year_month", "shard").collect()
    assert [(r["year_month"], r["shard"], r["n_rows"]) for r in got] == [
        ("2025-01", 0, 4),
        ("2025-01", 1, 4),
        ("2025-01", 2, 2),
        ("2025-12", 0, 4),
    ]
    assert got[0]["seed"] == 43_252_000
    assert got[1]["file"] == "year_month=2025-01/data-01.parquet"
    assert tuple(synth.plan_totals(synth.shard_plan(months, 4)).first()) == (4, 14)


def test_rows_of_months_leave_nothing_out(spark):
    shares = synth.rows_of_months(10**9, list(range(202501, 202513)))
    assert sum(shares.values()) == 10**9 and list(shares.values()) == [83_333_334] * 4 + [83_333_333] * 8
    rows_ = synth.shard_identities(spark, synth.rows_of_months(11, [202501, 202502, 202503]), shard_rows=3)
    got = sorted(tuple(r) for r in rows_.groupBy("year_month", "shard", "n_rows").count().collect())
    assert got == [
        ("2025-01", 0, 3, 3), ("2025-01", 1, 1, 1), ("2025-02", 0, 3, 3), ("2025-02", 1, 1, 1), ("2025-03", 0, 3, 3),
    ]
    assert synth.shard_identities(spark, {}, shard_rows=3).count() == 0


def test_one_file_per_shard_whatever_the_join(spark, fact, tmp_path):
    weights = profile.frequency_profile(fact)
    got = []
    for inline in (sampling.INLINE_ROWS, 0):
        sampler = sampling.Sampler.prepare(weights, str(tmp_path / f"w{inline}"), inline)
        root = str(tmp_path / f"out{inline}")
        assert sampler.joins(synth.SAMPLED) == (inline == 0)
        records = synth.generate(sampler, {202501: 25, 202502: 14}, shard_rows=10)
        synth.write_shards(records, root)
        files = spark.read.parquet(root).groupBy(F.input_file_name().alias("f"))
        got.append(sorted(r["n"] for r in files.agg(F.count("*").alias("n")).collect()))
        assert len(got[-1]) == 5
    assert got[0] == got[1] == [4, 5, 10, 10, 10]


def test_generation_resumes_by_shard(spark, fact, tmp_path):
    sampler = sampling.Sampler.prepare(profile.frequency_profile(fact), str(tmp_path / "w"))
    root, ledger = str(tmp_path / "t"), str(tmp_path / "l")
    layout.write_months(fact, root, writer=layout.LOAD)
    for n in (10, 10, 25):
        rows_ = synth.shard_identities(spark, {202501: n}, shard_rows=10)
        synth.generate_to_table(rows_, sampler, [202501], root, ledger)

    def made():
        table = months.read_months(spark, root)
        ids = table.where("codigo_documento like '%-i0b0'").select("codigo_documento")
        assert table.count() == fact.count() + ids.count()
        return ids.count(), ids.distinct().count()

    assert made() == (25, 25)
    entries = spark.read.parquet(ledger)
    assert entries.where("done").count() == 3
    # a run that wrote, was compacted, and did not end
    layout.compact_months(spark, root, [202501])
    entries.where("not done").write.parquet(str(tmp_path / "cut"))
    synth.generate_to_table(rows_, sampler, [202501], root, str(tmp_path / "cut"))
    assert made() == (25, 25)
    # what the table can't hold
    bad = weights_without_dose(fact)
    sampler = sampling.Sampler.prepare(bad, str(tmp_path / "v"))
    with pytest.raises(ValueError):
        synth.generate_to_table(rows_, sampler, [202501], root, ledger, seed=7)
    synth.generate_to_table(rows_, sampler, [202501], root, ledger, seed=7, reject_root=str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 25


def weights_without_dose(fact):
    return profile.frequency_profile(fact.withColumn("numero_idade_paciente", F.lit(300)))


def test_shards_beyond_a_thousand_do_not_repeat_the_next_month(spark):
    a = spark.createDataFrame([("2025-01", 1000, 5, 9)], "year_month string, shard long, row long, n_rows long")
    b = spark.createDataFrame([("2025-02", 0, 5, 9)], "year_month string, shard long, row long, n_rows long")
    x, y = synth.with_draws(a, 42).first(), synth.with_draws(b, 42).first()
    assert x["shard_seed"] == y["shard_seed"] and x["d_patient"] != y["d_patient"]


def test_seasonal_targets(spark):
    def targets(n, target):
        df = spark.createDataFrame([(n,)], "n long")
        return {r["month"]: (r["target_rows"], r["batches"]) for r in synth.seasonal_targets(df, target).collect()}

    got = targets(1_000_000, 50_000_000)
    for m, w in synth.MONTH_WEIGHTS.items():
        if m > 1:
            want = int(49_000_000 / 11 * w)
            assert got[m] == (want, -(-want // 50_000))
    assert 1 not in got and targets(5, 5) == {} and targets(6, 5) == {}


def test_resampled_day_odds(spark):
    # February 2025: 20 week days, 8 weekend days
    cal = sampling.month_calendar(spark, [202502])
    total = 8 * 12 * 20 + 20 * (100 * 20 + 88 * 8)
    draws_ = spark.range(total).withColumn("year_month", F.lit("2025-02"))
    days = draws_.join(cal, "year_month").select(sampling.resampled_day(F.col("id")).alias("d"))
    got = {r["d"]: r["count"] for r in days.groupBy("d").count().collect()}
    assert len(got) == 28
    for d, n in got.items():
        assert n == (12 * 20 if d.weekday() >= 5 else 100 * 20 + 88 * 8)


def test_draws_are_sixty_bits_and_digits_independent(spark):
    df = spark.range(1000).select(draws.draw([F.col("id")], "s").alias("a"), draws.draw([F.col("id")], "s", "xxhash64").alias("b"))
    r = df.agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    assert r[0] >= 0 and r[2] >= 0 and r[1] < 2**60 and r[3] < 2**60
    with pytest.raises(ValueError):
        draws.draw([F.col("id")], "s", "other")


def test_profile_round_trip(spark, sf_dir, fact):
    got = profile.frequency_profile(fact)
    per = {r["dimension"]: r["n"] for r in got.groupBy("dimension").agg(F.sum("weight").alias("n")).collect()}
    n = fact.count()
    assert per["vacina"] == per["idade"] == n
    assert per["fabricante"] == fact.where("codigo_vacina_fabricante is not null").count() < n


def test_shards_become_records_in_the_tasks_that_write_them(spark, fact, tmp_path, monkeypatch):
    sampler = sampling.Sampler.prepare(profile.frequency_profile(fact), str(tmp_path / "w"))
    written = []
    write = synth.write_months
    monkeypatch.setattr(synth, "write_months", lambda df, *x, **kw: written.append(df) or write(df, *x, **kw))
    # all identities in one task, as a small file gives them
    rows_ = synth.shard_identities(spark, {202501: 50}, shard_rows=10).coalesce(1)
    synth.generate_to_table(rows_, sampler, [202501], str(tmp_path / "t"), str(tmp_path / "l"))
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffled) == 1 and ", 5)" in shuffled[0].replace(", REPARTITION_BY_NUM", ")")
    files = months.read_months(spark, str(tmp_path / "t")).groupBy(F.input_file_name()).count().collect()
    assert [r["count"] for r in files] == [10] * 5
