from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from doselake.operators import layout, lookup, rollups
from doselake.operators.rollups import STATE_VACCINE_DATE as A
from doselake.plans import insights, load
from doselake.schema import CANONICAL, FACT_SCHEMA
from doselake.sources import months


def files(root, month="*"):
    return sorted(glob.glob(f"{root}/year_month={month}/**/*.parquet", recursive=True))


def copies(df, n):
    return df.withColumn("id", F.explode(F.sequence(F.lit(1), F.lit(n))))


@pytest.fixture(scope="module")
def stored(fact, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("fact"))
    layout.write_months(fact, root, spread=())
    return root


def test_one_file_per_month_while_small(stored):
    assert [len(files(stored, f"2025-0{m}")) for m in (1, 2, 3)] == [1, 1, 1]


def test_rows_come_back(spark, fact, stored):
    assert rows(months.read_months(spark, stored).select(*CANONICAL)) == rows(fact)


def test_files_are_sorted_and_compressed(stored):
    for f in files(stored):
        table = pq.read_table(f, columns=list(layout.BY_STATE), partitioning=None)
        keys = list(zip(*[table[c].to_pylist() for c in layout.BY_STATE], strict=True))
        assert keys == sorted(keys)
        assert pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD"


def test_spread_by_state_splits_states_over_files(spark, fact, tmp_path):
    wide = fact.withColumn("sigla_uf_paciente", F.concat(F.lit("S"), F.hash("codigo_documento") % 9))
    layout.write_months(wide, str(tmp_path / "a"))
    assert months.read_months(spark, str(tmp_path / "a")).count() == fact.count()


def test_month_that_holds_most_rows_is_split(spark, fact, tmp_path):
    """No task gets a whole oversized month: the rebalance splits it by size."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    big = copies(fact, 4).repartition(12)
    spark.conf.set(key, "256KB")
    try:
        layout.write_months(big.drop("id"), str(tmp_path / "split"), spread=())
    finally:
        spark.conf.unset(key)
    assert len(files(tmp_path / "split", "2025-01")) > 3
    assert months.read_months(spark, str(tmp_path / "split")).count() == big.count()


def test_overwrite_touches_only_its_months(spark, fact, tmp_path):
    root = str(tmp_path)
    layout.write_months(fact, root)
    before = files(root, "2025-01") + files(root, "2025-03")
    february = fact.where(F.month("data_vacina") == 2)
    layout.write_months(february.limit(10), root)
    assert files(root, "2025-01") + files(root, "2025-03") == before
    assert months.read_months(spark, root, ["2025-02"]).count() == 10
    layout.write_months(february, root)
    layout.write_months(february, root)
    assert months.read_months(spark, root).count() == fact.count()


def test_empty_batches(spark, fact, tmp_path):
    root = str(tmp_path)
    layout.append_months(fact, root)
    layout.append_months(fact.limit(0), root)
    layout.write_months(fact.limit(0), root)
    assert months.read_months(spark, root).count() == fact.count()


def test_append_adds(spark, fact, tmp_path):
    root = str(tmp_path)
    shuffled = fact.select(*reversed(CANONICAL))
    layout.append_months(fact, root)
    layout.append_months(shuffled, root)
    assert months.read_months(spark, root).count() == 2 * fact.count()


def test_month_filter_prunes_and_reaches_the_scan(spark, stored):
    df = months.read_months(spark, stored, [202502], start=None).where("sigla_uf_paciente = 'U1'")
    text = plan(df.select("codigo_paciente"))
    assert "PartitionFilters" in text and "2025-02" in text
    assert "EqualTo(sigla_uf_paciente,U1)" in text
    assert {r[0] for r in df.select("_metadata.file_path").collect()} == {
        f"file:{f}" for f in files(stored, "2025-02")
    }


def test_date_filter_implies_months(spark, stored):
    from datetime import date

    df = months.read_months(spark, stored, start=date(2025, 2, 10), end=date(2025, 2, 20))
    line = next(x for x in plan(df).splitlines() if x.startswith("PartitionFilters"))
    assert "year_month" in line and line.count("2025-02") == 2
    assert df.agg(F.min("data_vacina"), F.max("data_vacina")).first() == (
        date(2025, 2, 10),
        date(2025, 2, 20),
    )


def test_discovery_opens_no_rows(spark, stored):
    assert [r[0] for r in months.discover_months(spark, stored).collect()] == [
        "2025-01",
        "2025-02",
        "2025-03",
    ]


def test_date_first_copy(fact, tmp_path):
    layout.write_months(fact, str(tmp_path), layout.BY_DATE, spread=())
    for f in files(tmp_path):
        days = pq.read_table(f, columns=["data_vacina"], partitioning=None)["data_vacina"]
        assert days.to_pylist() == sorted(days.to_pylist())


def test_bloom_filter_where_no_dictionary_serves(spark, fact, tmp_path):
    # distinct codes beyond what a dictionary page holds
    many = copies(fact, 40).withColumn(
        "codigo_cnes_estabelecimento", F.md5(F.concat("codigo_documento", F.col("id")))
    )
    root = str(tmp_path / "bloom")
    options = {"codigo_cnes_estabelecimento": 300_000}
    layout.write_months(many.drop("id"), root, spread=(), bloom=options)
    plain = str(tmp_path / "plain")
    layout.write_months(many.drop("id"), plain, spread=())

    def size(r):
        return sum(os.path.getsize(f) for f in files(r))

    assert size(root) > size(plain)  # the filters are in the files
    assert months.read_months(spark, root).where("codigo_cnes_estabelecimento = 'no'").count() == 0


def test_small_files_per_record_limit(fact, tmp_path):
    layout.write_months(fact, str(tmp_path), spread=(), rows_per_file=500)
    assert all(pq.ParquetFile(f).metadata.num_rows <= 500 for f in files(tmp_path))


def test_compaction_keeps_rows_and_reduces_files(spark, fact, tmp_path):
    root = str(tmp_path)
    layout.append_months(fact.repartition(6), root)
    other = files(root, "2025-01")
    assert len(files(root, "2025-02")) == 6
    layout.compact_months(spark, root, ["2025-02"])
    assert len(files(root, "2025-02")) < 6 and files(root, "2025-01") == other
    assert rows(months.read_months(spark, root).select(*CANONICAL)) == rows(fact)


def test_load_is_repeatable_and_rejects_bad_rows(spark, fact, tmp_path):
    src, dst, bad = str(tmp_path / "x"), str(tmp_path / "f"), str(tmp_path / "bad")
    layout.write_months(fact, src)
    stray = fact.where(F.month("data_vacina") == 3).limit(3).withColumn("year_month", F.lit("2025-01"))
    old = fact.limit(2).withColumn("numero_idade_paciente", F.lit(300))
    old.withColumn("year_month", F.date_format("data_vacina", "yyyy-MM")).write.mode(
        "append"
    ).partitionBy("year_month").parquet(src)
    stray.write.mode("append").partitionBy("year_month").parquet(src)
    with pytest.raises(ValueError):
        layout.load_months(spark, src, dst)
    assert not os.path.exists(dst)
    for _ in range(2):
        layout.load_months(spark, src, dst, reject_root=bad)
        assert months.read_months(spark, dst).count() == fact.count()
    problems = {r["problem"]: r["n"] for r in spark.read.parquet(bad).groupBy("problem").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert problems == {
        "date outside its month partition": 3,
        "numero_idade_paciente out of range": 2,
    }


def test_month_of_bad_rows_ends_up_empty_and_rejects_stay_by_month(spark, fact, tmp_path):
    src, dst, bad = str(tmp_path / "x"), str(tmp_path / "f"), str(tmp_path / "bad")
    layout.write_months(fact, dst, writer=layout.LOAD)
    january = fact.where(F.month("data_vacina") == 1)
    layout.write_months(january.withColumn("numero_idade_paciente", F.lit(300)), src)
    layout.load_months(spark, src, dst, reject_root=bad)
    left = fact.where(F.month("data_vacina") != 1)
    assert months.read_months(spark, dst).count() == left.count()
    february = fact.where(F.month("data_vacina") == 2)
    layout.write_months(february, src)
    layout.load_months(spark, src, dst, ["2025-02"], reject_root=bad)
    assert spark.read.parquet(bad).count() == january.count()
    layout.write_months(january, src)
    layout.load_months(spark, src, dst, ["2025-01"], reject_root=bad)
    assert spark.read.parquet(bad).count() == 0
    assert months.read_months(spark, dst).count() == fact.count()


def test_dose_codes_survive_export(spark, fact, tmp_path):
    table, out, back = (str(tmp_path / x) for x in "toc")
    high = fact.withColumn("codigo_dose_vacina", F.lit(200).cast("smallint"))
    layout.write_months(high, table)
    layout.export_months(spark, table, out)
    layout.load_months(spark, out, back)
    assert rows(months.read_months(spark, back).select(*CANONICAL)) == rows(high)


def test_append_takes_only_what_the_table_holds(spark, fact, tmp_path):
    odd = fact.limit(3).withColumns(
        {"codigo_dose_vacina": F.lit(None).cast("smallint"), "nome_uf_paciente": F.lit(None).cast("string")}
    )
    undated = fact.limit(2).withColumn("data_vacina", F.lit(None).cast("date"))
    with pytest.raises(ValueError):
        layout.append_months(undated, str(tmp_path / "f"))
    layout.append_months(odd.unionByName(undated), str(tmp_path / "f"), str(tmp_path / "bad"))
    got = months.read_months(spark, str(tmp_path / "f")).collect()
    assert [r["codigo_dose_vacina"] for r in got] == [0, 0, 0]
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_rollup_survives_export_and_load(spark, fact, stored, tmp_path):
    out, back = str(tmp_path / "o"), str(tmp_path / "b")
    counts = layout.export_months(spark, stored, out, sort=layout.BY_ESTABLISHMENT)
    assert sum(r["n"] for r in counts.collect()) == fact.count()
    load.bulk_load(spark, out, back, str(tmp_path / "r"))
    got = load.read_rollup(spark, str(tmp_path / "r"), A).drop("year_month")
    assert rows(rollups.estimate(got)) == rows(rollups.estimate(rollups.build(fact, A)))


def test_guard(spark, fact, stored, tmp_path):
    assert layout.partition_guard(months.read_months(spark, stored)).count() == 0
    wrong = fact.limit(4).withColumn("year_month", F.lit("2024-12"))
    wrong.write.partitionBy("year_month").parquet(str(tmp_path / "w"))
    got = layout.partition_guard(months.read_months(spark, str(tmp_path / "w")))
    assert got.agg(F.sum("n")).first()[0] == 4


def test_catalog_table(spark, fact, tmp_path):
    assert not layout.table_exists(spark, "doses_t")
    layout.create_fact_table(spark, "doses_t", str(tmp_path / "t"))
    layout.create_fact_table(spark, "doses_t", str(tmp_path / "t"))
    assert layout.table_exists(spark, "doses_t")
    got = spark.table("doses_t")
    assert got.columns == [*CANONICAL, "year_month", "writer"]
    assert [f.dataType for f in got.schema][:56] == [f.dataType for f in FACT_SCHEMA]
    layout.write_months(fact, str(tmp_path / "t"), writer=layout.LOAD)
    layout.register_parts(spark, "doses_t", str(tmp_path / "t"))
    assert spark.table("doses_t").count() == fact.count()
    listed = months.catalog_months(spark, "doses_t")
    assert [r[0] for r in listed.collect()] == ["2025-01", "2025-02", "2025-03"]
    assert "Scan parquet" not in plan(listed)
    spark.sql("DROP TABLE doses_t")


def test_inventory(spark, stored):
    listed = months.inventory(spark, stored)
    assert "content" not in plan(listed)
    totals = months.inventory_totals(listed).first()
    assert (totals["files"], totals["bytes"]) == (3, sum(os.path.getsize(f) for f in files(stored)))
    assert [r["path"][-8:] for r in months.inventory_sample(listed, 2).collect()]
    assert months.inventory_sample(listed, 2).count() == 2


def test_inventory_lists_files_without_rows(spark, fact, tmp_path):
    fact.limit(0).coalesce(1).write.parquet(str(tmp_path / "year_month=2025-01"))
    files_ = months.inventory(spark, str(tmp_path))
    assert [r["bytes"] > 0 for r in files_.collect()] == [True]


def test_real_and_synthetic_files_share_a_month(spark, fact, tmp_path):
    layout.write_months(fact, str(tmp_path), spread=())
    extra = fact.where(F.month("data_vacina") == 1)
    narrow = extra.withColumn("codigo_dose_vacina", F.col("codigo_dose_vacina").cast("tinyint"))
    narrow.drop("nome_fantasia_estalecimento").withColumn(
        "year_month", F.lit("2025-01")
    ).write.mode("append").partitionBy("year_month").parquet(str(tmp_path))
    got = months.read_exchange(spark, str(tmp_path), [202501])
    assert got.count() == 2 * extra.count()
    assert got.where("nome_fantasia_estalecimento is null").count() == extra.count()


def test_lookup_large_dimension_is_not_broadcast(spark, monkeypatch):
    dim = spark.range(50).select(
        F.col("id").cast("string").alias("c"), F.concat(F.lit("n"), "id").alias("n"), F.col("id").alias("o")
    )
    # a third of the rows share one code
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("string").alias("c0"))
    small = lookup.lookup_name(df, "c0", dim, "c", "n", "o", "name")
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup.lookup_name(df, "c0", dim, "c", "n", "o", "name")
        assert "BroadcastHashJoin" not in plan(large)
        assert rows(large) == rows(small)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small.where("c0 = '299' and name = ''").count() == 1


def test_name_token(spark):
    df = spark.createDataFrame(
        [("POSTO DE SAÚDE CENTRO",), ("CENTRO-SUL",), ("EPICENTRO",), (None,)],
        "nome_razao_social_estabelecimento string",
    )
    assert insights.with_name_token(df, "Centro").count() == 2
    assert insights.with_name_token(df, "saúde").count() == 1
