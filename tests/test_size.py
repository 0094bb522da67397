"""What grows with the tables: bytes on disk, and what one task or one batch has to hold."""

from __future__ import annotations

import gzip
from pathlib import Path

from pyspark.sql import functions as F
from test_streaming import land, record, run

from doselake import adapters, registry
from doselake.operators import layout, rollups
from doselake.schema import CANONICAL, RAW_SCHEMA
from doselake.session import WIDE_READ_BYTES, wide_rows
from doselake.sources import months
from doselake.streaming import ingest

READ, FREED = "spark.sql.files.maxPartitionBytes", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_record_lines_are_packed_in_bounded_files(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(registry, "_stored", {})
    monkeypatch.setattr(adapters, "FILE_ROWS", 300)
    path = Path(registry._record_lines(spark, sf_dir))
    parts = sorted(path.glob("part-*"))
    lines = [len(gzip.open(p, "rt", encoding="utf-8").read().split("\n")) - 1 for p in parts]
    assert all(p.name.endswith(".gz") for p in parts)
    assert max(lines) <= 300 < sum(lines)
    assert sum(lines) == registry.table(spark, sf_dir, "events").count()


def test_settings_for_wide_rows_end_with_the_block(spark):
    before = spark.conf.get(READ), spark.conf.get(FREED)
    spark.conf.set(READ, "1m")
    try:
        with wide_rows(spark):
            # a smaller one stays
            assert (int(spark.conf.get(READ)), spark.conf.get(FREED)) == (1 << 20, "true")
        assert spark.conf.get(READ) == "1m"
    finally:
        spark.conf.unset(READ)
    try:
        with wide_rows(spark):
            assert int(spark.conf.get(READ)) == WIDE_READ_BYTES
            raise KeyError
    except KeyError:
        pass
    assert (spark.conf.get(READ), spark.conf.get(FREED)) == before


def test_pages_landed_again_are_in_bounded_files(spark, sf_dir, tmp_path, monkeypatch):
    """One reading task takes many landed files: what it writes must not become one file."""
    pages = str(tmp_path / "pages")
    adapters.land_events(spark, sf_dir, pages, files_multiple=4)
    monkeypatch.setattr(registry, "FILE_ROWS", 200)
    registry._written(spark.read.text(pages).coalesce(1), str(tmp_path / "again"))
    parts = sorted((tmp_path / "again").glob("part-*"))
    lines = [len(gzip.open(p, "rt", encoding="utf-8").read().split("\n")) - 1 for p in parts]
    assert lines == [2] * 5


def test_a_batch_is_held_on_disk(spark, tmp_path, monkeypatch):
    land(tmp_path / "src", {0: [record(0)], 1: [record(1)]})
    levels, take = [], ingest.landings.take
    monkeypatch.setattr(ingest.landings, "take", lambda df, *x: levels.append(df.storageLevel) or take(df, *x))
    sink = ingest.IngestSink(str(tmp_path / "staged"), str(tmp_path / "rejects"))
    run(spark, tmp_path / "src", sink, tmp_path / "checkpoint")
    assert [(x.useDisk, x.useMemory) for x in levels] == [(True, False)]


def test_batches_that_lose_pages_are_rebuilt_in_one_pass(spark, tmp_path, monkeypatch):
    sink = ingest.IngestSink(*(str(tmp_path / x) for x in ("staged", "rejects", "partials")))
    land(tmp_path / "src", {0: [record(0)], 1: [record(1)], 2: [record(2), record(3)]})
    run(spark, tmp_path / "src", sink, tmp_path / "one", files_per_batch=1)
    calls, rebuild = [], ingest.rebuild_partials
    monkeypatch.setattr(ingest, "rebuild_partials", lambda *x: calls.append(sorted(b for _, b in x[2])) or rebuild(*x))
    land(tmp_path / "more", {0: [record(4), record(5)], 1: [record(6), record(7)], 3: [record(8)]})
    run(spark, tmp_path / "more", sink, tmp_path / "two", files_per_batch=9)
    assert [len(x) for x in calls] == [2]
    rows = spark.createDataFrame([record(i) for i in range(2, 9)], RAW_SCHEMA)
    want = ingest.accepted(ingest.judge(rows))
    for spec in rollups.ROLLUPS:
        stored = spark.read.parquet(ingest.rollup_path(sink.partial_root, spec))
        got = rollups.estimate(rollups.merge(stored, spec)).collect()
        assert sorted(got, key=repr) == sorted(rollups.estimate(rollups.build(want, spec)).collect(), key=repr)


def test_export_in_the_stored_order_is_not_shuffled(spark, fact, tmp_path, monkeypatch):
    root = str(tmp_path / "fact")
    layout.write_months(fact, root, writer=layout.LOAD)
    taken, write = [], layout.write_months
    monkeypatch.setattr(layout, "write_months", lambda *x, **kw: taken.append(kw["in_place"]) or write(*x, **kw))
    for sort in (layout.BY_STATE, layout.BY_ESTABLISHMENT):
        out = str(tmp_path / sort[0])
        counts = layout.export_months(spark, root, out, sort=sort)
        assert {r["n"] for r in counts.collect()} == {r["n"] for r in fact.groupBy(F.month("data_vacina")).agg(F.count("*").alias("n")).collect()}
        got = months.read_months(spark, out).select(*CANONICAL)
        assert got.exceptAll(fact).isEmpty() and fact.exceptAll(got).isEmpty()
        for row in got.select(F.input_file_name().alias("f")).distinct().collect():
            keys = [tuple(r) for r in spark.read.parquet(row["f"]).select(*sort).collect()]
            assert keys == sorted(keys)
    assert taken == [True, False]


def test_a_write_leaves_no_shuffle_files(spark, fact, tmp_path, monkeypatch):
    seen, ordered = [], layout.file_options
    monkeypatch.setattr(layout, "file_options", lambda *x: seen.append(spark.conf.get(FREED)) or ordered(*x))
    layout.write_months(fact, str(tmp_path))
    assert seen == ["true"]
