from __future__ import annotations

import json

import pytest
from helpers import raw_row, rows
from pyspark.sql import functions as F

from doselake.operators import layout, rollups
from doselake.operators.rollups import ROLLUPS
from doselake.plans import load
from doselake.schema import CANONICAL, ENVELOPE_KEY
from doselake.sources import landings
from doselake.sources.months import read_months, read_parts
from doselake.sources.pages import scan_envelopes
from doselake.streaming import ingest


def land(folder, pages):
    folder.mkdir(exist_ok=True)
    for p, records in pages.items():
        line = json.dumps({"offset": p, "limit": 3, ENVELOPE_KEY: records})
        (folder / f"p{p}.json").write_text(line + "\n")


def record(i):
    return raw_row(
        codigo_documento=f"d{i}",
        codigo_paciente=f"p{i % 4}",
        data_vacina=f"2025-0{1 + i % 2}-03 00:00:00-03",
    )


def run(spark, folder, sink, checkpoint, **kw):
    q = ingest.start_ingest(spark, str(folder), sink, str(checkpoint), **kw)
    q.awaitTermination()
    return q


@pytest.fixture
def sink(tmp_path):
    return ingest.IngestSink(*(str(tmp_path / x) for x in ("fact", "rejects", "partials")))


def test_ingest_resume_replay_and_rejects(spark, tmp_path, sink):
    src, checkpoint = tmp_path / "src", tmp_path / "checkpoint"
    bad = raw_row(data_vacina="?", codigo_documento="bad")
    land(src, {0: [record(0), record(1), record(2)], 1: [record(3), bad, record(5)]})
    run(spark, src, sink, checkpoint, files_per_batch=1)
    fact = read_months(spark, sink.staged_root)
    assert {r["codigo_documento"] for r in fact.collect()} == {f"d{i}" for i in (0, 1, 2, 3, 5)}

    # a restart takes new pages only
    land(src, {2: [record(6)]})
    (src / "broken.json").write_text('{"offset": 3, "doses')
    q = run(spark, src, sink, checkpoint)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 2
    fact = read_months(spark, sink.staged_root)
    assert fact.count() == 6 and fact.columns == [*CANONICAL, "year_month"]
    rejects = spark.read.parquet(sink.reject_root)
    assert {(r["problem"], r["page"]) for r in rejects.collect()} == {
        ("no valid data_vacina", 1),
        ("malformed record", None),
    }
    assert any('"offset": 3' in r["raw"] for r in rejects.collect())

    # a replayed batch overwrites what it wrote
    before = rows(fact)
    batch = scan_envelopes(spark, str(src / "p0.json"))
    first = spark.read.parquet(sink.staged_root).where("codigo_documento = 'd0'").first()
    sink(batch, first["batch_id"], first["run"])
    assert rows(read_months(spark, sink.staged_root)) == before

    # live rollups equal a rebuild from the fact table
    load.refresh(spark, sink.partial_root, str(tmp_path / "live"), mode="live")
    load.refresh(spark, sink.staged_root, str(tmp_path / "batch"), mode="batch")
    for spec in ROLLUPS:
        live, batch = (
            rollups.estimate(load.read_rollup(spark, str(tmp_path / d), spec).select(*spec.columns))
            for d in ("live", "batch")
        )
        assert rows(live) == rows(batch)
        assert live.agg({"total_doses": "sum"}).first()[0] == 6


def test_new_checkpoint_loses_nothing(spark, tmp_path, sink):
    fact, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")
    for k in (0, 1):  # other pages, batch 0 again
        src = tmp_path / f"src{k}"
        land(src, {k: [record(2 * k), record(2 * k + 1)]})
        run(spark, src, sink, tmp_path / f"checkpoint{k}")
        for _ in range(2):
            load.promote(spark, sink.staged_root, fact, ledger)
    names = [r["codigo_documento"] for r in read_months(spark, fact).collect()]
    assert sorted(names) == ["d0", "d1", "d2", "d3"]
    for spec in ROLLUPS:
        partial = spark.read.parquet(load.rollup_path(sink.partial_root, spec))
        assert partial.agg({"total_doses": "sum"}).first()[0] == 4
    # a crash before the ledger was written
    load.promote(spark, sink.staged_root, fact, str(tmp_path / "other"))
    assert read_months(spark, fact).count() == 4
    layout.compact_months(spark, fact)
    layout.append_months(read_months(spark, fact).select(*CANONICAL).limit(1), fact)
    assert read_months(spark, fact).count() == 5


def counted(spark, partial_root):
    return [
        spark.read.parquet(load.rollup_path(partial_root, spec)).agg({"total_doses": "sum"}).first()[0] for spec in ROLLUPS
    ]


def test_page_landed_again(spark, tmp_path, sink):
    """The larger landing counts, whenever it comes; one that is no larger changes nothing."""
    fact, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")
    folds, stored = str(tmp_path / "folds"), str(tmp_path / "rollups")
    src = tmp_path / "src"

    def settled():
        load.promote(spark, sink.staged_root, fact, ledger)
        load.fold(spark, sink.partial_root, stored, folds, sink.staged_root)
        names = sorted(r["codigo_documento"] for r in read_months(spark, fact).collect())
        total = load.read_rollup(spark, stored, ROLLUPS[0]).agg({"total_doses": "sum"}).first()[0]
        assert counted(spark, sink.partial_root) == [len(names)] * 2 and total == len(names)
        return names

    # page 1 is all of February in its batch, and is cut
    land(src, {0: [record(0), record(2)], 1: [record(1)]})
    run(spark, src, sink, tmp_path / "c", files_per_batch=1)
    assert settled() == ["d0", "d1", "d2"]
    layout.compact_months(spark, fact)
    line = json.dumps({"offset": 1, "limit": 3, ENVELOPE_KEY: [record(4), record(6)]})
    (src / "again.json").write_text(line + "\n" + line + "\n")
    (src / "same.json").write_text((src / "p0.json").read_text())
    (src / "small.json").write_text(json.dumps({"offset": 0, "limit": 3, ENVELOPE_KEY: [record(9)]}) + "\n")
    run(spark, src, sink, tmp_path / "c")
    assert settled() == ["d0", "d2", "d4", "d6"]
    # the same pages under a new checkpoint
    run(spark, src, sink, tmp_path / "other")
    assert settled() == ["d0", "d2", "d4", "d6"]
    assert settled() == ["d0", "d2", "d4", "d6"]


def test_promotion_that_did_not_end(spark, tmp_path, sink):
    fact, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")
    land(tmp_path / "src", {0: [record(0), record(1)]})
    run(spark, tmp_path / "src", sink, tmp_path / "c")
    load.promote(spark, sink.staged_root, fact, ledger)
    begun = spark.read.parquet(ledger).where("not done")
    begun.write.parquet(str(tmp_path / "cut"))
    layout.compact_months(spark, fact)
    load.promote(spark, sink.staged_root, fact, str(tmp_path / "cut"))
    assert read_months(spark, fact).count() == 2
    # compaction that did not remove the parts it brought together
    load.promote(spark, sink.staged_root, fact, ledger)
    one = read_parts(spark, fact, layout.WITH_ORIGIN).where("year_month = '2025-01'").drop("year_month", "writer")
    one = spark.createDataFrame(one.collect(), one.schema)
    layout.write_months(one.drop(layout.ORIGIN), fact, writer="stream.x.0")
    layout.write_months(one.withColumn(layout.ORIGIN, F.lit("stream.x.0")), fact, writer="stream")
    layout.compact_months(spark, fact)
    assert [r[0] for r in read_parts(spark, fact).select("writer").distinct().collect()] == ["stream"]
    # the row itself and the copy, which is there once
    assert read_months(spark, fact, ["2025-01"]).count() == 2


def test_load_leaves_streamed_rows_alone(spark, tmp_path, sink, fact):
    table, src = str(tmp_path / "table"), str(tmp_path / "x")
    land(tmp_path / "src", {0: [record(0), record(1)]})
    run(spark, tmp_path / "src", sink, tmp_path / "c")
    layout.write_months(fact, src)
    for _ in range(2):
        load.promote(spark, sink.staged_root, table, str(tmp_path / "ledger"))
        layout.load_months(spark, src, table)
    assert read_months(spark, table).count() == fact.count() + 2


def test_fold_reads_new_partials_only(spark, tmp_path, fact):
    partials, stored, folds = (str(tmp_path / x) for x in ("p", "r", "f"))
    halves = [fact.where(F.month("data_vacina") < 3), fact.where(F.month("data_vacina") > 1)]
    for k, half in enumerate(halves):
        ingest.write_partials(half, "run", k, partials)
        load.fold(spark, partials, stored, folds)
        if not k:
            # rows that a second fold must not read
            for spec in ROLLUPS:
                folded = spark.read.schema(spec.schema).parquet(load.rollup_path(partials, spec))
                folded.limit(3).coalesce(1).write.mode("append").parquet(
                    f"{load.rollup_path(partials, spec)}/year_month=2025-01/run=run/batch_id=0"
                )
    both = halves[0].unionByName(halves[1])
    for spec in ROLLUPS:
        got = rollups.estimate(load.read_rollup(spark, stored, spec).select(*spec.columns))
        assert rows(got) == rows(rollups.estimate(rollups.build(both, spec)))


def test_fold_that_did_not_end(spark, tmp_path, fact, monkeypatch):
    partials, stored, folds = (str(tmp_path / x) for x in ("p", "r", "f"))
    ingest.write_partials(fact, "run", 0, partials)
    monkeypatch.setattr(load, "_finish", lambda *_: None)
    load.fold(spark, partials, stored, folds)
    monkeypatch.undo()
    load.fold(spark, partials, stored, folds, retire=True)
    load.fold(spark, partials, stored, folds)
    for spec in ROLLUPS:
        got = rollups.estimate(load.read_rollup(spark, stored, spec).select(*spec.columns))
        assert rows(got) == rows(rollups.estimate(rollups.build(fact, spec)))


def test_ingest_without_live_rollups(spark, tmp_path):
    src = tmp_path / "src"
    land(src, {0: [record(0)]})
    sink = ingest.IngestSink(str(tmp_path / "f"), str(tmp_path / "r"))
    run(spark, src, sink, tmp_path / "c")
    assert read_months(spark, sink.staged_root).count() == 1


def test_one_file_per_page_stream(spark, tmp_path, sink):
    src = tmp_path / "src"
    src.mkdir()
    for p in range(3):
        body = json.dumps({ENVELOPE_KEY: [record(p)]}, indent=1)
        (src / f"page-{p:06d}.json").write_text(body)
    run(spark, src, sink, tmp_path / "c", packed=False)
    assert read_months(spark, sink.staged_root).count() == 3


def test_unknown_refresh_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        load.refresh(spark, str(tmp_path), str(tmp_path), mode="other")


def test_pages_and_staged_rows_are_shuffled_once_at_most(spark, tmp_path, sink):
    """Known landings come to the pages, and staged files are written on by the tasks that read them."""
    src = tmp_path / "src"
    land(src, {0: [record(0), record(1)], 1: [record(2)]})
    run(spark, src, sink, tmp_path / "checkpoint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        taken = landings.take(scan_envelopes(spark, str(src)), sink.staged_root, "other", 0)
        assert "BroadcastHashJoin" in taken._jdf.queryExecution().executedPlan().toString()
        assert [r["counts"] for r in taken.collect()] == [False, False]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    staged = read_months(spark, sink.staged_root).select(*CANONICAL)
    layout.write_months(staged, str(tmp_path / "written"), writer="one", in_place=True)
    fact = read_months(spark, str(tmp_path / "written")).select(*CANONICAL)
    assert rows(fact) == rows(staged)
    assert len(fact.inputFiles()) <= len(staged.inputFiles())


def test_live_rollups_read_the_columns_they_need(spark, tmp_path, monkeypatch, sf_dir):
    from doselake import registry

    src = registry._fact(spark, sf_dir)
    taken, write = [], ingest.write_partials
    monkeypatch.setattr(ingest, "write_partials", lambda df, *x: taken.append(df.columns) or write(df, *x))
    want = sorted(registry.stream_rollup_a(spark, sf_dir).collect())
    assert want == sorted(rollups.estimate(rollups.build(spark.read.parquet(src), ROLLUPS[0])).collect())
    assert {len(columns) for columns in taken} == {8}
    # a quarter of the files is a batch, three at least and 48 at most
    taken.clear()
    for _ in range(40):
        spark.read.parquet(src).limit(5).coalesce(1).write.mode("append").parquet(str(tmp_path / "many"))
    monkeypatch.setattr(registry, "_fact", lambda *_: str(tmp_path / "many"))
    registry.stream_rollup_a(spark, sf_dir)
    assert len(taken) == 4
