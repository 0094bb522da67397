"""What is shuffled and written: steps whose cost once grew with 56 columns or with their text."""

from __future__ import annotations

import gzip
import json
from pathlib import Path

from pyspark.sql import functions as F

from doselake.adapters import as_doses, dose_events, dose_lines, land_events
from doselake.operators import layout
from doselake.schema import CANONICAL, ENVELOPE_KEY, MONTH
from doselake.sources import months, pages


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_landed_pages_are_packed_and_whole(spark, sf_dir, tmp_path):
    path = str(tmp_path / "pages")
    files = land_events(spark, sf_dir, path, files_multiple=3)
    parts = sorted(Path(path).glob("part-*"))
    assert len(parts) <= files
    assert files % 3 == 0
    assert all(p.name.endswith(".gz") for p in parts)
    found = [json.loads(line) for p in parts for line in gzip.open(p, "rt", encoding="utf-8")]
    assert sorted(f["offset"] for f in found) == list(range(10))
    assert all(len(f[ENVELOPE_KEY]) == f["limit"] == 100 and list(f[ENVELOPE_KEY][0]) == CANONICAL for f in found)


def test_pages_that_landed_once_are_not_shuffled(spark, sf_dir, tmp_path):
    path = str(tmp_path / "pages")
    land_events(spark, sf_dir, path)
    assert "Exchange" not in _plan(pages.scan_pages(spark, path))
    # one page again, shorter: only this page is compared, and the larger landing stays
    lines = spark.read.text(path).where(F.get_json_object("value", "$.offset") == "4")
    short = lines.select(F.regexp_replace("value", r'"doses_aplicadas_pni":.*$', '"doses_aplicadas_pni":[]}').alias("value"))
    short.write.mode("append").text(path)
    rows = pages.scan_pages(spark, path)
    assert rows.count() == 1000
    assert rows.where("page = 4").select("pos").distinct().count() == 100


def test_rows_widen_after_the_shuffle(spark, sf_dir, tmp_path):
    root = str(tmp_path / "fact")
    layout.write_months(dose_lines(spark, sf_dir), root, writer=layout.LOAD, shape=as_doses)
    got = months.read_months(spark, root).select(*CANONICAL)
    want = dose_events(spark, sf_dir).select(*CANONICAL)
    assert got.exceptAll(want).isEmpty()
    assert want.exceptAll(got).isEmpty()
    # files are sorted as before
    for row in months.read_parts(spark, root).select(F.input_file_name().alias("f")).distinct().collect():
        keys = [tuple(r) for r in spark.read.parquet(row["f"]).select(*layout.BY_STATE).collect()]
        assert keys == sorted(keys)
    assert months.discover_months(spark, root).select(MONTH).count() == 3
