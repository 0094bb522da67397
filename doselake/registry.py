"""The registered queries: every operator, run on the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from doselake.adapters import (
    FILE_ROWS,
    GENERATED_MONTHS,
    PACKED,
    PAGE_LIMIT,
    as_doses,
    as_records,
    dose_events,
    dose_lines,
    event_rows,
    file_count,
    land_events,
    order_rows,
    raw_events,
    table,
)
from doselake.functions.calendar import label_of, month_label, split_yyyymm, yyyymm
from doselake.functions.convert import date_prefix, dose_digits, small_int, whole_number
from doselake.functions.draws import digest, digit
from doselake.functions.text import optional_text, required_text
from doselake.operators import cleaning, ids, layout, lookup, patients, profile, rollups, sampling
from doselake.operators.rollups import STATE_DEMOGRAPHICS as B
from doselake.operators.rollups import STATE_VACCINE_DATE as A
from doselake.plans import insights, load, synth
from doselake.schema import CANONICAL, ENVELOPE_KEY, FACT_SCHEMA, FIELDS, MONTH, PAGE_SCHEMA
from doselake.session import wide_rows, work_dir
from doselake.sources import legacy, months, pages
from doselake.streaming import progress
from doselake.streaming.ingest import IngestSink, start_ingest, start_live_rollups

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Shard size and base seed of the registered plans.
PLAN_SHARD, PLAN_SEED, PLAN_TARGET = 400, 42, 50_000_000
#: Page number that the gappy landing lacks.
GAP = 47
#: The page that is cut short and the one landed twice.
CUT, TWICE = 2, 5
#: Files of a batch at most; a landed file holds about 25,000 records.
MOST_FILES = 48
#: Files of a batch of fact rows at least.
FACT_FILES = 3
TEXT_FIELDS = [f for f in FIELDS if f.kind == "text"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Tables several queries read are written once per application.
_stored: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = work_dir(spark, name)
        write(path)
        _stored[key] = path
    return _stored[key]


# ---- rollups ---------------------------------------------------------------------


def _rollup(spark: SparkSession, sf_dir: str, spec: rollups.Rollup = A) -> DataFrame:
    return rollups.build(dose_events(spark, sf_dir), spec)


@query
def rollup_a(spark, sf_dir):
    return rollups.estimate(_rollup(spark, sf_dir, A))


@query
def rollup_b(spark, sf_dir):
    return rollups.estimate(_rollup(spark, sf_dir, B))


@query
def rollup_exact(spark, sf_dir):
    return rollups.build_exact(dose_events(spark, sf_dir), A)


@query
def rollup_merge(spark, sf_dir):
    """Partial rows of four blocks, merged."""
    blocks = dose_events(spark, sf_dir, keep=("l_orderkey",))
    blocks = blocks.withColumn("block", F.col("l_orderkey") % 4).drop("l_orderkey")
    partial = rollups.build(blocks, replace(A, keys=("block", *A.keys)))
    return rollups.estimate(rollups.merge(partial, A))


@query
def rollup_refresh(spark, sf_dir):
    """Both rollups backfilled from the stored fact table; the second read back."""
    root = work_dir(spark, "rollups")
    load.refresh(spark, _fact(spark, sf_dir), root, mode="batch")
    return rollups.estimate(load.read_rollup(spark, root, B))


@query
def rollup_refresh_a(spark, sf_dir):
    """Both rollups backfilled from the stored fact table; the first read back."""
    root = work_dir(spark, "rollups")
    load.refresh(spark, _fact(spark, sf_dir), root, mode="batch")
    return rollups.estimate(load.read_rollup(spark, root, A))


@query
def rollup_refresh_months(spark, sf_dir):
    """The rollups of wrong rows, put right month by month from the stored fact table."""
    root, fact = work_dir(spark, "rollups"), _fact(spark, sf_dir)
    wrong = months.read_months(spark, fact).where(F.col("codigo_dose_vacina") > 2)
    for spec in rollups.ROLLUPS:
        rollups.store(rollups.build(wrong, spec), spec, load.rollup_path(root, spec))
    for row in months.discover_months(spark, fact).collect():
        load.backfill(spark, fact, root, [row[MONTH]])
    return rollups.estimate(load.read_rollup(spark, root, A))


@query
def rollup_refresh_live(spark, sf_dir):
    """Fact rows that come in two parts: after each, its partial rollups are folded into the stored ones."""
    root = work_dir(spark, "live-fold")
    rows = dose_events(spark, sf_dir, keep=("l_orderkey",))
    for k in (0, 1):
        rows.where(F.col("l_orderkey") % 2 == k).drop("l_orderkey").write.mode("append").parquet(f"{root}/src")
        stream = spark.readStream.schema(FACT_SCHEMA).parquet(f"{root}/src")
        start_live_rollups(spark, stream, f"{root}/partials", f"{root}/checkpoint").awaitTermination()
        load.fold(spark, f"{root}/partials", f"{root}/rollups", f"{root}/folds", retire=True)
    load.fold(spark, f"{root}/partials", f"{root}/rollups", f"{root}/folds")
    return rollups.estimate(load.read_rollup(spark, f"{root}/rollups", A))


@query
def patients_exact(spark, sf_dir):
    """Two patients for every row: states of four blocks, two of them numbered later, merged per state and vaccine."""
    root = work_dir(spark, "patients")
    rows = dose_events(spark, sf_dir, keep=("l_orderkey", "l_linenumber"))
    rows = rows.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    who = F.concat_ws("-", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "k")))
    rows = rows.withColumn(patients.PATIENT, who).withColumn("block", F.col("l_orderkey") % 4)
    keys = ["sigla_uf_paciente", "sigla_vacina"]
    early, late = rows.where("block < 2"), rows.where("block >= 2")
    patients.number_patients(early).write.parquet(f"{root}/numbers")
    known = spark.read.schema(patients.NUMBERS).parquet(f"{root}/numbers")
    patients.number_patients(late, known).write.mode("append").parquet(f"{root}/more")
    numbers = known.unionByName(spark.read.schema(patients.NUMBERS).parquet(f"{root}/more"))
    for part in (early, late):
        patients.patient_states(part, numbers, ["block", *keys]).write.mode("append").parquet(f"{root}/states")
    states = spark.read.parquet(f"{root}/states")
    whole = [F.lit(None).cast("string").alias(k) for k in keys]
    return patients.count_patients(states, keys).unionAll(
        patients.count_patients(states, []).select(*whole, "unique_patients")
    )


def _stored_rollup(spark: SparkSession, sf_dir: str, spec: rollups.Rollup = A) -> DataFrame:
    """The rollup as the dashboard finds it: built and stored before."""
    path = _once(
        spark,
        sf_dir,
        spec.name,
        lambda path: rollups.store(_rollup(spark, sf_dir, spec), spec, path),
    )
    return spark.read.parquet(path)


@query
def kpi_overview(spark, sf_dir):
    return insights.kpi_overview(_stored_rollup(spark, sf_dir), states=["U0", "U1"])


@query
def vaccine_performance(spark, sf_dir):
    return insights.vaccine_performance(_stored_rollup(spark, sf_dir))


@query
def trends(spark, sf_dir):
    return insights.trends(_stored_rollup(spark, sf_dir))


@query
def state_vaccine_cube(spark, sf_dir):
    return insights.state_vaccine_cube(_stored_rollup(spark, sf_dir))


@query
def demographics(spark, sf_dir):
    return insights.demographics(_stored_rollup(spark, sf_dir, B), 18, 64)


@query
def last_30_days(spark, sf_dir):
    return insights.last_30_days(_stored_rollup(spark, sf_dir))


@query
def daily_stats(spark, sf_dir):
    return insights.daily_stats(_stored_rollup(spark, sf_dir))


@query
def name_token(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return insights.with_name_token(part, "ring", "p_name")


# ---- cleaning ---------------------------------------------------------------------


@query
def clean_strings(spark, sf_dir):
    raw = raw_events(spark, sf_dir, keep=("event_id",))
    cols = [
        (optional_text if f.nullable else required_text)(F.col(f.name)).alias(f.name)
        for f in TEXT_FIELDS
    ]
    return raw.select("event_id", *cols)


@query
def parse_dates(spark, sf_dir):
    raw = raw_events(spark, sf_dir, keep=("event_id",))
    dates = [f.name for f in FIELDS if f.kind == "date"]
    return raw.select("event_id", *[date_prefix(F.col(c)).alias(c) for c in dates])


@query
def clean_ints(spark, sf_dir):
    raw = raw_events(spark, sf_dir, keep=("event_id",))
    return raw.select("event_id", whole_number(F.col("numero_idade_paciente")).alias("age"))


@query
def dose_try_cast(spark, sf_dir):
    dose = F.col("codigo_dose_vacina")
    return raw_events(spark, sf_dir, keep=("event_id",)).select(
        "event_id", small_int(dose).alias("as_byte"), dose_digits(dose).alias("as_digits")
    )


@query
def clean_records(spark, sf_dir):
    return cleaning.clean_records(raw_events(spark, sf_dir))


def _record_lines(spark: SparkSession, sf_dir: str) -> str:
    """Raw records as packed JSON lines; every 37th line is cut short."""

    def write(path: str) -> None:
        rec = F.to_json(F.struct(*CANONICAL))
        line = F.when(
            F.col("event_id") % 37 == 0,
            F.concat(F.lit('{"codigo_documento": "cut-'), F.col("event_id").cast("string")),
        ).otherwise(rec)
        events = event_rows(spark, sf_dir)
        raw = as_records(events.repartition(file_count(events)), keep=("event_id",))
        with wide_rows(spark):
            raw.select(line.alias("value")).write.options(**PACKED).text(path)

    return _once(spark, sf_dir, "record-lines", write)


@query
def quarantine(spark, sf_dir):
    lines = pages.scan_record_lines(spark, _record_lines(spark, sf_dir))
    bad = cleaning.rejected(cleaning.judge(lines))
    document = F.trim(F.get_json_object("raw", "$.codigo_documento"), F.lit(" \t"))
    return bad.select(
        "problem",
        F.when(F.col("problem") == cleaning.MALFORMED, F.col("raw")).otherwise(document).alias(
            "record"
        ),
    )


def _exchange(spark: SparkSession, sf_dir: str) -> str:
    """Month files with null ages and doses and some columns missing."""

    def write(path: str) -> None:
        age = F.when(F.col("l_orderkey") % 5 > 0, F.col("numero_idade_paciente")).cast("int")
        dose = F.when(F.col("l_orderkey") % 7 > 0, F.col("codigo_dose_vacina")).cast("tinyint")

        def sparse(lines: DataFrame, keep: tuple[str, ...]) -> DataFrame:
            return (
                as_doses(lines, ("l_orderkey", *keep))
                .withColumn("numero_idade_paciente", age)
                .withColumn("codigo_dose_vacina", dose)
                .drop("l_orderkey", "nome_uf_estabelecimento", "codigo_origem_registro")
            )

        layout.write_months(dose_lines(spark, sf_dir), path, layout.BY_ESTABLISHMENT, shape=sparse)

    return _once(spark, sf_dir, "exchange", write)


@query
def null_as_default(spark, sf_dir):
    rows = months.read_exchange(spark, _exchange(spark, sf_dir))
    return cleaning.accepted(cleaning.load_judge(rows))


@query
def legacy_align(spark, sf_dir):
    old = legacy.to_legacy(dose_events(spark, sf_dir))
    dose = F.col("codigo_dose_vacina")
    odd = F.when(dose == "3", F.lit("x")).when(dose == "4", F.lit("200")).otherwise(dose)
    age = F.when(dose == "5", 300).when(dose == "6", 40_000).otherwise(F.col("numero_idade_paciente"))
    return legacy.from_legacy(
        old.withColumns({"codigo_dose_vacina": odd, "numero_idade_paciente": age})
    )


@query
def lookup_name(spark, sf_dir):
    """Customers to nation names; the code table lacks some codes and repeats others."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("code"),
        F.col("n_name").alias("name"),
        F.col("n_nationkey").alias("ordinal"),
    )
    code = F.col("code")
    later = nation.where(code % 4 == 0).select(
        "code", F.concat("name", F.lit("-later")).alias("name"), (code + 100).alias("ordinal")
    )
    earlier = nation.where(code % 6 == 0).select(
        "code", F.concat("name", F.lit("-earlier")).alias("name"), (code - 100).alias("ordinal")
    )
    dim = nation.where(code % 10 != 3).unionByName(later).unionByName(earlier)
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return lookup.lookup_name(
        customer, "c_nationkey", dim, "code", "name", "ordinal", "nation_name"
    )


# ---- pages and streams --------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "pages", lambda path: land_events(spark, sf_dir, path))


def _written(lines: DataFrame, path: str, mode: str = "error") -> None:
    """Pages as another landing, in files of as many records as a landed one holds."""
    with wide_rows(lines.sparkSession):
        lines.write.mode(mode).options(**PACKED).option("maxRecordsPerFile", max(1, FILE_ROWS // PAGE_LIMIT)).text(path)


@query
def scan_pages(spark, sf_dir):
    return pages.scan_pages(spark, _landed(spark, sf_dir)).drop("corrupt")


@query
def quarantine_pages(spark, sf_dir):
    """A page cut short and a page landed twice among the landed ones: what comes of all records."""
    src = spark.read.text(_landed(spark, sf_dir))
    number = F.get_json_object("value", "$.offset").cast("bigint")
    lines = src.select(
        F.when(number == CUT, F.substring("value", 1, 400)).otherwise(F.col("value")).alias("value"), number.alias("n")
    )
    path = work_dir(spark, "cut-pages")
    times = F.when(F.col("n") == TWICE, 2).otherwise(1)
    _written(lines.select(F.explode(F.array_repeat("value", times)).alias("value")), path)
    judged = cleaning.judge(pages.scan_pages(spark, path), keep=("page", "pos"))
    return judged.groupBy(F.coalesce(cleaning.PROBLEM, F.lit("accepted")).alias("outcome")).agg(
        F.count("*").alias("n")
    )


def _gappy_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page sizes with a gap: later pages carry a number one too high."""
    sizes = pages.scan_page_sizes(spark, _landed(spark, sf_dir))
    late = F.when(F.col("page") >= GAP, 1).otherwise(0)
    return sizes.withColumn("page", F.col("page") + late)


@query
def page_completeness(spark, sf_dir):
    return pages.page_completeness(_gappy_sizes(spark, sf_dir))


@query
def ingest_progress(spark, sf_dir):
    return pages.ingest_progress(_gappy_sizes(spark, sf_dir))


@query
def stream_ingest(spark, sf_dir):
    """Landed pages through the stream into the fact table, read back."""
    root = work_dir(spark, "ingest")
    _streamed(spark, _landed(spark, sf_dir), root, f"{root}/partials")
    _promoted(spark, root)
    return months.read_months(spark, f"{root}/fact").select(*CANONICAL)


def _streamed(spark: SparkSession, src: str, root: str, partials: str | None = None, checkpoint: str = "one"):
    sink = IngestSink(f"{root}/staged", f"{root}/rejects", partials)
    # several batches of few pages, and batches of bounded size of many
    files = min(MOST_FILES, max(4, len(spark.read.text(src).inputFiles()) // 4))
    start_ingest(spark, src, sink, f"{root}/{checkpoint}", files_per_batch=files).awaitTermination()


def _promoted(spark: SparkSession, root: str) -> None:
    load.promote(spark, f"{root}/staged", f"{root}/fact", f"{root}/ledger")


@query
def stream_reset(spark, sf_dir):
    """Two checkpoints, each with half the pages, into one table; promoted after each and once more."""
    root = work_dir(spark, "reset")
    lines = spark.read.text(_landed(spark, sf_dir))
    odd = F.get_json_object("value", "$.offset").cast("bigint") % 2
    for k in (0, 1):
        _written(lines.where(odd == k), f"{root}/src{k}")
        _streamed(spark, f"{root}/src{k}", root, checkpoint=f"checkpoint{k}")
        _promoted(spark, root)
    _promoted(spark, root)
    return months.read_months(spark, f"{root}/fact").select(*CANONICAL)


@query
def stream_then_compact(spark, sf_dir):
    """A streamed table, compacted, with no rows appended, promoted again: nothing changes."""
    root = work_dir(spark, "stream-compact")
    _streamed(spark, _landed(spark, sf_dir), root)
    _promoted(spark, root)
    layout.compact_months(spark, f"{root}/fact")
    fact = months.read_months(spark, f"{root}/fact").select(*CANONICAL)
    layout.append_months(fact.limit(0), f"{root}/fact")
    _promoted(spark, root)
    return months.read_months(spark, f"{root}/fact").select(*CANONICAL)


@query
def stream_then_load(spark, sf_dir):
    """Streamed pages and loaded exchange files in the same months, each brought in twice: all rows, each once."""
    root = work_dir(spark, "stream-load")
    _streamed(spark, _landed(spark, sf_dir), root)
    for _ in range(2):
        _promoted(spark, root)
        layout.load_months(spark, _exchange(spark, sf_dir), f"{root}/fact", [202501, 202503])
    return months.read_months(spark, f"{root}/fact").select(*CANONICAL)


def _landed_twice(spark: SparkSession, sf_dir: str, root: str, partials: str | None) -> None:
    """Pages that land in two runs: every third is cut to 60 records first and whole later, every fifth twice the same."""
    lines = spark.read.text(_landed(spark, sf_dir))
    page = F.from_json("value", PAGE_SCHEMA)
    short = page.withField(ENVELOPE_KEY, F.slice(page[ENVELOPE_KEY], 1, 60))
    number = page["offset"]
    early = F.when(number % 3 == 0, F.to_json(short, {"ignoreNullFields": "false"})).otherwise(F.col("value"))
    for rows in (
        lines.where(number % 7 > 0).select(early.alias("value")),
        lines.where((number % 7 == 0) | (number % 3 == 0) | (number % 5 == 0)).select("value"),
    ):
        _written(rows, f"{root}/src", "append")
        _streamed(spark, f"{root}/src", root, partials)
        _promoted(spark, root)
        if partials:
            load.fold(spark, partials, f"{root}/rollups", f"{root}/folds", f"{root}/staged")


@query
def stream_repeated_pages(spark, sf_dir):
    """Pages landed twice in a stream count once, the larger landing, also where the other is in the table already."""
    root = work_dir(spark, "repeated")
    _landed_twice(spark, sf_dir, root, None)
    return months.read_months(spark, f"{root}/fact").select(*CANONICAL)


@query
def stream_repeated_rollup(spark, sf_dir):
    """The live rollup of the same, folded after each run."""
    root = work_dir(spark, "repeated-live")
    _landed_twice(spark, sf_dir, root, f"{root}/partials")
    return rollups.estimate(load.read_rollup(spark, f"{root}/rollups", A))


@query
def stream_resume(spark, sf_dir):
    """A stream that fails in its second batch and is started again: no page lost, none taken twice."""
    root = work_dir(spark, "resume")
    _failing(spark, _landed(spark, sf_dir), root)
    _streamed(spark, _landed(spark, sf_dir), root)
    _promoted(spark, root)
    return months.read_months(spark, f"{root}/fact").select(*CANONICAL)


def _failing(spark: SparkSession, src: str, root: str, files_per_batch: int = 1):
    """A stream, of one file a batch unless more are given, that fails after it has staged its second."""
    sink = IngestSink(f"{root}/staged", f"{root}/rejects")

    class Broken(IngestSink):
        def __call__(self, envelopes, batch_id, run=None):
            sink(envelopes, batch_id, run)
            if batch_id == 1:
                raise RuntimeError("planned failure")

    broken = Broken(f"{root}/staged", f"{root}/rejects")
    stream = start_ingest(spark, src, broken, f"{root}/one", files_per_batch=files_per_batch)
    try:
        stream.awaitTermination()
    except StreamingQueryException:
        pass
    return stream


@query
def ingest_status(spark, sf_dir):
    """What the log says of a stream that fails, and of its next start: status, batches, pages, error."""
    root = work_dir(spark, "status")
    third = land_events(spark, sf_dir, f"{root}/src", files_multiple=3) // 3
    log = progress.ProgressLog(spark, f"{root}/status")
    spark.streams.addListener(log)
    try:
        log.wait(_failing(spark, f"{root}/src", root, third))
        sink = IngestSink(f"{root}/staged", f"{root}/rejects")
        stream = start_ingest(spark, f"{root}/src", sink, f"{root}/one", files_per_batch=third)
        stream.awaitTermination()
        log.wait(stream)
    finally:
        spark.streams.removeListener(log)
    rows = progress.ingest_status(spark, f"{root}/status")
    attempt = F.row_number().over(Window.partitionBy("run").orderBy("started")).alias("attempt_no")
    planned = F.contains("error_message", F.lit("planned failure"))
    timed = F.col("started") <= F.col("updated")
    return rows.select(attempt, "status", "batches", planned.alias("planned"), timed.alias("timed"))


@query
def stream_rollup_a(spark, sf_dir):
    """Fact files through the live rollup, partial rows merged on reading."""
    root = work_dir(spark, "live")
    src = _fact(spark, sf_dir)
    rows = spark.read.parquet(src)
    # several batches, not one for every few files of a large table
    files = min(MOST_FILES, max(FACT_FILES, len(rows.inputFiles()) // 4))
    fact = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(src)
    q = start_live_rollups(spark, fact, f"{root}/partials", f"{root}/checkpoint")
    q.awaitTermination()
    return rollups.estimate(rollups.merge(load.read_rollup(spark, f"{root}/partials", A), A))


# ---- months -----------------------------------------------------------------------------


def _fact(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark,
        sf_dir,
        "fact",
        lambda path: layout.write_months(dose_lines(spark, sf_dir), path, writer=layout.LOAD, shape=as_doses),
    )


@query
def month_scan(spark, sf_dir):
    rows = months.read_months(spark, _fact(spark, sf_dir), [202502])
    return rows.select(MONTH, "codigo_documento", "data_vacina", "sigla_vacina")


@query
def discover_months(spark, sf_dir):
    return months.discover_months(spark, _fact(spark, sf_dir))


@query
def catalog_months(spark, sf_dir):
    """Months as the catalog lists them for the fact table."""
    name = "fact_" + uuid.uuid4().hex
    layout.register_parts(spark, name, _fact(spark, sf_dir))
    try:
        rows = months.catalog_months(spark, name).collect()
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(rows, f"{MONTH} string")


@query
def inventory(spark, sf_dir):
    """Files of a table with one file a month, and one file without rows."""
    root = work_dir(spark, "inventory")
    layout.write_months(dose_lines(spark, sf_dir), root, spread=(), row_group_bytes=1 << 30, shape=as_doses)
    dose_events(spark, sf_dir).limit(0).coalesce(1).write.parquet(f"{root}/{MONTH}=2024-01")
    files = months.inventory(spark, root)
    month = F.regexp_extract("path", f"{MONTH}=([^/]*)", 1).alias(MONTH)
    return files.select(month, (F.col("bytes") > 0).alias("has_bytes")).distinct()


@query
def overwrite_month(spark, sf_dir):
    """One month replaced by fewer rows, then a batch without rows: the other months stay."""
    root = work_dir(spark, "overwrite")
    rows = dose_lines(spark, sf_dir)
    layout.write_months(rows, root, writer=layout.LOAD, shape=as_doses)
    fewer = rows.where("month(data_vacina) = 2 and l_linenumber = 1")
    layout.write_months(fewer, root, writer=layout.LOAD, shape=as_doses)
    layout.write_months(rows.limit(0), root, writer=layout.LOAD, shape=as_doses)
    return months.read_months(spark, root).select(*CANONICAL)


@query
def date_first_copy(spark, sf_dir):
    """The copy in date order: rows and days of every file are as the order says."""
    root = work_dir(spark, "by-date")
    layout.compact_months(spark, _fact(spark, sf_dir), sort=layout.BY_DATE, out_root=root)
    rows = months.read_months(spark, root)
    return rows.groupBy("data_vacina").agg(F.count("*").alias("n"), F.min("codigo_documento").alias("first_document"))


@query
def count_records(spark, sf_dir):
    return months.count_records(dose_events(spark, sf_dir))


@query
def count_by_month(spark, sf_dir):
    return months.count_by_month(dose_events(spark, sf_dir))


@query
def month_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        yyyymm(F.col("o_orderdate").cast("date")).alias("yyyymm")
    )
    year, month = split_yyyymm(F.col("yyyymm"))
    return rows.distinct().select(
        "yyyymm", year.alias("year"), month.alias("month"), label_of(F.col("yyyymm")).alias("label")
    )


@query
def partition_guard(spark, sf_dir):
    """Rows of which some are stored under the wrong month."""

    def write(path: str) -> None:
        label = F.when(F.col("l_orderkey") % 50 == 0, F.lit("2025-03")).otherwise(
            month_label(F.col("data_vacina"))
        )
        lines = dose_lines(spark, sf_dir).withColumn(MONTH, label).sortWithinPartitions(MONTH)
        as_doses(lines, (MONTH,)).write.partitionBy(MONTH).parquet(path)

    return layout.partition_guard(
        months.read_months(spark, _once(spark, sf_dir, "misplaced", write))
    )


@query
def load_month(spark, sf_dir):
    root = work_dir(spark, "load")
    layout.load_months(spark, _exchange(spark, sf_dir), f"{root}/fact", [202501, 202503])
    return months.read_months(spark, f"{root}/fact").select(*CANONICAL)


@query
def export_roundtrip(spark, sf_dir):
    """Exported, loaded again, rolled up."""
    root = work_dir(spark, "roundtrip")
    layout.export_months(spark, _fact(spark, sf_dir), f"{root}/out")
    layout.load_months(spark, f"{root}/out", f"{root}/fact")
    fact = months.read_months(spark, f"{root}/fact")
    return rollups.estimate(rollups.build(fact, A))


@query
def compact_month(spark, sf_dir):
    """Many small files of one month rewritten in place; the others stay."""
    root = work_dir(spark, "compact")
    rows = months.read_months(spark, _fact(spark, sf_dir))
    for k in range(6):
        layout.append_months(rows.where(F.pmod(F.xxhash64("codigo_documento"), F.lit(6)) == k), root)
    layout.compact_months(spark, root, ["2025-02"])
    rows = months.read_months(spark, root)
    return rows.select(MONTH, "codigo_documento", "data_vacina", "numero_idade_paciente")


# ---- synthetic data -----------------------------------------------------------------------


@query
def freq_profile(spark, sf_dir):
    return profile.frequency_profile(dose_events(spark, sf_dir))


_samplers: dict[tuple[str, str], sampling.Sampler] = {}


def _sampler(spark: SparkSession, sf_dir: str, inline_rows: int = sampling.INLINE_ROWS):
    key = (spark.sparkContext.applicationId, f"{sf_dir}#{inline_rows}")
    if key not in _samplers:
        weights = profile.frequency_profile(dose_events(spark, sf_dir))
        path = work_dir(spark, "weights")
        _samplers[key] = sampling.Sampler.prepare(weights, path, inline_rows)
    return _samplers[key]


def _drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.with_draws(order_rows(spark, sf_dir, keep=("o_orderkey",)), synth.SEED)


@query
def weighted_sample(spark, sf_dir):
    """From the weight table and from a built-in distribution."""
    sampler = _sampler(spark, sf_dir)
    picks = {
        "vacina": {"item_1": "sigla_vacina"},
        "municipio": {"item_1": "city_code", sampling.STATE_NAME: "state_name"},
        "idade": {"item_1": "age"},
    }
    df = sampler.pick(_drawn(spark, sf_dir), picks)
    sex = synth.choose(F.col("d_person"), synth.SEX)
    return df.select(
        "o_orderkey", "sigla_vacina", "city_code", "state_name", "age", sex.alias("sex")
    )


@query
def weighted_sample_joined(spark, sf_dir):
    """The same with the weight table joined, as for dimensions too large for literals."""
    sampler = _sampler(spark, sf_dir, inline_rows=0)
    picks = {
        "municipio": {"item_1": "city_code", sampling.STATE_NAME: "state_name"},
        "vacina": {"item_1": "sigla_vacina"},
    }
    df = sampler.pick(_drawn(spark, sf_dir), picks)
    return df.select("o_orderkey", "sigla_vacina", "city_code", "state_name")


@query
def weekday_dates(spark, sf_dir):
    calendar = sampling.month_calendar(spark, GENERATED_MONTHS)
    df = _drawn(spark, sf_dir).join(F.broadcast(calendar), MONTH)
    d = F.col("d_date")
    return df.select(
        "o_orderkey",
        sampling.biased_day(d).alias("biased"),
        sampling.resampled_day(d).alias("resampled"),
    )


@query
def entry_dates(spark, sf_dir):
    """Entry 1 to 60 days after the order date."""
    df = _drawn(spark, sf_dir).join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey"
    )
    days = (digit(F.col("d_person"), 60) + 1).cast("int")
    return df.select(
        "o_orderkey", F.date_add(F.col("o_orderdate").cast("date"), days).alias("entered")
    )


@query
def synth_codes(spark, sf_dir):
    address = F.col("d_address")
    return _drawn(spark, sf_dir).select(
        "o_orderkey",
        ids.document_id(digest(synth.identity(), "document")).alias("document"),
        ids.lot_code(F.col("d_lot")).alias("lot"),
        ids.establishment_code(address).alias("cnes"),
        ids.postal_code(address, 9_000_000).alias("cep"),
    )


@query
def synth_derived(spark, sf_dir):
    """Establishment names built from city names."""
    df = _sampler(spark, sf_dir).pick(_drawn(spark, sf_dir), {"municipio": {"item_2": "city"}})
    return df.select(
        "o_orderkey",
        F.concat(F.lit(synth.NAME_PREFIX), F.col("city")).alias("name"),
        F.concat(F.lit(synth.SHORT_NAME_PREFIX), F.col("city")).alias("short_name"),
    )


@query
def synth_patients(spark, sf_dir):
    df = _drawn(spark, sf_dir)
    shard = (F.col("shard_seed"), F.col(MONTH))
    pooled = ids.pooled_patient(F.col("d_patient"), F.col("n_rows"), *shard)
    return df.select(
        "o_orderkey", pooled.alias("pooled"), ids.patient_id(*synth.identity()).alias("single")
    )


@query
def synth_events(spark, sf_dir):
    rows = order_rows(spark, sf_dir)
    records = synth.build_records(rows, _sampler(spark, sf_dir), GENERATED_MONTHS, method="md5")
    return records.select(*CANONICAL)


@query
def generate_to_table(spark, sf_dir):
    """Generated shards in the fact table: made twice, compacted, and made again as if the last run had not ended."""
    root = work_dir(spark, "generated")
    rows, sampler = order_rows(spark, sf_dir), _sampler(spark, sf_dir)

    def run(ledger: str) -> None:
        synth.generate_to_table(rows, sampler, GENERATED_MONTHS, f"{root}/fact", f"{root}/{ledger}", method="md5")

    run("ledger")
    run("ledger")
    layout.compact_months(spark, f"{root}/fact", ["2025-02"])
    begun = spark.read.schema(synth.SHARD_LEDGER).parquet(f"{root}/ledger").where("not done or shard > 0")
    begun.write.parquet(f"{root}/cut-ledger")
    run("cut-ledger")
    return months.read_months(spark, f"{root}/fact").select(*CANONICAL)


def _plan_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order count shared over the twelve months of 2025; what is left over goes to the first months."""
    total = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n"))
    plan = total.select("n", F.explode(F.sequence(F.lit(202501), F.lit(202512))).alias("yyyymm"))
    more = F.expr("if(yyyymm - 202501 < n % 12, 1, 0)")
    return plan.select((F.expr("n div 12") + more).alias("month_rows"), "yyyymm")


@query
def shard_plan(spark, sf_dir):
    return synth.shard_plan(_plan_months(spark, sf_dir), PLAN_SHARD, PLAN_SEED)


@query
def shard_totals(spark, sf_dir):
    return synth.plan_totals(shard_plan(spark, sf_dir))


@query
def seasonal_targets(spark, sf_dir):
    total = months.count_records(table(spark, sf_dir, "orders"))
    return synth.seasonal_targets(total, PLAN_TARGET)
