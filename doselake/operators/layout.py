"""Writing the fact table: month partitions, clustering, loading, export, compaction."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doselake.functions.calendar import month_label
from doselake.operators.cleaning import PROBLEM, accepted, load_judge, rejected
from doselake.schema import CANONICAL, FACT_SCHEMA, MONTH, WRITER
from doselake.session import remove, wide_rows
from doselake.sources.months import misplaced, read_exchange, read_months, read_parts

#: Fact order: state and vaccine narrow a scan first, date and age trim within.
BY_STATE = ("sigla_uf_paciente", "sigla_vacina", "data_vacina", "numero_idade_paciente")
#: Second copy, for queries that filter on the date only.
BY_DATE = ("data_vacina", "sigla_uf_paciente", "sigla_vacina")
#: Export order by the establishment's state.
BY_ESTABLISHMENT = ("sigla_uf_estabelecimento", "sigla_vacina", "data_vacina")

#: Columns filtered on but not in the sort order, with their expected distinct values.
BLOOM = {"nome_municipio_paciente": 6_000, "codigo_cnes_estabelecimento": 60_000}
BLOOM_FPP = 0.01
#: Values that hardly repeat: trying a dictionary only costs time.
UNIQUE = ("codigo_documento", "codigo_paciente", "codigo_lote_vacina")
#: Where staged rows come from: the run is the stream's own id, kept in its checkpoint.
RUN, BATCH, PAGE, ORIGIN = "run", "batch_id", "page", "_origin"
#: Writers of the fact table. Streams and generators write one part per batch or shard, named
#: ``stream.<run>.<batch>`` and ``synth.<seed>.<shard>``, that compaction brings into the part of its family.
LOAD, APPEND, STREAM, SYNTH = "load", "append", "stream", "synth"
WITH_ORIGIN = T.StructType(FACT_SCHEMA.fields + [T.StructField(ORIGIN, T.StringType())])
STAGED_SCHEMA = T.StructType(
    FACT_SCHEMA.fields
    + [
        T.StructField(PAGE, T.LongType()),
        T.StructField(MONTH, T.StringType()),
        T.StructField(RUN, T.StringType()),
        T.StructField(BATCH, T.LongType()),
    ]
)
#: Small row groups keep the min/max statistics of sorted columns narrow.
ROW_GROUP_BYTES = 16 * 1024 * 1024


def file_options(bloom: dict[str, int] | None = None, row_group_bytes: int = ROW_GROUP_BYTES):
    """Parquet options of a fact file.

    A bloom filter needs the expected number of distinct values (it takes a
    megabyte otherwise) and is left out by the writer for columns that stay
    dictionary-encoded, where the dictionary serves the same purpose.
    """
    options = {"compression": "zstd", "parquet.block.size": str(row_group_bytes)}
    options |= {f"parquet.enable.dictionary#{column}": "false" for column in UNIQUE}
    for column, ndv in (bloom or {}).items():
        options[f"parquet.bloom.filter.enabled#{column}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{column}"] = str(ndv)
        options[f"parquet.bloom.filter.fpp#{column}"] = str(BLOOM_FPP)
    return options


def write_months(
    df: DataFrame,
    root: str,
    sort: Sequence[str] = BY_STATE,
    spread: Sequence[str] | None = None,
    rows_per_file: int = 0,
    bloom: dict[str, int] | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
    writer: str | Column | None = None,
    shape: Callable[[DataFrame, tuple[str, ...]], DataFrame] | None = None,
    in_place: bool = False,
) -> None:
    """Write month partitions, replacing exactly the months ``df`` has rows for.

    With ``writer`` months are parted by it once more, as in the fact table, and only that writer's part
    is replaced: what others wrote into the month stays. Running it again with the same rows changes nothing. Rows are brought
    together by month and ``spread`` (by default the leading sort column, so that
    a file covers few of its values), and sorted within files. The rebalance
    splits any oversized group, a month or state that holds most rows included,
    into tasks of the advisory size and joins small ones. ``spread=()`` gives one
    file per month while a month fits one task. With ``shape`` the rows are shuffled and sorted as they are, and it makes
    the wide rows to write of them, one of each and in their order, carrying along the columns it is given.
    ``in_place`` leaves out the shuffle: for rows read from files of one month and writer each, of which there are then as
    many as before.
    """
    spread = sort[:1] if spread is None else spread
    keys = [MONTH] if writer is None else [MONTH, WRITER]
    labelled = df.withColumn(MONTH, month_label(F.col("data_vacina")))
    if writer is not None:
        labelled = labelled.withColumn(WRITER, F.lit(writer) if isinstance(writer, str) else writer)
    if not in_place:
        labelled = labelled.hint("rebalance", *keys, *[c for c in spread if c not in keys])
    ordered = labelled.sortWithinPartitions(*keys, *sort)
    with wide_rows(df.sparkSession):
        (
            (shape(ordered, tuple(keys)) if shape else ordered)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", rows_per_file)
            .options(**file_options(bloom, row_group_bytes))
            .partitionBy(*keys)
            .parquet(root)
        )


def gate(df: DataFrame, reject_root: str | None) -> DataFrame:
    """The rows of ``df`` the fact table can hold.

    Others are added to ``reject_root`` with the reason; without it they stop the write.
    """
    judged = load_judge(df)
    bad = rejected(judged)
    if not judged.where(F.col(PROBLEM).isNotNull()).select(PROBLEM).isEmpty():
        if reject_root is None:
            raise ValueError("rows the fact table cannot hold; give reject_root to set them aside")
        bad.write.mode("append").parquet(reject_root)
    return accepted(judged)


def append_months(df: DataFrame, root: str, reject_root: str | None = None) -> None:
    """Add fact rows to their months. Not idempotent: for rows that are new for certain.

    Nulls get the defaults of a load, and rows the table cannot hold are set aside.
    """
    (
        gate(df, reject_root)
        .withColumns({MONTH: month_label(F.col("data_vacina")), WRITER: F.lit(APPEND)})
        .sortWithinPartitions(MONTH, *BY_STATE)
        .write.mode("append")
        .options(**file_options())
        .partitionBy(MONTH, WRITER)
        .parquet(root)
    )


def export_months(
    spark: SparkSession,
    fact_root: str,
    out_root: str,
    months: Iterable[int | str] | None = None,
    sort: Sequence[str] = BY_STATE,
) -> DataFrame:
    """Export months of the fact table to exchange files and return rows per month.

    The dose code keeps its width: a signed byte would lose the codes beyond 127. Files of the fact table hold rows of one
    month, brought together by the column that leads ``BY_STATE``: in an order it leads too they are sorted and written on as
    they are, without another shuffle. For any other order rows are brought together anew.
    """
    rows = read_months(spark, fact_root, months)
    write_months(rows.select(*CANONICAL), out_root, sort, in_place=sort[0] == BY_STATE[0])
    return rows.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n"))


def load_months(
    spark: SparkSession,
    exchange_root: str,
    fact_root: str,
    months: Iterable[int | str] | None = None,
    reject_root: str | None = None,
    bloom: dict[str, int] | None = BLOOM,
) -> None:
    """Load exchange files into the fact table, replacing what earlier loads brought into the months they hold.

    Rows of other writers, a stream's above all, stay. Null and missing columns get defaults. A row the fact table cannot hold, or
    whose date belongs to another month than its partition, is not loaded. With
    ``reject_root`` such rows replace what that folder holds of the loaded months, with
    the reason; without it the load stops before touching the table. A month of which
    every row is set aside ends up empty. The check reads only the columns it is about.
    """
    judged = load_judge(read_exchange(spark, exchange_root, months))
    stray = F.when(
        ~month_label(F.col("data_vacina")).eqNullSafe(F.col(MONTH)),
        F.lit("date outside its month partition"),
    )
    record = F.to_json(F.struct(*CANONICAL, MONTH))
    judged = judged.withColumn(PROBLEM, F.coalesce(PROBLEM, stray)).withColumn(
        "raw", F.when(F.col(PROBLEM).isNotNull(), record)
    )
    # one row per month
    counts = (
        judged.groupBy(MONTH)
        .agg(F.count_if(F.col(PROBLEM).isNull()), F.count_if(F.col(PROBLEM).isNotNull()))
        .collect()
    )
    if any(bad for _, _, bad in counts):
        if reject_root is None:
            raise ValueError("rows the fact table cannot hold; give reject_root to set them aside")
        (
            rejected(judged, keep=(MONTH,))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(MONTH)
            .parquet(reject_root)
        )
    if reject_root is not None:
        empty_months(judged.select(PROBLEM, "raw"), reject_root, [m for m, _, bad in counts if not bad])
    write_months(accepted(judged), fact_root, bloom=bloom, writer=LOAD)
    empty_months(accepted(judged), fact_root, [m for m, good, _ in counts if not good], LOAD)


def part_path(root: str, label: str, writer: str | None = None) -> str:
    return f"{root.rstrip('/')}/{MONTH}={label}" + (f"/{WRITER}={writer}" if writer else "")


def empty_months(like: DataFrame, root: str, labels: Iterable[str], writer: str | None = None) -> None:
    """Leave no rows in the months ``labels`` of ``root``; months it lacks stay absent."""
    for label in labels:
        path = part_path(root, label, writer)
        try:
            like.sparkSession.read.schema(like.schema).parquet(path)
        except AnalysisException:
            continue
        like.limit(0).write.mode("overwrite").parquet(path)


def partition_guard(stored: DataFrame) -> DataFrame:
    """Rows stored under a month they do not belong to, counted per month and date month."""
    return (
        misplaced(stored)
        .groupBy(MONTH, month_label(F.col("data_vacina")).alias("date_month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def compact_months(
    spark: SparkSession,
    root: str,
    months: Iterable[int | str] | None = None,
    sort: Sequence[str] = BY_STATE,
    bloom: dict[str, int] | None = BLOOM,
    out_root: str | None = None,
) -> None:
    """Rewrite months as few sorted files, in place or to ``out_root``.

    Each writer keeps its part; batches of streams and shards of generators come into one part of their family, where
    rows carry the name of the part they came from. In place, new files are complete in a staging folder before
    the old ones go. Parts already brought together by a run that did not end are only removed, so
    running it again after a crash mends the table.
    """
    rows = read_parts(spark, root, WITH_ORIGIN, months)
    family = F.substring_index(WRITER, ".", 1)
    single = F.col(WRITER) != family
    if out_root is not None:
        write_months(rows.drop(MONTH), out_root, sort, bloom=bloom, writer=family)
        return
    # one row per part
    parts = rows.where(single).select(MONTH, WRITER).distinct().collect()
    together = rows.where(~single & F.col(ORIGIN).isNotNull()).select(MONTH, F.col(ORIGIN).alias(WRITER)).distinct()
    # as few as the parts
    fresh = rows.where(single).join(F.broadcast(together), [MONTH, WRITER], "left_anti") if parts else rows.where(single)
    rows = rows.where(~single).unionByName(fresh.withColumn(ORIGIN, F.col(WRITER)))
    write_months(rows.drop(MONTH), root, sort, bloom=bloom, writer=family)
    for label, writer in parts:
        remove(spark, part_path(root, label, writer))


def read_or_none(spark: SparkSession, schema: str | T.StructType, path: str) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def put_parts(spark: SparkSession, rows: DataFrame, root: str, names: list[str], in_place: bool = False) -> None:
    """Make ``rows``, whose ``WRITER`` is one of ``names``, all there is in the fact table of these parts.

    That holds also for parts that were written before, in part, or brought into their family by compaction. For
    ``in_place`` see ``write_months``.
    """
    try:
        there = read_parts(spark, root, WITH_ORIGIN)
    except AnalysisException:
        write_months(rows.drop(MONTH), root, spread=(), bloom=BLOOM, writer=F.col(WRITER), in_place=in_place)
        return
    named = F.col(ORIGIN).isin(names)
    labels = [r[0] for r in there.where(~F.contains(WRITER, F.lit(".")) & named).select(MONTH).distinct().collect()]
    if labels:
        families = sorted({n.split(".")[0] for n in names})
        held = there.where(F.col(MONTH).isin(labels) & F.col(WRITER).isin(families))
        kept = held.where(~named)
        left = {tuple(r) for r in kept.select(MONTH, WRITER).distinct().collect()}
        gone = {tuple(r) for r in held.select(MONTH, WRITER).distinct().collect()} - left
        write_months(kept.drop(MONTH), root, spread=(), bloom=BLOOM, writer=F.col(WRITER))
        for part in gone:
            remove(spark, part_path(root, *part))
    before = {tuple(r) for r in there.where(F.col(WRITER).isin(names)).select(MONTH, WRITER).distinct().collect()}
    write_months(rows.drop(MONTH), root, spread=(), bloom=BLOOM, writer=F.col(WRITER), in_place=in_place)
    if before:
        now = {tuple(r) for r in rows.select(MONTH, WRITER).distinct().collect()}
        for part in before - now:
            remove(spark, part_path(root, *part))


def create_fact_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the partitioned fact table in the catalog unless it exists."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in FACT_SCHEMA.fields
    )
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {MONTH} STRING, {WRITER} STRING) "
        f"USING parquet PARTITIONED BY ({MONTH}, {WRITER}){at}"
    )


def register_parts(spark: SparkSession, name: str, root: str) -> None:
    """The fact table at ``root`` in the catalog, with the partitions it has now."""
    create_fact_table(spark, name, root)
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


