"""Synthetic records at scale.

The job is one pass without a shuffle: ``range`` deals each task exactly one
shard of one month, small weight tables are broadcast, every column is a
function of the row's identity, and the task sorts and writes its shard. A lost
task is computed again with the same result.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doselake.functions.draws import choose, digest, digit, draw, hex_draw, int_div
from doselake.functions.calendar import label_of
from doselake.functions.convert import dose_digits
from doselake.functions.text import zero_pad
from doselake.operators.ids import (
    document_id,
    establishment_code,
    lot_code,
    pooled_patient,
    postal_code,
)
from doselake.operators.cleaning import accepted, load_judge, rejected
from doselake.operators.layout import (
    BLOOM,
    ROW_GROUP_BYTES,
    SYNTH,
    file_options,
    put_parts,
    read_or_none,
    write_months,
)
from doselake.operators.sampling import STATE_NAME, Sampler, biased_day, month_calendar
from doselake.schema import CANONICAL, MONTH, WRITER
from doselake.sources.months import as_label

SHARD_ROWS = 1_500_000
#: Rows that a task of a generation to the table makes, about, where shards are smaller.
TASK_ROWS = 100_000
SHARD_LEDGER = f"seed bigint, {MONTH} string, shard bigint, done boolean"
SEED = 42
#: Sort order of a shard.
SHARD_SORT = ("sigla_uf_paciente", "sigla_vacina", "data_vacina")

# Built-in distributions as (code, description, weight).
SEX = (("F", 5168), ("M", 4831), ("I", 1))
NATURE = (
    ("1", "ADMINISTRACAO PUBLICA", 9466),
    ("2", "ENTIDADES EMPRESARIAIS", 431),
    ("3", "ENTIDADES SEM FINS LUCRATIVOS", 102),
    ("4", "PESSOAS FISICAS", 1),
)
STRATEGY = (
    ("1", "Rotina", 8948),
    ("2", "Especial", 378),
    ("8", "Serviço Privado", 377),
    ("", "", 113),
    ("3", "Pós-exposição", 83),
    ("4", "Campanha indiscriminada", 32),
    ("5", "Intensificação", 20),
    ("6", "Campanha seletiva", 13),
    ("7", "Monitoramento rápido de cobertura vacinal", 11),
    ("9", "Pesquisa", 10),
)
ROUTE = (
    ("0", "Sem registro no sistema de informação de origem", 60),
    ("10916", "Subcutânea", 15),
    ("10915", "Intramuscular", 15),
    ("10918", "Oral", 8),
    ("10917", "Intradérmica", 2),
)
SITE = (
    ("0", "Sem registro no sistema de informação de origem", 50),
    ("14", "Face Externa Superior do Braço Direito", 12),
    ("15", "Face Externa Superior do Braço Esquerdo", 12),
    ("2", "Deltóide Esquerdo", 8),
    ("1", "Deltóide Direito", 8),
    ("7", "Vasto Lateral da Coxa Direita", 4),
    ("8", "Vasto Lateral da Coxa Esquerda", 4),
    ("17", "Glúteo", 2),
)
SYSTEM = (
    ("18602", "ESUS APS - NACIONAL (OFFLINE)", 1),
    ("29376", "SIGA Saúde", 1),
    ("39474", "Prontuário Eletrônico do Cidadão / e-SUS APS", 1),
    ("18822", "SIMUS", 1),
    ("36307", "Prontuário Eletrônico do Cidadão / e-SUS APS", 1),
    ("38976", "Snak Sistemas", 1),
)
# Constant columns of a synthetic record.
CONSTANTS = {
    "nome_pais_paciente": "BRASIL",
    "codigo_pais_paciente": "10",
    "status_documento": "final",
    "descricao_nacionalidade_paciente": "B",
}
# Prefixes of establishment names.
NAME_PREFIX = "ESTABELECIMENTO DE SAUDE "
SHORT_NAME_PREFIX = "UBS "
# Weight of each month in a gap-filling plan.
MONTH_WEIGHTS = {
    1: 1.0,
    2: 0.95,
    3: 1.05,
    4: 1.10,
    5: 1.15,
    6: 1.10,
    7: 0.95,
    8: 1.05,
    9: 1.10,
    10: 1.05,
    11: 0.95,
    12: 0.85,
}

#: Columns drawn from the weight table, as {dimension: {item: column}}.
SAMPLED = {
    "vacina": {
        "item_1": "sigla_vacina",
        "item_2": "descricao_vacina",
        "item_3": "codigo_vacina",
    },
    "dose": {"item_1": "_dose", "item_2": "descricao_dose_vacina"},
    "municipio": {
        "item_1": "codigo_municipio_estabelecimento",
        "item_2": "nome_municipio_estabelecimento",
        "item_3": "sigla_uf_estabelecimento",
        STATE_NAME: "nome_uf_estabelecimento",
    },
    "uf": {"item_1": "sigla_uf_paciente", "item_2": "nome_uf_paciente"},
    "tipo_estabelecimento": {
        "item_1": "codigo_tipo_estabelecimento",
        "item_2": "descricao_tipo_estabelecimento",
    },
    "fabricante": {"item_1": "_maker", "item_2": "_maker_name"},
    "raca": {"item_1": "codigo_raca_cor_paciente", "item_2": "nome_raca_cor_paciente"},
    "idade": {"item_1": "_age"},
}
#: Further draws of a row. Small ranges share one draw as mixed-radix digits.
OTHER_DRAWS = ("date", "person", "form", "lot", "address", "patient")
ALL_DRAWS = (*SAMPLED, *OTHER_DRAWS)


# ---- plans --------------------------------------------------------------------


def shard_seed(base: int | Column, year: Column, month: Column, shard: Column) -> Column:
    base = F.lit(base).cast("bigint") if isinstance(base, int) else base
    return ((base * 31 + year) * 13 + month) * 1000 + shard


def shard_plan(months: DataFrame, shard_rows: int = SHARD_ROWS, seed: int = SEED) -> DataFrame:
    """Shards of each month, from rows ``(yyyymm, month_rows)``; the last shard may be short."""
    size = F.lit(shard_rows).cast("bigint")
    n_shards = int_div(F.col("month_rows") + size - 1, size)
    shards = months.where(F.col("month_rows") > 0).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("bigint"), n_shards - 1))
    )
    year = int_div(F.col("yyyymm").cast("bigint"), F.lit(100).cast("bigint"))
    month = F.col("yyyymm").cast("bigint") % 100
    label = label_of(F.col("yyyymm"))
    file = F.concat(
        F.lit(f"{MONTH}="), label, F.lit("/data-"), zero_pad(F.col("shard"), 2), F.lit(".parquet")
    )
    return shards.select(
        label.alias(MONTH),
        "shard",
        F.least(size, F.col("month_rows") - F.col("shard") * size).alias("n_rows"),
        shard_seed(seed, year, month, F.col("shard")).alias("seed"),
        file.alias("file"),
    )


def plan_totals(plan: DataFrame) -> DataFrame:
    """Shards and rows of a plan."""
    return plan.agg(
        F.count(F.lit(1)).alias("shards"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("rows"),
    )


def seasonal_targets(current: DataFrame, target: int, batch_rows: int = 50_000) -> DataFrame:
    """Rows to add per month, February to December, to bring a table to ``target`` rows.

    ``current`` is one row with the row count ``n``. The gap is shared over the
    eleven months by season; a target already reached gives no rows.
    """
    seasons = F.array(
        *[
            F.struct(F.lit(m).alias("month"), F.lit(w).alias("weight"))
            for m, w in MONTH_WEIGHTS.items()
            if m > 1
        ]
    )
    gap = F.lit(target).cast("bigint") - F.col("n")
    rows = F.floor(F.col("gap") / F.lit(11.0) * F.col("s.weight"))
    size = F.lit(batch_rows).cast("bigint")
    return (
        current.select(gap.alias("gap"), F.explode(seasons).alias("s"))
        .where(F.col("gap") > 0)
        .select("s.month", "s.weight", rows.alias("target_rows"))
        .withColumn("batches", int_div(F.col("target_rows") + size - 1, size))
    )


def shard_identities(
    spark: SparkSession,
    months: Iterable[int | str] | Mapping[int | str, int],
    rows_per_month: int | None = None,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Row identities ``year_month, shard, row, n_rows``, one task per shard.

    ``months`` says how many rows each has, or ``rows_per_month`` does for all. The id space is padded to whole
    shards so that task borders are shard borders; the padding is filtered out.
    """
    if isinstance(months, Mapping):
        rows = {as_label(m): n for m, n in months.items() if n > 0}
    else:
        rows = {as_label(m): rows_per_month or 0 for m in months}
    labels = sorted(rows)
    per_month = -(-max(rows.values(), default=0) // shard_rows)
    slots = max(1, per_month * shard_rows)
    ids = spark.range(0, len(labels) * per_month * shard_rows, 1, max(1, len(labels) * per_month))
    at = int_div(F.col("id"), F.lit(slots).cast("bigint")).cast("int")
    in_month = F.col("id") % slots
    size = F.lit(shard_rows).cast("bigint")
    shard = int_div(in_month, size)
    held = ids.select(
        F.get(F.array(*[F.lit(x) for x in labels]), at).alias(MONTH),
        shard.alias("shard"),
        (in_month % size).alias("row"),
        in_month.alias("_at"),
        F.get(F.array(*[F.lit(rows[x]).cast("bigint") for x in labels]), at).alias("_all"),
    )
    n_rows = F.least(size, F.col("_all") - F.col("shard") * size).alias("n_rows")
    return held.where("_at < _all").select(MONTH, "shard", "row", n_rows)


# ---- records -------------------------------------------------------------------


def with_draws(
    rows: DataFrame, seed: int, method: str = "md5", names: Sequence[str] = ALL_DRAWS
) -> DataFrame:
    """Add the shard seed and one draw column ``d_<name>`` per name.

    The month label is part of a row's identity: shard seeds alone would repeat
    in the next month from the thousandth shard on.
    """
    year, month = F.substring(MONTH, 1, 4).cast("bigint"), F.substring(MONTH, 6, 2).cast("bigint")
    out = rows.withColumn("shard_seed", shard_seed(seed, year, month, F.col("shard")))
    who = identity()
    if method == "md5":
        # two draws from each digest
        return out.withColumns(
            {
                f"d_{n}": hex_draw(digest(who, f"draw-{i // 2}"), 1 + 15 * (i % 2))
                for i, n in enumerate(names)
            }
        )
    return out.withColumns({f"d_{n}": draw(who, n, method) for n in names})


def identity() -> list[Column]:
    return [F.col("shard_seed"), F.col(MONTH), F.col("row")]


def build_records(
    rows: DataFrame,
    sampler: Sampler,
    months: Iterable[int | str],
    seed: int = SEED,
    method: str = "xxhash64",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The 56 columns of a synthetic record for every row identity, in exchange types.

    ``method="md5"`` makes the draws repeatable outside Spark.
    """
    spark = rows.sparkSession
    calendar = F.broadcast(month_calendar(spark, months))  # one row per requested month
    df = with_draws(rows, seed, method).join(calendar, MONTH)
    df = sampler.pick(df, SAMPLED)

    person, form, address = F.col("d_person"), F.col("d_form"), F.col("d_address")
    n_sex, n_nature = sum(x[-1] for x in SEX), sum(x[-1] for x in NATURE)
    present = digit(person, 10, n_sex * n_nature) < 7
    system_scale = n_sex * n_nature * 10
    entry = digit(person, 60, system_scale * len(SYSTEM)) + 1
    route_scale = sum(x[-1] for x in STRATEGY)
    site_scale = route_scale * sum(x[-1] for x in ROUTE)
    city = F.col("nome_municipio_estabelecimento")

    df = df.withColumn("data_vacina", biased_day(F.col("d_date")))
    made = {
        "tipo_sexo_paciente": choose(person, SEX),
        "codigo_natureza_estabelecimento": choose(person, NATURE, 0, n_sex),
        "descricao_natureza_estabelecimento": choose(person, NATURE, 1, n_sex),
        "codigo_estrategia_vacinacao": choose(form, STRATEGY),
        "descricao_estrategia_vacinacao": choose(form, STRATEGY, 1),
        "codigo_via_administracao": choose(form, ROUTE, 0, route_scale),
        "descricao_via_administracao": choose(form, ROUTE, 1, route_scale),
        "codigo_local_aplicacao": choose(form, SITE, 0, site_scale),
        "descricao_local_aplicacao": choose(form, SITE, 1, site_scale),
        "codigo_sistema_origem": choose(person, SYSTEM, 0, system_scale),
        "descricao_sistema_origem": choose(person, SYSTEM, 1, system_scale),
        "codigo_vacina_fabricante": F.when(present, F.col("_maker")),
        "descricao_vacina_fabricante": F.when(present, F.col("_maker_name")).otherwise(F.lit("")),
        "codigo_dose_vacina": dose_digits(F.col("_dose")),
        "numero_idade_paciente": F.col("_age").try_cast("int"),
        # patients are registered in the municipality of the establishment, but
        # their state is an independent draw
        "codigo_municipio_paciente": F.col("codigo_municipio_estabelecimento"),
        "nome_municipio_paciente": city,
        "nome_razao_social_estabelecimento": F.concat(F.lit(NAME_PREFIX), city),
        "nome_fantasia_estalecimento": F.concat(F.lit(SHORT_NAME_PREFIX), city),
        "data_entrada_rnds": F.date_add("data_vacina", entry.cast("int")),
        "data_deletado_rnds": F.lit(None).cast("date"),
        "codigo_paciente": pooled_patient(
            F.col("d_patient"), F.col("n_rows"), F.col("shard_seed"), F.col(MONTH)
        ),
        "codigo_documento": document_id(digest(identity(), "document")),
        "codigo_lote_vacina": lot_code(F.col("d_lot")),
        "codigo_cnes_estabelecimento": establishment_code(address),
        "numero_cep_paciente": postal_code(address, 9_000_000),
        **{name: F.lit(value) for name, value in CONSTANTS.items()},
    }
    have = set(df.columns)
    nothing = F.lit(None).cast("string")
    return df.select(
        *[
            (made[c] if c in made else F.col(c) if c in have else nothing).alias(c)
            for c in CANONICAL
        ],
        MONTH,
        *keep,
    )


def generate(
    sampler: Sampler,
    months: Iterable[int | str] | Mapping[int | str, int],
    rows_per_month: int | None = None,
    shard_rows: int = SHARD_ROWS,
    seed: int = SEED,
    method: str = "xxhash64",
) -> DataFrame:
    """Synthetic records for whole months, one task per shard.

    Where weight tables had to be joined, which deals rows out anew, they are sent back to their shards.
    """
    months = months if isinstance(months, Mapping) else list(months)
    rows = shard_identities(sampler.spark, months, rows_per_month, shard_rows)
    records = build_records(rows, sampler, months, seed, method, keep=("shard",))
    if sampler.joins(SAMPLED):
        labels = sorted({as_label(m) for m in months})
        n = rows.rdd.getNumPartitions()
        per_month = max(1, n // max(1, len(labels)))
        place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(MONTH)) - 1
        records = records.repartitionById(n, (place * per_month + F.col("shard")).cast("int"))
    return records.drop("shard")


def rows_of_months(total: int, months: Sequence[int | str]) -> dict[int | str, int]:
    """Equal shares of ``total``; the first months get one row more until none is left over."""
    each, over = divmod(total, len(months))
    return {m: each + (k < over) for k, m in enumerate(months)}


def generate_to_table(
    rows: DataFrame,
    sampler: Sampler,
    months: Iterable[int | str],
    fact_root: str,
    ledger_root: str,
    seed: int = SEED,
    method: str = "xxhash64",
    reject_root: str | None = None,
) -> None:
    """Synthetic records of row identities ``rows`` into the fact table, every shard once.

    The ledger lists finished shards by seed, month and shard: a second run makes only those it lacks. A shard is a
    part of its own in the table, so one whose run ended before the ledger was written replaces itself, also
    after compaction has moved it. Rows pass the gate of the table: what it can't hold is set
    aside by shard, or stops the run if there is nowhere to put it.

    Identities are dealt out by shard, few columns, and become records in the task that sorts and writes their shard. Where
    weight tables have to be joined, which deals rows out anew, the records are brought together again.
    """
    spark = rows.sparkSession
    name = F.concat_ws(".", F.lit(SYNTH), F.lit(str(seed)), F.col("shard"))
    ended = read_or_none(spark, SHARD_LEDGER, ledger_root).where(F.col("seed") == seed)
    begun, ended = ended.where("not done"), ended.where("done")
    plan = rows.groupBy(MONTH, "shard").agg(F.count("*").alias("n"))
    todo = plan.join(ended, [MONTH, "shard"], "left_anti").join(
        begun.select(MONTH, "shard", F.lit(True).alias("begun")).distinct(), [MONTH, "shard"], "left"
    )
    # one row per shard
    todo = todo.collect()
    if not todo:
        return
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(r["n"] for r in todo) // TASK_ROWS)
    tasks = min(len(todo), tasks)
    todo = [(r[MONTH], r["shard"], bool(r["begun"])) for r in todo]

    def note(done: bool) -> None:
        entries = [(seed, m, s, done) for m, s, _ in todo]
        spark.createDataFrame(entries, SHARD_LEDGER).coalesce(1).write.mode("append").parquet(ledger_root)

    wanted = spark.createDataFrame([(m, s) for m, s, _ in todo], f"{MONTH} string, shard bigint")
    mine = rows.join(F.broadcast(wanted), [MONTH, "shard"], "left_semi")
    judged = load_judge(build_records(mine, sampler, months, seed, method, keep=("shard",)))
    bad = rejected(judged, keep=(MONTH, "shard"))
    if reject_root is not None:
        (
            bad.withColumn(WRITER, name)
            .drop("shard")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(MONTH, WRITER)
            .parquet(reject_root)
        )
    elif not bad.isEmpty():
        raise ValueError("rows the fact table cannot hold; give reject_root to set them aside")
    note(done=False)
    whole = not sampler.joins(SAMPLED)
    if whole:
        dealt = mine.repartition(tasks, MONTH, "shard")
        judged = load_judge(build_records(dealt, sampler, months, seed, method, keep=("shard",)))
    made = accepted(judged, keep=(MONTH, "shard")).withColumn(WRITER, name).drop("shard")
    again = sorted({f"{SYNTH}.{seed}.{s}" for _, s, known in todo if known})
    if again:
        put_parts(spark, made.where(F.col(WRITER).isin(again)), fact_root, again, in_place=whole)
        made = made.where(~F.col(WRITER).isin(again))
    write_months(made.drop(MONTH), fact_root, bloom=BLOOM, writer=F.col(WRITER), in_place=whole)
    note(done=True)


def write_shards(
    records: DataFrame,
    root: str,
    rows_per_file: int = 0,
    row_group_bytes: int = ROW_GROUP_BYTES,
    mode: str = "overwrite",
) -> None:
    """Write each task's shard as sorted files of its month, in exchange types, without a shuffle.

    ``overwrite`` replaces the months written. ``append`` adds to them, next to
    files that came from elsewhere. For the fact table there is ``generate_to_table``.
    """
    (
        records.sortWithinPartitions(MONTH, *SHARD_SORT)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .options(**file_options(row_group_bytes=row_group_bytes))
        .partitionBy(MONTH)
        .parquet(root)
    )
