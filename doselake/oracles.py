"""ANSI SQL with the same meaning as each registered query, on the same tables."""

from __future__ import annotations

from doselake.adapters import DOSE_EVENTS_ANSI, RAW_EVENTS, SHARD
from doselake.operators.cleaning import MALFORMED
from doselake.operators.ids import LOT_PREFIXES, LOT_SUFFIXES
from doselake.operators.profile import DIMENSIONS
from doselake.operators.rollups import STATE_DEMOGRAPHICS, STATE_VACCINE_DATE, Rollup
from doselake.plans import synth
from doselake.registry import GAP, PLAN_SEED, PLAN_SHARD, PLAN_TARGET, TEXT_FIELDS
from doselake.schema import CANONICAL, FIELDS

A, B = STATE_VACCINE_DATE, STATE_DEMOGRAPHICS


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} as {c}" for c, e in columns.items())


def _lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


DOSES = f"doses as (select {_select(DOSE_EVENTS_ANSI)} from lineitem)"
RAW = f"raw as (select event_id, {_select(RAW_EVENTS)} from events)"


# ---- rollups ---------------------------------------------------------------------


#: Written out apart from the library, so that a wrong condition there shows.
_COUNTS = {
    "count_age": "numero_idade_paciente is not null",
    "female_count": "tipo_sexo_paciente = 'F'",
    "male_count": "tipo_sexo_paciente = 'M'",
    "first_doses": "codigo_dose_vacina = 1",
    "second_doses": "codigo_dose_vacina = 2",
    "boosters": "codigo_dose_vacina > 2",
    "completed_series": "codigo_dose_vacina > 1",
    "children": "numero_idade_paciente <= 17",
    "young_adults": "numero_idade_paciente > 17 and numero_idade_paciente <= 29",
    "adults": "numero_idade_paciente > 29 and numero_idade_paciente <= 49",
    "middle_aged": "numero_idade_paciente > 49 and numero_idade_paciente <= 64",
    "seniors": "numero_idade_paciente > 64",
}
_OF_A = [n for n in _COUNTS if n != "completed_series"]
_OF_B = ["first_doses", "second_doses", "boosters", "completed_series"]


def _measures(spec: Rollup) -> dict[str, str]:
    out = {"total_doses": "count(*)", "unique_patients": "count(distinct codigo_paciente)"}
    if spec is A:
        out["sum_age"] = "cast(sum(cast(numero_idade_paciente as bigint)) as bigint)"
    return out | {n: f"count(*) filter (where {_COUNTS[n]})" for n in (_OF_A if spec is A else _OF_B)}


def _rollup(spec: Rollup, extra: str = "") -> str:
    keys = ", ".join(spec.keys)
    return f"with {DOSES} select {keys}{extra}, {_select(_measures(spec))} from doses group by all"


def _grouped(keys: dict[str, str], names: list[str], where: str = "true", spec: Rollup = A) -> str:
    m = _measures(spec) | {
        "average_age": "round(sum(cast(numero_idade_paciente as double)) "
        "/ count(numero_idade_paciente), 6)"
    }
    cols = ", ".join(
        [f"{e} as {k}" for k, e in keys.items()] + [f"{m[n]} as {n}" for n in names]
    )
    by = "group by all" if keys else ""
    return f"with {DOSES} select {cols} from doses where {where} {by}"


_KINDS = ["first_doses", "second_doses", "boosters"]
_TOTALS = ["total_doses", "unique_patients"]
_ENDS = "(select max(data_vacina) from doses)"


def _trends() -> str:
    grains = {
        "day": "data_vacina",
        "week": "cast(date_trunc('week', data_vacina) as date)",
        "month": "cast(date_trunc('month', data_vacina) as date)",
    }
    m = _measures(A)
    cols = ", ".join(f"{m[n]} as {n}" for n in _TOTALS + _KINDS)
    parts = [
        f"select '{g}' as grain, {e} as period, {cols} from doses group by all"
        for g, e in grains.items()
    ]
    return f"with {DOSES} " + " union all ".join(parts)


def _cube() -> str:
    m = _measures(A)
    names = _TOTALS + ["female_count", "male_count", "boosters"]
    cols = ", ".join(f"{m[n]} as {n}" for n in names)
    return (
        f"with {DOSES} select sigla_uf_paciente, sigla_vacina, "
        f"cast(grouping(sigla_uf_paciente, sigla_vacina) as integer) as level, {cols} "
        "from doses group by cube (sigla_uf_paciente, sigla_vacina)"
    )


# ---- cleaning ---------------------------------------------------------------------

_SPACE = (
    r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
STRIP_PATTERN = f"^{_SPACE}+|{_SPACE}+$"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '{STRIP_PATTERN}', '', 'g')"


def _required(c: str) -> str:
    return f"coalesce({_strip(c)}, '')"


def _date(c: str) -> str:
    day = f"split_part({c}, ' ', 1)"
    shape = f"regexp_full_match({day}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')"
    return f"case when {shape} then cast(try_strptime({day}, '%Y-%m-%d') as date) end"


def _int(c: str) -> str:
    s = _strip(c)
    shape = f"regexp_full_match({s}, '[+-]?[0-9]+(_[0-9]+)*')"
    digits = f"replace(replace({s}, '_', ''), '+', '')"
    limit = f"case when {digits} like '-%' then -9223372036854775808 else 9223372036854775807 end"
    parsed = f"coalesce(try_cast({digits} as bigint), {limit})"
    return f"cast(case when {shape} then {parsed} else 0 end as bigint)"


_SMALL = "[+-]?[0-9]+"


def _small_int(c: str) -> str:
    number = f"try_cast(replace({c}, '+', '') as tinyint)"
    return f"case when regexp_full_match({c}, '{_SMALL}') then {number} end"


def _digits(c: str) -> str:
    number = f"try_cast({c} as tinyint)"
    return f"case when regexp_full_match({c}, '[0-9]+') then {number} end"


def _cleaned() -> dict[str, str]:
    out = {}
    for f in FIELDS:
        if f.kind == "date":
            out[f.name] = _date(f.name)
        elif f.kind == "byte":
            out[f.name] = _int(f.name)
        else:
            out[f.name] = _strip(f.name) if f.nullable else _required(f.name)
    return out


def _problem(corrupt: str = "false") -> str:
    cases = [f"when {corrupt} then '{MALFORMED}'"]
    for f in FIELDS:
        if f.key:
            cases.append(f"when {f.name} is null then 'no valid {f.name}'")
        elif f.kind == "byte":
            cases.append(f"when {f.name} not between 0 and 255 then '{f.name} out of range'")
    return "case " + " ".join(cases) + " end"


_CLEAN = f"{RAW}, clean as (select event_id, {_select(_cleaned())} from raw)"
_AS_FACT = ", ".join(
    f"cast({f.name} as smallint) as {f.name}" if f.kind == "byte" else f.name for f in FIELDS
)
_CLEAN_FACT = f"with {_CLEAN} select {_AS_FACT} from clean where {_problem()} is null"

_BOTH = f"with {_CLEAN}, streamed as (select {_AS_FACT} from clean where {_problem()} is null), loaded as () " + (
    f"select {', '.join(CANONICAL)} from streamed union all select {', '.join(CANONICAL)} from loaded"
)
_DEFAULTS = ", ".join(
    f"cast(coalesce({f.name}, 0) as smallint) as {f.name}"
    if f.kind == "byte"
    else f"coalesce({f.name}, '') as {f.name}"
    if f.kind == "text" and not f.nullable
    else f.name
    for f in FIELDS
)

_QUARANTINE = (
    f"with {_CLEAN}, judged as (select event_id, {_problem('event_id % 37 = 0')} as problem "
    "from clean) select problem, case when event_id % 37 = 0 "
    "then concat('{\"codigo_documento\": \"cut-', cast(event_id as varchar)) "
    "else concat('doc-', cast(event_id as varchar)) end as record "
    "from judged where problem is not null"
)


def _exchange(where: str = "true") -> str:
    """Fact rows after the exchange files lost some values and columns."""
    cols = dict(DOSE_EVENTS_ANSI)
    age, dose = cols["numero_idade_paciente"], cols["codigo_dose_vacina"]
    cols["numero_idade_paciente"] = (
        f"cast(case when l_orderkey % 5 > 0 then {age} else 0 end as smallint)"
    )
    cols["codigo_dose_vacina"] = (
        f"cast(case when l_orderkey % 7 > 0 then {dose} else 0 end as smallint)"
    )
    cols["nome_uf_estabelecimento"] = "''"
    cols["codigo_origem_registro"] = "cast(null as varchar)"
    return f"with x as (select {_select(cols)} from lineitem) select * from x where {where}"


def _legacy() -> str:
    cols = dict(DOSE_EVENTS_ANSI)
    # code "x" and ages 300 and 40000 are set aside, code "200" is kept
    cols["codigo_dose_vacina"] = (
        "cast(case when l_linenumber = 4 then 200 else l_linenumber end as smallint)"
    )
    return f"select {_select(cols)} from lineitem where l_linenumber not in (3, 5, 6)"


_LOOKUP = """
with dim as (
  select n_nationkey as code, n_name as name, n_nationkey as ordinal
  from nation where n_nationkey % 10 <> 3
  union all
  select n_nationkey, concat(n_name, '-later'), n_nationkey + 100
  from nation where n_nationkey % 4 = 0
  union all
  select n_nationkey, concat(n_name, '-earlier'), n_nationkey - 100
  from nation where n_nationkey % 6 = 0),
names as (
  select code, name from dim d
  where ordinal = (select min(ordinal) from dim e where e.code = d.code))
select c_custkey, c_nationkey, coalesce(name, '') as nation_name
from customer left join names on c_nationkey = code
"""


# ---- pages ------------------------------------------------------------------------

_SIZES = (
    "sizes as (select page + case when page >= "
    f"{GAP} then 1 else 0 end as page, count(*) as n "
    "from (select event_id // 100 as page from events) e group by page)"
)
_COMPLETENESS = f"""
{_SIZES},
gap as (select min(p) as next_page from (
  select page + 1 as p from sizes union all select 0) c
  where p not in (select page from sizes)),
done as (select count(*) as pages, cast(sum(n) as bigint) as total_records,
  min(case when n < 100 then page end) as end_page from sizes)
"""
_IS_COMPLETE = "end_page is not null and next_page > end_page"


# ---- synthetic data -----------------------------------------------------------------

ROWS = (
    "rows as (select o_orderkey, concat('2025-0', cast(o_orderkey % 3 + 1 as varchar)) "
    "as year_month, "
    f"(o_orderkey // 3) // {SHARD} as shard, (o_orderkey // 3) % {SHARD} as row_no, "
    f"((({synth.SEED} * 31 + 2025) * 13 + o_orderkey % 3 + 1) * 1000 "
    f"+ (o_orderkey // 3) // {SHARD}) as shard_seed from orders)"
)


def _md5(salt: str) -> str:
    who = ", ".join(f"cast({c} as varchar)" for c in ("shard_seed", "year_month", "row_no"))
    return f"md5(concat_ws(':', {who}, '{salt}'))"


def _draws() -> str:
    cols = {}
    for i, name in enumerate(synth.ALL_DRAWS):
        start = 1 + 15 * (i % 2)
        cols[f"d_{name}"] = (
            f"cast(concat('0x', substr({_md5(f'draw-{i // 2}')}, {start}, 15)) as bigint)"
        )
    return f"{ROWS}, drawn as (select *, {_select(cols)} from rows)"


DRAWN = _draws()


def _digit(d: str, below: int, scale: int = 1) -> str:
    return f"(({d} // {scale}) % {below})"


def _choose(d: str, weighted, position: int = 0, scale: int = 1) -> str:
    x, upto, cases = _digit(d, sum(w[-1] for w in weighted), scale), 0, []
    for item in weighted:
        upto += item[-1]
        cases.append(f"when {x} < {upto} then {_lit(item[position])}")
    return f"case {' '.join(cases)} end"


def _profile() -> str:
    parts = []
    for name, columns in DIMENSIONS.items():
        items = [f"cast({c} as varchar)" for c in columns] + ["''"] * (3 - len(columns))
        named = ", ".join(f"{e} as item_{i + 1}" for i, e in enumerate(items))
        parts.append(
            f"select '{name}' as dimension, {named}, count(*) as weight from doses "
            f"where {columns[0]} is not null group by all"
        )
    return f"{DOSES}, weights as (" + " union all ".join(parts) + ")"


PROFILE = _profile()
RANGES = f"""{PROFILE},
state_names as (
  select item_1 as state, min_by(item_2, (-weight, item_2)) as state_name
  from weights where dimension = 'uf' group by all),
ordered as (
  select w.*, coalesce(state_name, '') as item_4, md5(concat_ws('|', item_1, item_2, item_3)) as h
  from weights w left join state_names s on w.dimension = 'municipio' and w.item_3 = s.state),
ranges as (
  select *, cast(sum(weight) over (partition by dimension order by h) as bigint) as hi,
    cast(sum(weight) over (partition by dimension) as bigint) as total from ordered)"""


def _pick(alias: str, dimension: str) -> str:
    d = f"d_{dimension}"
    return (
        f"join ranges {alias} on {alias}.dimension = '{dimension}' "
        f"and {d} % {alias}.total >= {alias}.hi - {alias}.weight "
        f"and {d} % {alias}.total < {alias}.hi"
    )


CALENDAR = """days as (
  select cast(d as date) as d from generate_series(date '2025-01-01', date '2025-03-31',
    interval 1 day) t(d)),
calendar as (
  select strftime(d, '%Y-%m') as ym,
    list(d order by d) filter (where isodow(d) < 6) as week_days,
    list(d order by d) filter (where isodow(d) >= 6) as weekend_days
  from days group by all)"""


def _day(weekend_weight: str, week_weight: str) -> str:
    w, k = "len(weekend_days)", "len(week_days)"
    x = f"(d_date % ({w} * ({weekend_weight}) + {k} * ({week_weight})))"
    split = f"({w} * ({weekend_weight}))"
    return (
        f"case when {x} < {split} then weekend_days[{x} // ({weekend_weight}) + 1] "
        f"else week_days[({x} - {split}) // ({week_weight}) + 1] end"
    )


BIASED = _day("1", "3")
RESAMPLED = _day("12 * len(week_days)", "100 * len(week_days) + 88 * len(weekend_days)")


def _document() -> str:
    h = _md5("document")
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return f"concat_ws('-', {', '.join(f'substr({h}, {p}, {n})' for p, n in cuts)}, 'i0b0')"


def _one_of(d: str, values, scale: int) -> str:
    cases = " ".join(
        f"when {_digit(d, len(values), scale)} = {i} then '{v}'" for i, v in enumerate(values)
    )
    return f"case {cases} end"


def _lot() -> str:
    letters = [f"chr(cast(65 + {_digit('d_lot', 26, 12 * 26**i)} as integer))" for i in range(4)]
    number = f"lpad(cast({_digit('d_lot', 999, 12 * 26**4)} + 1 as varchar), 3, '0')"
    parts = [_one_of("d_lot", LOT_PREFIXES, 1), *letters, number, _one_of("d_lot", LOT_SUFFIXES, 3)]
    return f"concat({', '.join(parts)})"


_CNES = f"cast(1000000 + {_digit('d_address', 9_000_000)} as varchar)"
_CEP = f"cast(10000 + {_digit('d_address', 90_000, 9_000_000)} as varchar)"
_POOLED = (
    "sha256(concat_ws(':', cast(shard_seed as varchar), year_month, 'patient', "
    f"cast(d_patient % {SHARD * 6 // 10} as varchar)))"
)
_SINGLE = (
    "sha256(concat_ws(':', cast(shard_seed as varchar), year_month, cast(row_no as varchar)))"
)


def _records() -> str:
    n_sex, n_nature = sum(x[-1] for x in synth.SEX), sum(x[-1] for x in synth.NATURE)
    system = n_sex * n_nature * 10
    n_system = len(synth.SYSTEM)
    route = sum(x[-1] for x in synth.STRATEGY)
    site = route * sum(x[-1] for x in synth.ROUTE)
    present = f"{_digit('d_person', 10, n_sex * n_nature)} < 7"
    entry = f"cast({_digit('d_person', 60, system * n_system)} + 1 as integer)"
    made = {
        "data_vacina": BIASED,
        "data_entrada_rnds": f"{BIASED} + {entry}",
        "data_deletado_rnds": "cast(null as date)",
        "tipo_sexo_paciente": _choose("d_person", synth.SEX),
        "codigo_natureza_estabelecimento": _choose("d_person", synth.NATURE, 0, n_sex),
        "descricao_natureza_estabelecimento": _choose("d_person", synth.NATURE, 1, n_sex),
        "codigo_sistema_origem": _choose("d_person", synth.SYSTEM, 0, system),
        "descricao_sistema_origem": _choose("d_person", synth.SYSTEM, 1, system),
        "codigo_estrategia_vacinacao": _choose("d_form", synth.STRATEGY),
        "descricao_estrategia_vacinacao": _choose("d_form", synth.STRATEGY, 1),
        "codigo_via_administracao": _choose("d_form", synth.ROUTE, 0, route),
        "descricao_via_administracao": _choose("d_form", synth.ROUTE, 1, route),
        "codigo_local_aplicacao": _choose("d_form", synth.SITE, 0, site),
        "descricao_local_aplicacao": _choose("d_form", synth.SITE, 1, site),
        "sigla_vacina": "vac.item_1",
        "descricao_vacina": "vac.item_2",
        "codigo_vacina": "vac.item_3",
        "codigo_dose_vacina": "try_cast(dos.item_1 as tinyint)",
        "descricao_dose_vacina": "dos.item_2",
        "codigo_municipio_estabelecimento": "mun.item_1",
        "codigo_municipio_paciente": "mun.item_1",
        "nome_municipio_estabelecimento": "mun.item_2",
        "nome_municipio_paciente": "mun.item_2",
        "sigla_uf_estabelecimento": "mun.item_3",
        "nome_uf_estabelecimento": "mun.item_4",
        "nome_razao_social_estabelecimento": f"concat('{synth.NAME_PREFIX}', mun.item_2)",
        "nome_fantasia_estalecimento": f"concat('{synth.SHORT_NAME_PREFIX}', mun.item_2)",
        "sigla_uf_paciente": "uf.item_1",
        "nome_uf_paciente": "uf.item_2",
        "codigo_tipo_estabelecimento": "tip.item_1",
        "descricao_tipo_estabelecimento": "tip.item_2",
        "codigo_vacina_fabricante": f"case when {present} then fab.item_1 end",
        "descricao_vacina_fabricante": f"case when {present} then fab.item_2 else '' end",
        "codigo_raca_cor_paciente": "rac.item_1",
        "nome_raca_cor_paciente": "rac.item_2",
        "numero_idade_paciente": "cast(ida.item_1 as integer)",
        "codigo_paciente": _POOLED,
        "codigo_documento": _document(),
        "codigo_lote_vacina": _lot(),
        "codigo_cnes_estabelecimento": _CNES,
        "numero_cep_paciente": _CEP,
    } | {c: f"'{v}'" for c, v in synth.CONSTANTS.items()}
    cols = ", ".join(f"{made.get(c, 'cast(null as varchar)')} as {c}" for c in CANONICAL)
    joins = " ".join(_pick(name[:3], name) for name in synth.SAMPLED)
    return (
        f"with {DRAWN}, {RANGES}, {CALENDAR} select {cols} from drawn "
        f"join calendar on ym = year_month {joins}"
    )


def _targets() -> str:
    weights = ", ".join(f"({m}, cast({w} as double))" for m, w in synth.MONTH_WEIGHTS.items() if m > 1)
    return (
        f"with gap as (select {PLAN_TARGET} - count(*) as gap from orders), "
        f"w(month, weight) as (values {weights}), "
        "t as (select month, weight, cast(floor(cast(gap as double) / 11.0 * weight) as bigint) "
        "as target_rows from gap, w where gap > 0) "
        "select *, (target_rows + 49999) // 50000 as batches from t"
    )


_PLAN = (
    f"months as (select yyyymm, n // 12 + case when yyyymm - 202501 < n % 12 then 1 else 0 end as month_rows "
    "from range(202501, 202513) t(yyyymm), (select count(*) as n from orders)), "
    f"plan as (select concat(cast(yyyymm // 100 as varchar), '-', "
    "lpad(cast(yyyymm % 100 as varchar), 2, '0')) as year_month, shard, "
    f"least({PLAN_SHARD}, month_rows - shard * {PLAN_SHARD}) as n_rows, "
    f"(({PLAN_SEED} * 31 + yyyymm // 100) * 13 + yyyymm % 100) * 1000 + shard as seed "
    f"from months, range(0, 1000000) s(shard) where shard * {PLAN_SHARD} < month_rows)"
)
_FILE = (
    "concat('year_month=', year_month, '/data-', case when shard < 10 then '0' else '' end, "
    "cast(shard as varchar), '.parquet')"
)


# ---- all ------------------------------------------------------------------------------


def oracle_sql() -> dict[str, str]:
    month = "strftime(data_vacina, '%Y-%m')"
    yyyymm = "year(data_vacina) * 100 + month(data_vacina)"
    stored_wrong = "case when l_orderkey % 50 = 0 then '2025-03' else " + month + " end"
    all_columns = ", ".join(CANONICAL)
    fact = f"with {DOSES} select "
    return {
        "rollup_a": _rollup(A),
        "rollup_b": _rollup(B),
        "rollup_exact": _rollup(A),
        "rollup_merge": _rollup(A),
        "rollup_refresh": _rollup(B, f", {month} as year_month"),
        "rollup_refresh_a": _rollup(A, f", {month} as year_month"),
        "rollup_refresh_months": _rollup(A, f", {month} as year_month"),
        "rollup_refresh_live": _rollup(A, f", {month} as year_month"),
        "stream_rollup_a": _rollup(A),
        "export_roundtrip": _rollup(A),
        "kpi_overview": _grouped(
            {},
            [*_TOTALS, "average_age", *A.counters[3:]],
            "sigla_uf_paciente in ('U0', 'U1')",
        ),
        "vaccine_performance": _grouped(
            {"sigla_vacina": "sigla_vacina"}, _TOTALS + _KINDS + ["average_age"]
        ),
        "trends": _trends(),
        "state_vaccine_cube": _cube(),
        "demographics": _grouped(
            {k: k for k in ("tipo_sexo_paciente", "nome_raca_cor_paciente")},
            _TOTALS + _KINDS + ["completed_series"],
            "numero_idade_paciente between 18 and 64",
            B,
        ),
        "last_30_days": _grouped(
            {"sigla_uf_paciente": "sigla_uf_paciente"},
            _TOTALS + _KINDS,
            f"data_vacina > {_ENDS} - 30",
        ),
        "daily_stats": _grouped(
            {"data_vacina": "data_vacina"},
            _TOTALS
            + ["female_count", "male_count"]
            + ["children", "young_adults", "adults", "middle_aged", "seniors"],
        ),
        "name_token": "select p_partkey, p_name from part where "
        "list_contains(regexp_split_to_array(lower(p_name), '[^\\p{L}\\p{N}]+'), 'ring')",
        "clean_strings": f"with {RAW} select event_id, "
        + _select({f.name: (_strip if f.nullable else _required)(f.name) for f in TEXT_FIELDS})
        + " from raw",
        "parse_dates": f"with {RAW} select event_id, "
        + _select({f.name: _date(f.name) for f in FIELDS if f.kind == "date"})
        + " from raw",
        "clean_ints": f"with {RAW} select event_id, {_int('numero_idade_paciente')} as age from raw",
        "dose_try_cast": f"with {RAW} select event_id, {_small_int('codigo_dose_vacina')} "
        f"as as_byte, {_digits('codigo_dose_vacina')} as as_digits from raw",
        "clean_records": _CLEAN_FACT,
        "stream_ingest": _CLEAN_FACT,
        "stream_reset": _CLEAN_FACT,
        "stream_then_compact": _CLEAN_FACT,
        "stream_then_load": _BOTH.replace(
            "loaded as ()", f"loaded as ({_exchange(f"{month} in ('2025-01', '2025-03')")})"
        ),
        "stream_repeated_pages": _CLEAN_FACT,
        "stream_resume": _CLEAN_FACT,
        "stream_repeated_rollup": f"with {_CLEAN}, doses as (select {_AS_FACT} from clean where {_problem()} is null) "
        f"select {', '.join(A.keys)}, {month} as year_month, {_select(_measures(A))} from doses group by all",
        "ingest_status": "select * from (values (1, 'failed', cast(1 as bigint), true, true), "
        "(2, 'completed', cast(2 as bigint), cast(null as boolean), true)) "
        "t(attempt_no, status, batches, planned, timed)",
        "patients_exact": f"with p as (select {DOSE_EVENTS_ANSI['sigla_uf_paciente']} as sigla_uf_paciente, "
        f"{DOSE_EVENTS_ANSI['sigla_vacina']} as sigla_vacina, l_orderkey, l_linenumber, unnest([1, 2]) as k "
        "from lineitem) select sigla_uf_paciente, sigla_vacina, "
        "count(distinct concat_ws('-', l_orderkey, l_linenumber, k)) as unique_patients "
        "from p group by grouping sets ((sigla_uf_paciente, sigla_vacina), ())",
        "catalog_months": fact + f"distinct {month} as year_month from doses",
        "inventory": fact + f"distinct {month} as year_month, true as has_bytes from doses "
        "union all select '2024-01', true",
        "overwrite_month": fact + f"{all_columns} from doses where month(data_vacina) <> 2 or codigo_dose_vacina = 1",
        "date_first_copy": fact + "data_vacina, count(*) as n, min(codigo_documento) as first_document "
        "from doses group by all",
        "generate_to_table": f"select {_DEFAULTS} from ({_records()})",
        "quarantine_pages": f"with {_CLEAN}, judged as (select case when event_id // 100 = 2 "
        f"then '{MALFORMED}' else coalesce({_problem()}, 'accepted') end as outcome, "
        "case when event_id // 100 = 2 then -1 else event_id end as record from clean) "
        "select outcome, count(distinct record) as n from judged group by outcome",
        "quarantine": _QUARANTINE,
        "null_as_default": _exchange(),
        "load_month": _exchange(f"{month} in ('2025-01', '2025-03')"),
        "legacy_align": _legacy(),
        "lookup_name": _LOOKUP,
        "scan_pages": f"with {RAW} select event_id // 100 as page, "
        f"cast(event_id % 100 as integer) as pos, {all_columns} from raw",
        "page_completeness": f"with {_COMPLETENESS} select pages, total_records, end_page, "
        f"next_page, {_IS_COMPLETE} as complete from done, gap",
        "ingest_progress": f"with {_COMPLETENESS} select next_page, "
        "total_records as total_records_processed, "
        f"case when {_IS_COMPLETE} then 'completed' when pages = 0 then 'idle' "
        "else 'running' end as status, cast(null as varchar) as error_message from done, gap",
        "month_scan": fact + f"{month} as year_month, codigo_documento, data_vacina, sigla_vacina "
        f"from doses where {month} = '2025-02'",
        "discover_months": fact + f"distinct {month} as year_month from doses",
        "count_records": "select count(*) as n from lineitem",
        "count_by_month": fact + f"cast({yyyymm} as integer) as yyyymm, count(*) as n "
        "from doses group by all",
        "month_labels": "select distinct cast(year(o_orderdate) * 100 + month(o_orderdate) "
        "as integer) as yyyymm, cast(year(o_orderdate) as integer) as year, "
        "cast(month(o_orderdate) as integer) as month, strftime(o_orderdate, '%Y-%m') as label "
        "from orders",
        "partition_guard": f"with x as (select l_orderkey, {DOSE_EVENTS_ANSI['data_vacina']} "
        f"as data_vacina from lineitem) select {stored_wrong} as year_month, {month} as date_month, "
        f"count(*) as n from x where {stored_wrong} <> {month} group by all",
        "compact_month": fact + f"{month} as year_month, codigo_documento, data_vacina, "
        "numero_idade_paciente from doses",
        "freq_profile": f"with {PROFILE} select * from weights",
        "weighted_sample": f"with {DRAWN}, {RANGES} select o_orderkey, vac.item_1 as sigla_vacina, "
        "mun.item_1 as city_code, mun.item_4 as state_name, ida.item_1 as age, "
        f"{_choose('d_person', synth.SEX)} as sex from drawn "
        + " ".join(_pick(n[:3], n) for n in ("vacina", "municipio", "idade")),
        "weighted_sample_joined": f"with {DRAWN}, {RANGES} select o_orderkey, "
        "vac.item_1 as sigla_vacina, mun.item_1 as city_code, mun.item_4 as state_name from drawn "
        + " ".join(_pick(n[:3], n) for n in ("vacina", "municipio")),
        "weekday_dates": f"with {DRAWN}, {CALENDAR} select o_orderkey, {BIASED} as biased, "
        f"{RESAMPLED} as resampled from drawn join calendar on ym = year_month",
        "entry_dates": f"with {DRAWN} select o.o_orderkey, cast(o_orderdate as date) "
        "+ cast(d_person % 60 + 1 as integer) as entered "
        "from drawn join orders o on drawn.o_orderkey = o.o_orderkey",
        "synth_codes": f"with {DRAWN} select o_orderkey, {_document()} as document, "
        f"{_lot()} as lot, {_CNES} as cnes, {_CEP} as cep from drawn",
        "synth_derived": f"with {DRAWN}, {RANGES} select o_orderkey, "
        f"concat('{synth.NAME_PREFIX}', mun.item_2) as name, "
        f"concat('{synth.SHORT_NAME_PREFIX}', mun.item_2) as short_name from drawn "
        + _pick("mun", "municipio"),
        "synth_patients": f"with {DRAWN} select o_orderkey, {_POOLED} as pooled, "
        f"{_SINGLE} as single from drawn",
        "synth_events": _records(),
        "shard_plan": f"with {_PLAN} select year_month, shard, n_rows, seed, {_FILE} as file from plan",
        "shard_totals": f"with {_PLAN} select count(*) as shards, "
        "cast(coalesce(sum(n_rows), 0) as bigint) as rows from plan",
        "seasonal_targets": _targets(),
    }
