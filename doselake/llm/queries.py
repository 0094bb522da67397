"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doselake.llm import (
    bpe,
    collocations,
    conversations,
    decontaminate,
    language_id,
    license_scan,
    minhash,
    piece_bpe,
    quality,
    sharding,
    spotsigs,
    suffix_dedup,
    url_filter,
)
from doselake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Passages of more than 50 words are repeats, however few bytes they have.
PASSAGE = 51
#: The rules of the url query.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_url_filter(spark, sf_dir):
    """Host, path, rule and verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL["op4_url_filter"] = r"""
with parts as (
  select page_id, case when strpos(url, '://') > 0
    then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), urls as (
  select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts
), rules(rule_host, rule_path, verdict) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits as (
  select page_id, rule_host || rule_path as rule, verdict,
    row_number() over (partition by page_id
      order by length(rule_host) + length(rule_path) desc, length(rule_host) desc) as place
  from urls, rules
  where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from urls u left join (select * from fits where place = 1) f on u.page_id = f.page_id
"""


@query
def op6_spotsigs(spark, sf_dir):
    """Fingerprints of every document and of its edited text, with their likeness."""
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


@query
def op7_license_scan(spark, sf_dir):
    """Phrase places, labels and best containment of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan_licenses(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query
def op2_sharding(spark, sf_dir):
    """Documents in 16 shards of near-equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign_shards(docs)


def tokenizer_file(name: str) -> str:
    return public_tokenizers.path(name)


@query
def op1_language_id(spark, sf_dir):
    """Predicted language of every document, learned from two thirds of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    pieces = language_id.load_pieces(tokenizer_file("piece_bpe_32k.model"))
    model = language_id.train(docs.where(~F.col("held_out")), pieces)
    judged = language_id.predict(docs.select("doc_id", "held_out", "text"), model)
    return judged.select("doc_id", "held_out", "lang_pred", "score")


@query
def op9_bpe(spark, sf_dir):
    """Digests of the token ids and of the decoded text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = bpe.encode(docs, tokenizer_file("word_bpe_49k.json"))
    return made.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query
def op8_decontamination(spark, sf_dir):
    """Benchmark passages in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return made.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op10_near_dedup(spark, sf_dir):
    """Class of near duplicates of every document, and how many pairs joined it to that."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs).select("doc_id", "class_id", "n_pairs", "is_first")


@query
def op3_suffix_dedup(spark, sf_dir):
    """Bytes removed from every document because 400 of them stand elsewhere too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = suffix_dedup.remove_repeats(docs, also_words=PASSAGE)
    return made.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
        "n_passage_bytes",
    )


@query
def op5_quality(spark, sf_dir):
    """Perplexity, threshold of its language and decision for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality.judge_quality(docs, trusted).select("doc_id", "lang", "perplexity", "threshold", "keep")


@query
def op13_sentencepiece(spark, sf_dir):
    """Digests of the piece ids and of the decoded text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = piece_bpe.encode(docs, tokenizer_file("piece_bpe_32k.model"))
    return made.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op12_collocations(spark, sf_dir):
    """The 2000 most telling phrases of every language."""
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    return collocations.collocations(docs)


ORACLE_SQL["op12_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, doc_id, text, unnest(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) as piece
  from documents where text is not null
), split as (
  select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') as words from pieces
), grams as (
  select lang, m, array_to_string(words[i:i + m - 1], ' ') as phrase
  from (select lang, words, m, unnest(range(1, len(words) - m + 2)) as i
        from split, (values (1), (2), (3), (4), (5)) as sizes(m))
), f as (
  select lang, m, phrase, count(*) as f from grams group by all
), sizes as (
  select lang, sum(f) as n from f where m = 1 group by lang
), frequent as (
  select * from f where f >= 100
), candidates as (
  select lang, m, phrase, f as a, string_split(phrase, ' ') as words from frequent where m > 1
), inside as (
  select distinct p.lang, p.phrase
  from (select lang, a, array_to_string(words[i:j], ' ') as phrase
        from (select *, unnest(range(i + 1, m + 1)) as j
              from (select *, unnest(range(1, m)) as i from candidates))
        where j - i + 1 < m) as p
  join candidates c on c.lang = p.lang and c.phrase = p.phrase and 100 * p.a >= 100 * c.a
), cuts as (
  select c.lang, c.phrase, c.a, c.k, l.f as l, r.f as r, s.n,
    (1000::hugeint * c.a * s.n::hugeint) // (l.f::hugeint * r.f) as score
  from (select *, unnest(range(1, m)) as k from candidates) c
  join frequent l on l.lang = c.lang and l.phrase = array_to_string(c.words[1:c.k], ' ')
  join frequent r on r.lang = c.lang and r.phrase = array_to_string(c.words[c.k + 1:], ' ')
  join sizes s on s.lang = c.lang
  where not exists (select 1 from inside i where i.lang = c.lang and i.phrase = c.phrase)
), best as (
  select *, row_number() over (partition by lang, phrase order by score, k) as place from cuts
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from best where place = 1
)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n,
  score::bigint as score
from ranked where rank <= 2000
"""


def damaged(rows):
    """Conversations with damage that conv_id and turn decide; ``alive`` is false for rows that are dropped."""
    space = F.lit(" ")
    name = F.concat_ws(
        ":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    )
    fate = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), space) for c in ("role", "text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fate != 0).alias("alive"),
        F.explode(F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


@query
def op11_conversation_repair(spark, sf_dir):
    """Faults, cheapest edits and digest of the repaired text of every damaged conversation."""
    rows = damaged(table(spark, sf_dir, "conversations"))
    made = conversations.repair(rows, alive=F.col("alive"))
    return made.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


ORACLE_SQL["op11_conversation_repair"] = r"""
with recursive crc_table as (
  select list(v order by i) as t
  from (select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from (select unnest(range(0, 256)) as i))
), marked as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce([4294967295] || list_transform(range(1, length(name) + 1), lambda k: ascii(name[k])::bigint),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 as fate
  from (select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
    crc_table
), damaged as (
  select conv_id, turn, case fate when 4 then 'user' else role end as role,
    case fate when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case fate when 0 then 0 when 3 then 2 else 1 end)) as copy
  from marked
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged
), judged as (
  select *, role[1] as initial, lag(role[1]) over (partition by conv_id order by i) || role[1] as pair,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
      when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault
  from placed
), inserts(q, k, q2, added) as (
  values (0, 0, 0, []::varchar[]), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']),
    (1, 0, 1, []), (1, 1, 2, ['user:']), (1, 2, 3, ['user:', 'assistant:']),
    (2, 0, 2, []), (2, 1, 3, ['assistant:']), (2, 2, 2, ['assistant:', 'user:']),
    (3, 0, 3, []), (3, 1, 2, ['user:']), (3, 2, 3, ['user:', 'assistant:'])
), edits(edit, initial, q, q2, cost) as (
  values ('D', null, 0, 0, 2), ('D', null, 1, 1, 2), ('D', null, 2, 2, 2), ('D', null, 3, 3, 2),
    ('K', 's', 0, 1, 0), ('K', 'u', 0, 2, 0), ('K', 'u', 1, 2, 0), ('K', 'u', 3, 2, 0), ('K', 'a', 2, 3, 0),
    ('R', null, 0, 2, 1), ('R', null, 1, 2, 1), ('R', null, 3, 2, 1), ('R', null, 2, 3, 1)
), paths as (
  select distinct conv_id, 0::bigint as i, 0 as q, {'cost': 0::bigint, 'audit': '', 'lines': []::varchar[]} as best
  from conversations
  union all
  select p.conv_id, p.i + 1, e.q2, min({
      'cost': p.best.cost + 5 * s.k + e.cost + case when e.edit <> 'D' and r.fault = 'truncated' then 5 else 0 end,
      'audit': p.best.audit || repeat('I', s.k) || e.edit,
      'lines': p.best.lines || s.added || case e.edit when 'D' then [] when 'K' then [r.role || ':' || r.text]
        else [case e.q2 when 2 then 'user:' else 'assistant:' end || r.text] end})
  from paths p
  join judged r on r.conv_id is not distinct from p.conv_id and r.i = p.i + 1
  join inserts s on s.q = p.q
  join edits e on e.q = s.q2 and (e.initial is null or e.initial = r.initial)
    and (e.edit = 'D' or r.fault not in ('blank', 'duplicate'))
  group by p.conv_id, p.i + 1, e.q2
), sizes as (
  select conv_id, count(*) as n, max(turn) - min(turn) + 1 - count(distinct turn) as gaps,
    count_if(fault = 'blank') as blank, count_if(fault = 'duplicate') as duplicate,
    count_if(fault = 'truncated') as truncated, count_if(pair not in ('su', 'ua', 'au')) as illegal
  from judged group by conv_id
), best as (
  select p.conv_id, min({'cost': p.best.cost + 5 * s.k, 'audit': p.best.audit || repeat('I', s.k),
    'lines': p.best.lines || s.added}) as best
  from paths p left join sizes z on z.conv_id is not distinct from p.conv_id
  join inserts s on s.q = p.q and s.q2 in (0, 3)
  where p.i = coalesce(z.n, 0)
  group by p.conv_id
)
select b.conv_id, coalesce(z.gaps, 0)::bigint as gaps, coalesce(z.blank, 0)::bigint as blank,
  coalesce(z.duplicate, 0)::bigint as duplicate, coalesce(z.truncated, 0)::bigint as truncated,
  coalesce(z.illegal, 0)::bigint as illegal, b.best.cost::bigint as cost, b.best.audit as audit,
  sha256(array_to_string(b.best.lines, chr(10))) as repaired_sha256
from best b left join sizes z on z.conv_id is not distinct from b.conv_id
"""
