"""No column of the user's clashes with names the operators use inside."""

from __future__ import annotations

import brute
import public_tokenizers
import pytest

from doselake.llm import (
    bpe,
    decontaminate,
    language_id,
    license_scan,
    minhash,
    piece_bpe,
    quality,
    sharding,
    suffix_dedup,
    url_filter,
)


def languages(docs):
    model = language_id.train(docs, ["▁the", "▁q", "u", "i", "c", "k"])
    return language_id.predict(docs, model)


def judged(docs):
    spark = docs.sparkSession
    return quality.judge_quality(docs, spark.createDataFrame([(6,), (7,)], "doc_id long"))


def clean(docs):
    items = docs.sparkSession.createDataFrame([("i", "quick brown fox jumps over the lazy dog and runs")], "item_id string, text string")
    return decontaminate.decontaminate(docs, items)


def urls(docs):
    rules = docs.sparkSession.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    return url_filter.judge_urls(docs, rules, url="text")


OPERATORS = {
    "language_id": languages,
    "sharding": sharding.assign_shards,
    "suffix_dedup": suffix_dedup.remove_repeats,
    "url_filter": urls,
    "quality": judged,
    "license_scan": license_scan.scan_licenses,
    "decontaminate": clean,
    "bpe": lambda docs: bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")),
    "piece_bpe": lambda docs: piece_bpe.encode(docs, public_tokenizers.path("piece_bpe_32k.model")),
    "minhash": minhash.keep_first,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_names_the_operator_uses_itself(awkward, name):
    plain, odd = OPERATORS[name](awkward), OPERATORS[name](brute.own_names(awkward))
    extra = brute.own_names(awkward).columns[len(awkward.columns) :]
    assert [c for c in odd.columns if c not in extra] == plain.columns
    rows = odd.collect()
    assert all([r[c] for c in extra] == list(range(len(extra))) for r in rows)

    def key(row):
        return sorted((c, str(row[c])) for c in plain.columns)

    assert sorted(map(key, rows)) == sorted(map(key, plain.collect()))
