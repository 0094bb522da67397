"""Pieces against the sentencepiece library, collocations against counting everything."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from doselake.llm import collocations, merging, piece_bpe, queries

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def pieces():
    return piece_bpe.Pieces.load(PIECES)


def same_as_library(library, pieces, texts):
    ids, lengths = piece_bpe.Encoder(pieces).encode(texts)
    ends = np.cumsum([0, *lengths])
    decoded = pieces.decode(ids, lengths)
    for k, text in enumerate(texts):
        want = library.encode(text, add_bos=True, add_eos=True)
        assert ids[ends[k] : ends[k + 1]].tolist() == want, text[:80]
        assert decoded[k] == library.decode(want)


def test_odd_texts(library, pieces):
    odd = ["", " ", "  ", "\n", "\n\n a", "a \n b", "a\n", "▁", "▁▁a ▁b", " a", "a  b   c ", "\x00\x01 ", "aaaa" * 9]
    odd += ["<s> </s> <0x0A> <unk>", "　 Ａ é", "    indent\n        more\n\n\n", "🙂😀 a", "x" * 5000, "ab" * 3000]
    same_as_library(library, pieces, odd + [t or "" for _, t, *_ in brute.awkward()])


@pytest.mark.parametrize("signs", ["abcdehilnorst ▁\n", "aeinst", " \n\tab.", "0123456789 .,", "éèàüößñ ", "你好世界的是在", "=-_/*#\\ {};"])
def test_random_signs(library, pieces, signs):
    rng = random.Random(signs)
    same_as_library(library, pieces, ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(300)])


def test_pieces_side_by_side(library, pieces):
    rng = random.Random(3)
    names = [library.id_to_piece(rng.randrange(259, 32000)) for _ in range(8000)]
    same_as_library(library, pieces, ["".join(rng.choices(names, k=12)).replace("▁", " ") for _ in range(500)])


def test_decoding_any_ids(library, pieces):
    rng = random.Random(4)
    some = [3, 19, 198, 172, 231, 192, 163, 1000, 29871, 1, 2, 35, 345]
    for _ in range(500):
        ids = rng.choices(some, k=rng.randint(1, 12))
        assert pieces.decode(np.array(ids), np.array([len(ids)])) == [library.decode(ids)]


def test_a_merge_that_ranks_before_the_next():
    """Where a merge makes a better pair, only the leftmost of equal pairs is merged at once."""
    ranks = {"ab": 5, "abc": 1, "ca": 9}
    names = ["a", "b", "c", *ranks]
    pairs = {(0 << 32) + 1: 3, (3 << 32) + 2: 4, (2 << 32) + 0: 5}
    touching = sorted({(ord(x) << 32) + ord(y) for x, y in ("ab", "bc", "ca")})
    merges = merging.Merges.of({k: (i, ranks[names[i]]) for k, i in pairs.items()})
    made = piece_bpe.Pieces(
        np.array([97, 98, 99]), np.array([0, 1, 2]), merges, np.array(touching), np.empty(0, np.int64),
        6, np.empty(0, np.uint8), np.empty(0, np.int64), np.zeros(6), np.zeros(256), 0, 0, True, True,
    )

    def one_by_one(word):
        parts = list(word)
        while True:
            best = min(((ranks.get(x + y, 99), i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False))), default=(99, 0))
            if best[0] == 99:
                return parts
            parts[best[1] : best[1] + 2] = ["".join(parts[best[1] : best[1] + 2])]

    rng = random.Random(6)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 12))) for _ in range(500)]
    ids, sizes = made.merge(words)
    got = iter(ids.tolist())
    assert [[names[next(got)] for _ in range(n)] for n in sizes.tolist()] == [one_by_one(w) for w in words]


def test_rows_and_columns(spark, awkward, library):
    odd = brute.odd_columns(awkward).selectExpr("*", "'x' as `Ids`", "1 as `a.b`", "2 as decoded")
    rows = piece_bpe.encode(odd, PIECES).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        want = library.encode(r.text or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(want) and np.frombuffer(bytes(r.ids), "<u4").tolist() == want
        assert r.decoded == library.decode(want) and r.key == 0 and r["a.b"] == 1
    assert piece_bpe.encode(brute.empty(spark), PIECES).collect() == []


def test_piece_query(spark, sf_dir, documents, library):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = queries.op13_sentencepiece(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == texts.keys()
    for r in rows:
        want = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == brute.sha(library.decode(want))


# ---- collocations -----------------------------------------------------------------


def plain_collocations(rows, longest, least, top, percent):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = set()
    for (lang, words), a in candidates.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                part = (lang, words[i:j])
                if j - i < len(words) and 100 * a >= percent * f[part]:
                    inside.add(part)
    out = {}
    for (lang, words), a in candidates.items():
        if (lang, words) not in inside:
            cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            row = (score, a, " ".join(words), f[lang, words[:k]], f[lang, words[k:]])
            out.setdefault(lang, []).append(row)
    result = []
    for lang, found in out.items():
        found.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        result += [(lang, i + 1, p, a, l, r, n[lang], s) for i, (s, a, p, l, r) in enumerate(found[:top])]
    return sorted(result, key=str)


def some_texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "the", "Of", "é", "你", "x\x1cy", "\x00", "C", "d"]
    joins = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "! "]
    return [
        (rng.choice(["en", "en", "de", None, ""]), rng.choice([None, "", "   "]) if rng.random() < 0.1 else "".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.randint(1, 40))))
        for _ in range(n)
    ]


@pytest.mark.parametrize(("longest", "least", "top", "percent"), [(5, 4, 2000, 100), (5, 2, 7, 80), (3, 3, 50, 100), (2, 1, None, 100)])
def test_collocations(spark, longest, least, top, percent):
    rows = some_texts(longest, 150) + [("en", "over and over " * 2000)]
    small = collocations.Limits(entries=50, words=8, batch=300, word_bits=15, pair_bits=15)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, text string, n int, phrase int")
    got = collocations.collocations(docs, longest, least, top, percent, limits=small).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_collocations(rows, longest, least, top or 10**9, percent)


def test_counts_above_a_byte(spark):
    rows = [("en", "a b c " * 400)] * 2 + [("de", "a b. " * 299)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(docs, 3, 300, 10).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_collocations(rows, 3, 300, 10, 100)


def test_products_beyond_64_bits(spark):
    """a * n / (l * r) is exact where the products are not numbers of 64 bits."""
    row = spark.sql(
        "select cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)) as over, "
        "cast(l as decimal(17,0)) * cast(r as decimal(17,0)) as under from "
        "values (99999999999L, 99999999999999L, 100000000003L, 100000000019L) as t(a, n, l, r)"
    ).selectExpr("over div under as score").first()
    assert row.score == 1000 * 99999999999 * 99999999999999 // (100000000003 * 100000000019)


def test_no_texts(spark):
    docs = spark.createDataFrame([(None, None), ("en", "")], "lang string, text string")
    assert collocations.collocations(docs).collect() == []
    assert collocations.collocations(docs.limit(0)).collect() == []
