"""Operators that judge each text by itself, against plain versions."""

from __future__ import annotations

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from doselake.llm import bpe, language_id, license_scan, quality, queries, spotsigs, url_filter

BPE_FILE = public_tokenizers.path("word_bpe_49k.json")


# ---- language ---------------------------------------------------------------------


def plain_forward(word, pieces, probs):
    alpha = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        alpha[end] = alpha[end - 1] * language_id.OUTSIDE
        for start in range(end):
            p = probs.get(word[start:end])
            if p:
                alpha[end] += alpha[start] * p
    return alpha[-1]


def test_forward_sums_all_segmentations():
    pieces = ["a", "ab", "b", "ba", "aba", "▁", "▁a"]
    probs = np.random.default_rng(1).dirichlet(np.ones(len(pieces)), 2)
    words = ["▁abab", "▁a", "▁bbb", "▁abcab", "b" * 40]
    got = np.exp(language_id.Lattice(pieces).log_probs(words, probs))
    for k in range(2):
        want = [plain_forward(w, pieces, dict(zip(pieces, probs[k], strict=True))) for w in words]
        assert np.allclose(got[:, k], want, rtol=1e-9)


def plain_log_forward(word, probs):
    alpha = [0.0] + [-np.inf] * len(word)
    for end in range(1, len(word) + 1):
        ways = [alpha[end - 1] + np.log(language_id.OUTSIDE)]
        ways += [alpha[s] + np.log(probs[word[s:end]]) for s in range(max(0, end - 12), end) if word[s:end] in probs]
        alpha[end] = np.logaddexp.reduce(ways)
    return alpha[-1]


def test_long_words_and_letters_outside_keep_what_is_known():
    pieces = ["▁the", "▁und", "th", "e", "und", "a"]
    probs = np.random.default_rng(2).dirichlet(np.ones(len(pieces)), 2)
    han, ethiopic = "\u4e00" * 36, "\u1200\u1208" * 300
    words = ["▁the" + han, "▁und" + han, "▁the" + ethiopic, "▁" + "a" * 500, "▁" + "athe" * 40 + han, "▁the"]
    got = language_id.Lattice(pieces).log_probs(words, probs)
    for k in range(2):
        want = [plain_log_forward(w, dict(zip(pieces, probs[k], strict=True))) for w in words]
        assert np.allclose(got[:, k], want, rtol=1e-9)
    # the known pieces decide, however much follows
    assert got[0, 0] - got[0, 1] == pytest.approx(got[5, 0] - got[5, 1])
    counts = np.array([2.0, 1.0, 1.0, 1.0, 1.0, 1.0])
    uses = language_id.Lattice(pieces).expected(words, counts, probs[:1], len(pieces))
    # each long word begins with its piece for certain: th, e and letters outside are far less likely
    assert uses[0] == pytest.approx(2 + 1 + 1, rel=1e-3) and uses[1] == pytest.approx(1, rel=1e-3)


def test_expected_counts_add_up():
    pieces = ["▁a", "a", "b", "ab", "▁ab"]
    probs = np.full((1, 5), 0.2)
    got = language_id.Lattice(pieces).expected(["▁ab"], np.array([3.0]), probs, 5)
    # ▁ab whole: 0.2, ▁a + b: 0.04, a letter outside the vocabulary adds next to nothing
    assert got[4] == pytest.approx(3 * 0.2 / 0.24, rel=1e-6)
    assert got[0] == pytest.approx(3 * 0.04 / 0.24, rel=1e-6) == got[2]


def test_held_out_accuracy(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in queries.op1_language_id(spark, sf_dir).collect()}
    truth = {r.doc_id: r.lang for r in documents.collect()}
    assert rows.keys() == truth.keys()
    held = [r for r in rows.values() if r.held_out]
    assert held
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_language_of_awkward_rows(spark, awkward):
    pieces = language_id.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = language_id.train(awkward, pieces)
    assert model.langs == ["de", "en"]
    got = language_id.predict(brute.odd_columns(awkward), model).collect()
    assert len(got) == awkward.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
    nothing = language_id.train(brute.empty(spark), pieces)
    assert {r.lang_pred for r in language_id.predict(awkward, nothing).collect()} == {"und"}
    assert language_id.predict(brute.empty(spark), model).count() == 0


def test_language_scores_do_not_depend_on_what_is_remembered(spark, documents, monkeypatch):
    pieces = language_id.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = language_id.train(documents, pieces)
    texts = [r.text for r in documents.limit(60).collect()]
    want = language_id.Scorer(model).score(texts)
    monkeypatch.setattr(language_id, "REMEMBERED", 3000)
    scorer = language_id.Scorer(model)
    got = [x for k in range(0, 60, 4) for x in scorer.score(texts[k : k + 4])]
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want])
    # a text is sent to the task once
    plan = language_id.predict(documents, model)._jdf.queryExecution().executedPlan().toString()
    assert "_text" not in plan


def test_a_word_is_passed_over_once_whatever_stands_beside_it(monkeypatch):
    model = language_id.LanguageModel(["de", "en"], ["a", "b"], np.full((2, 2), 0.5))
    scorer, passed = language_id.Scorer(model), []
    log_probs = scorer.lattice.log_probs
    monkeypatch.setattr(scorer.lattice, "log_probs", lambda words, probs: passed.extend(words) or log_probs(words, probs))
    first = scorer.score(["ab ba", None, "12"])
    assert first[1:] == [("und", 0.0)] * 2
    assert scorer.score(['"Ab", (BA)!'])[0] == first[0]
    assert sorted(passed) == ["▁ab", "▁ba"]


# ---- urls -------------------------------------------------------------------------


def plain_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:end].translate(brute.UPPER), rest[end:]
        cut = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
        path = tail[:cut]
    fits = [
        r for r in rules
        if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])
    ]
    best = max(fits, key=url_filter.rank, default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http:///p", "HTTP://EXAMPLE.NET/en/x?q#f", "http://example.net/EN/",
    "http://a.b.example.com/de/x", "http://xexample.com/de/", "http://org/fr/", "http://a.org/fr", "a://b://c/d",
    "http://example.net", "http://example.net?x/en/", "http://é.net/ü", "http://net:80/", "http://a..net/",
    "http://" + "s." * 3000 + "net/" + "p/" * 3000,
]


def test_urls_against_plain_version(spark, monkeypatch):
    rules = queries.URL_RULES + [("b.example.com", "/", "allow"), ("é.net", "/ü", "allow"), ("é.net", "/ü", "block")]
    table = spark.createDataFrame([(k, u, 1) for k, u in enumerate(URLS * 2)], "page_id int, url string, verdict int")
    listed = spark.createDataFrame(rules + [(None, "/", "block")], "host string, path string, verdict string")
    want = [plain_verdict(u, rules) for u in URLS * 2]
    for most in (url_filter.ARRAY_RULES, 2):  # one array, several arrays
        monkeypatch.setattr(url_filter.digest_arrays, "__defaults__", (most,))
        got = url_filter.judge_urls(table, listed).orderBy("page_id").collect()
        assert [(r.host, r.path, r.rule, r.verdict) for r in got] == want
    assert url_filter.judge_urls(table.limit(0), listed).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(table, listed.limit(0)).collect()} == {"allow"}


def test_colliding_digests_change_nothing(monkeypatch):
    monkeypatch.setattr(url_filter, "digest", lambda key: 7)
    store = url_filter.DigestArray.build(queries.URL_RULES).open()
    got = store.longest(["x.example.net", "q"], ["/en/1", "/"])
    assert got == [("example.net", "/en/", "allow"), None]


# ---- quality ----------------------------------------------------------------------


def plain_kneser_ney(texts, order):
    """Interpolated modified Kneser-Ney over bytes, by dictionaries."""
    from collections import Counter

    levels = {order: Counter()}
    for t in texts:
        raw = bytes(order - 1) + t.encode()
        levels[order].update(raw[i : i + order] for i in range(len(raw) - order + 1))
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    found = {}
    for k, grams in levels.items():
        n = [sum(c == j for c in grams.values()) for j in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else None
        ds = []
        for j, plain in enumerate(quality.PLAIN):
            d = (j + 1) - (j + 2) * y * n[j + 1] / n[j] if y is not None and n[j] else None
            ds.append(d if d is not None and 0 < d < j + 1 else plain)
        found[k] = grams, ds

    def prob(gram):
        if not gram:
            return 1 / 256
        grams, ds = found[len(gram)]
        heads = {g: c for g, c in grams.items() if g[:-1] == gram[:-1]}
        lower = prob(gram[1:])
        if not heads:
            return lower
        total = sum(heads.values())
        off = lambda c: ds[min(c, 3) - 1]
        own = heads[gram] - off(heads[gram]) if gram in heads else 0
        return own / total + sum(map(off, heads.values())) / total * lower

    return prob


def test_perplexity_against_plain_version(spark):
    trusted = ["abracadabra", "abra cad", "brr"]
    others = ["abba", "zebra", "ab", "é"]
    rows = [(k, t, "en") for k, t in enumerate(trusted + others)]
    docs = spark.createDataFrame(rows + [(90, None, "en"), (91, "", "en"), (92, "abc", "fr"), (93, "abc", None)],
                                 "doc_id long, text string, lang string")
    ids = spark.createDataFrame([(0,), (1,), (2,), (2,), (91,)], "doc_id long")
    prob = plain_kneser_ney(trusted, 3)
    for most in (10**6, 0):  # looked up, joined
        got = {r.doc_id: r for r in quality.judge_quality(docs, ids, order=3, model_rows=most).collect()}
        assert len(got) == docs.count()
        for k, t, _ in rows:
            raw = bytes(2) + t.encode()
            logs = [np.log(prob(raw[i : i + 3])) for i in range(len(raw) - 2)]
            assert got[k].perplexity == pytest.approx(np.exp(-np.mean(logs)), rel=1e-9)
            assert got[k].keep == (got[k].perplexity <= got[k].threshold)
        assert [got[k].perplexity for k in (90, 91, 92, 93)] == [None] * 4
        assert [got[k].keep for k in (90, 91, 92, 93)] == [False, False, True, True]


def test_quality_of_awkward_rows(spark, awkward):
    ids = spark.createDataFrame([(6,), (7,)], "doc_id long")
    got = quality.judge_quality(brute.odd_columns(awkward), ids)
    assert got.count() == awkward.count()
    assert quality.judge_quality(brute.empty(spark), ids).count() == 0
    assert quality.judge_quality(awkward, ids.limit(0)).where("keep").count() == awkward.count()


def test_clean_documents_stay(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = queries.op5_quality(spark, sf_dir).join(labels, "doc_id").collect()
    clean = [r.keep for r in rows if r.quality == 1]
    junk = [r.keep for r in rows if r.quality == 0]
    assert sum(clean) / len(clean) > 0.95
    assert sum(junk) / len(junk) < 0.3


# ---- fingerprints -----------------------------------------------------------------


def plain_signatures(text):
    ws = [w.encode() for w in brute.words(text)]
    out = set()
    for i in range(-1, len(ws)):
        if i < 0 or ws[i] in spotsigs.ANCHORS:
            chain = [w for w in ws[i + 1 :] if w not in spotsigs.ANCHORS][: spotsigs.CHAIN]
            out.add((ws[i] if i >= 0 else None, *chain))
    return out if ws else set()


def test_signatures_against_plain_version():
    rng = random.Random(3)
    pool = ["the", "of", "der", "cat", "dog", "sun", "x", "é"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(60)]
    for a in texts:
        assert len(spotsigs.signatures(a)) == len(plain_signatures(a))
    for a, b in zip(texts, texts[1:], strict=False):
        x, y = plain_signatures(a), plain_signatures(b)
        want = len(x & y) / len(x | y) if x | y else 1.0
        assert spotsigs.jaccard(spotsigs.signatures(a), spotsigs.signatures(b)) == pytest.approx(want)
        back = spotsigs.decoded(spotsigs.encoded(spotsigs.signatures(a)))
        assert (back == spotsigs.signatures(a)).all()


def test_length_parts_never_part_alike_sets():
    for n in range(1, 200):
        for m in range(n, 200):
            if n / m >= 0.8:
                assert abs(spotsigs.length_part(n, 0.8) - spotsigs.length_part(m, 0.8)) <= 1


def plain_fingerprints(rows):
    low = -(2**63)
    order = sorted(((r[0] if r[0] is not None else low, r[1] or "", r[0]) for r in rows))
    out = []
    for k, (_, text, doc) in enumerate(order):
        other = order[k - 1][1]
        cut = len(text) // 3
        edit = text[: len(text) - cut] + other[:cut]
        a, b, c = map(spotsigs.signatures, (text, edit, other))
        out.append((doc, len(text), brute.sha(edit), spotsigs.encoded(a), spotsigs.encoded(b),
                    spotsigs.jaccard(a, b), spotsigs.jaccard(a, c)))
    return sorted(out, key=str)


def test_fingerprints_against_plain_version(spark, awkward, documents):
    for docs in (awkward, documents, brute.odd_columns(awkward), documents.limit(1), brute.empty(spark)):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = sorted((tuple(r) for r in spotsigs.fingerprints(docs).collect()), key=str)
        assert got == plain_fingerprints(rows)


# ---- licenses ---------------------------------------------------------------------


def plain_scan(text, templates=None):
    ws = brute.words(text)
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        here = [i for i in range(len(ws)) if ws[i : i + len(p)] == p]
        places += here
        labels |= {label} if here else set()
    base, best = set(labels), 1.0 if places else 0.0
    for label, template in (templates or license_scan.TEMPLATES).items():
        t, size = set(brute.words(template)), max(license_scan.BLOCK, 2 * len(brute.words(template)))
        for at in range(max(1, len(ws) - size + 1)):
            if at < len(ws) - size and ws[at] not in t:
                continue  # the next block holds as much
            share = len(t.intersection(ws[at : at + size])) / len(t)
            if share >= license_scan.THRESHOLD:
                labels.add(label)
                best = max(best, share)
    return (len(ws), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), pytest.approx(best))


def test_licenses_against_plain_version(spark, awkward):
    filler = "some words of filler that say nothing at all about it "
    texts = [r.text for r in awkward.collect()] + [
        "CC BY cc by. CC-BY", "All rights reserved", "all rights all rights reserved",
        filler * 9 + license_scan.TEMPLATES["mit-text"].upper() + filler * 9,
        filler * 3 + "Released under MIT license. " + filler * 20,
        "licensed under the apache version 2.0", "GNU General, Public-License",
    ]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    got = license_scan.scan_licenses(brute.odd_columns(docs)).orderBy("doc_id").collect()
    for r, text in zip(got, texts, strict=True):
        want = plain_scan(text)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == want
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0


def test_templates_wherever_their_words_stand(spark):
    """Words of a template spread over a block, at every offset; a whole license of hundreds of words."""
    notice = license_scan.TEMPLATES["mit-text"].split()
    texts = []
    for offset in range(0, 70, 3):
        spread = [w for k, n in enumerate(notice) for w in (n, *(f"x{k}y{j}" for j in range(2)))]
        texts.append(" ".join([f"f{j}" for j in range(offset)] + spread[:60] + ["end"] * 30))
    rng = random.Random(2)
    whole = " ".join(f"term{k % 190}" for k in range(400))
    texts += ["pre " * 50 + whole + " post" * 50, whole.replace("term1", "other"), " ".join(rng.sample(whole.split(), 400))]
    templates = license_scan.TEMPLATES | {"long": whole, "tiny": "tiny"}
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, "tiny"])], "doc_id int, text string")
    got = license_scan.scan_licenses(docs, templates=templates).orderBy("doc_id").collect()
    for r, text in zip(got, [*texts, "tiny"], strict=True):
        want = plain_scan(text, templates)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == want
        assert all(b.containment >= license_scan.THRESHOLD for b in r.blocks)
    assert all("mit-text" in r.labels for r in got[:24])


def test_licenses_of_documents(spark, sf_dir, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in queries.op7_license_scan(spark, sf_dir).collect():
        assert tuple(r)[1:] == plain_scan(texts[r.doc_id])


# ---- tokens -----------------------------------------------------------------------


def check_tokens(docs, texts, most=bpe.LEXICON_WORDS):
    rules = bpe.Rules.load(BPE_FILE)
    lexicon = bpe.build_lexicon(docs, rules, most=most)
    got = {r._k: r for r in bpe.encode_decode(docs, rules, lexicon, batch_chars=5000).collect()}
    library = Tokenizer.from_file(BPE_FILE)
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[k].ids == " ".join(map(str, ids)), text[:80]
        assert got[k].n_tokens == len(ids)
        assert got[k].decoded == library.decode(ids, skip_special_tokens=False)


ODD = [
    "<|endoftext|>a<|startoftext|> <|END", "don't I'LL we've 's 'S", "a\x1cb\x1dc\x85d\u3000e", "e\u0301 \u0301x ½²Ⅷ٣",
    "日本語テキスト 한국어 \u1100\u1161", "\U0001f600\u200d x\ufe0f", "ΑΣ ΑΣΑ ς İI ǅ", "1234 5.6", "a" * 500, "\x00\x01\x7f",
]


def test_tokens_equal_the_library(spark, awkward, documents):
    for rows, most in ((ODD + [r.text for r in awkward.collect()], 50), ([r.text for r in documents.collect()], 20_000)):
        docs = spark.createDataFrame(list(enumerate(rows)), "_k int, text string")
        check_tokens(docs, rows, most)
    check_tokens(docs.limit(0), [])
    check_tokens(docs.limit(3), rows[:3], 0)


def test_chunks_met_again_stay_in_memory(monkeypatch):
    """A full memory forgets what it met once; new chunks are split all at once."""
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    rules = bpe.Rules.load(BPE_FILE)
    encoder = bpe.Encoder(rules, bpe.Lexicon.compile([], {}))
    learnt, library = [], Tokenizer.from_file(BPE_FILE)
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda new: (learnt.extend(new), learn(new)))
    often = "don't I'LL e\u0301 ΑΣ often. x \u0338"
    for k in range(12):
        text = f"{often} <|endoftext|> " + " ".join(f"w{k}x{j}," for j in range(15)) + " " + often
        ids, sizes = encoder.encode([text, ""])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids and sizes.tolist() == [len(ids), 0]
        assert len(encoder.memory.known) <= 100
    assert learnt.count("don't") == learnt.count("often.") == 1 and len(set(learnt)) == 12 * 15 + 7
    assert rules.words(["a\u0301b", "", "c1-"]) == (["áb", "c", "1", "-"], [1, 0, 3]) and rules.words([]) == ([], [])


def test_lexicon_numbers_words_and_shares_suffixes():
    words = sorted({w.encode() for w in "walking talking balking walked talked balked é walk".split()})
    lexicon = bpe.Lexicon.compile(words, {w: [k, k + 1] for k, w in enumerate(words)}).open()
    assert lexicon.numbers(words).tolist() == list(range(len(words)))
    assert [lexicon.ids_of(k) for k in range(len(words))] == [[k, k + 1] for k in range(len(words))]
    assert lexicon.numbers([b"", b"wal", b"walks", b"w" * 99, b"\xff"]).tolist() == [-1] * 5
    assert lexicon.n_states < sum(map(len, words)) / 2
