"""Operators that compare documents with each other, against plain versions."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

import corpus_pipeline
from doselake.llm import common, decontaminate, minhash, queries, sharding, suffix_dedup

# ---- shards -----------------------------------------------------------------------


def plain_capacity(sizes, n):
    def fits(c):
        used, load = 1, 0
        for s in sizes:
            if s > c:
                return False
            if load + s > c:
                used, load = used + 1, 0
            load += s
        return used <= n

    low, high = 1, max(1, sum(sizes))
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def check_shards(docs, rows, n):
    got = sharding.assign_shards(docs, n).collect()
    assert len(got) == len(rows)
    assert {r.law for r in got} <= {"bytes"} and {r.grown_shard for r in got} <= {None}
    slots = defaultdict(list)
    loads = Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(n))
    # groups whole, in digest order, cut at the smallest capacity
    import hashlib

    groups = Counter()
    for r in rows:
        text = r[1]
        key = b"" if text is None else hashlib.sha256(text.encode()).digest()
        groups[key] += len((text or "").encode()) + 1
    sizes = [groups[k] for k in sorted(groups)]
    if rows:
        assert max(loads.values()) == plain_capacity(sizes, n)


def test_shards_against_plain_version(spark, awkward, documents, monkeypatch):
    awk = brute.awkward()
    check_shards(brute.odd_columns(awkward), awk, 16)
    check_shards(awkward, awk, 3)
    check_shards(brute.empty(spark), [], 16)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    check_shards(documents, rows, 16)
    hot = [(k, "the hot text" if k % 3 == 0 else f"text {k} " * (k % 7)) for k in range(300)]
    monkeypatch.setattr(sharding, "SPLIT", 2)
    check_shards(spark.createDataFrame(hot, "doc_id int, text string"), hot, 5)


def test_cuts_from_few_known_sums(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SPLIT", 3)
    rng = random.Random(5)
    for n in (1, 2, 7):
        sizes = [rng.choice([1, 2, 5, 90]) for _ in range(60)]
        ends = np.cumsum(sizes)
        groups = spark.createDataFrame([(int(e),) for e in ends], "end long")
        known = sharding.PrefixSums(ends[[19, 39, 59]], np.array([20, 20, 20]))
        cuts = sharding.minimax_cuts(groups, known, n, max(sizes))
        assert set(cuts) <= set(ends.tolist())
        loads = np.diff([0, *cuts])
        assert cuts[-1] == ends[-1] and loads.max() == plain_capacity(sizes, n)


# ---- repeated strings -------------------------------------------------------------


def plain_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if count[r[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[: len(r)]
        runs = int(np.sum(gone & ~np.concatenate([[False], gone[:-1]])))
        kept = bytes(np.frombuffer(r, np.uint8)[~gone]) if len(r) else b""
        out.append((len(r), int(gone.sum()), runs, brute.sha(kept)))
    return out


def check_repeats(spark, texts, length):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = suffix_dedup.remove_repeats(brute.odd_columns(docs), length=length).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in got] == plain_repeats(texts, length)


def test_suffix_array_equals_sorting():
    rng = random.Random(1)
    for _ in range(2000):
        s = [rng.randint(1, rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(1, 40))]
        assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_repeated_starts_equal_counting():
    rng = random.Random(2)
    for _ in range(400):
        letters = rng.choice([b"ab ", b"a", b"abcdef  \n", b"ab", " é漢".encode()])
        parts = [bytes(rng.choices(letters, k=rng.randint(8, 60))) for _ in range(rng.randint(1, 6))]
        parts.append(bytes(rng.choices(letters, k=5)) + rng.choice(parts)[:40])
        count = Counter(p[i : i + 8] for p in parts for i in range(len(p) - 7))
        want = [[count[p[i : i + 8]] > 1 for i in range(len(p) - 7)] for p in parts]
        assert [g.tolist() for g in suffix_dedup.repeated_starts(parts, 8)] == want


def test_repeats_against_plain_version(spark, documents):
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdefgh \n", k=150))
    texts = ["".join(rng.choices("abcdefghé \n", k=rng.randint(0, 300))) for _ in range(30)]
    texts = [t[: len(t) // 2] + passage[k : k + 110] + t[len(t) // 2 :] for k, t in enumerate(texts)]
    check_repeats(spark, texts + [None, "", None, texts[0], "z" * 400, "zy" * 90], 100)
    check_repeats(spark, [r[1] for r in brute.awkward(3000)], 400)
    check_repeats(spark, [r.text for r in documents.collect()], 400)
    assert suffix_dedup.remove_repeats(brute.empty(spark)).count() == 0


def test_names_with_many_stretches_are_counted(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST", 3)
    passage = "this very passage stands in all of them and is long enough to count. " * 2
    texts = [f"{k} {'x' * k} {passage[k % 5 :]} {k * 7}" for k in range(40)]
    check_repeats(spark, texts, 100)


def repeated_passages(texts, n):
    """Positions (text, word) in passages of ``n`` words that stand twice."""
    places = defaultdict(list)
    for i, t in enumerate(texts):
        ws = brute.words(t)
        for at in range(len(ws) - n + 1):
            places[tuple(ws[at : at + n])].append((i, at))
    return {(i, at + k) for found in places.values() if len(found) > 1 for i, at in found for k in range(n)}


def test_pipeline_cuts_short_passages_of_51_words(spark, sf_dir, documents):
    rng = random.Random(8)

    def some(n):
        return [rng.choice("abcdefgh") + str(rng.randrange(10**4)) for _ in range(n)]

    shared, fewer = some(52), some(50)
    assert len(" ".join(shared)) < 400
    texts = [" ".join(some(60) + shared[k % 2 :] + some(60)) for k in range(4)]
    texts += [" ".join(some(20)) + ", " + ", ".join(shared).upper() + ".", None, "", "."]
    texts += [" ".join(some(9) + fewer + some(9)) for _ in range(2)]
    rows = [(k, t, "en", "s", len(t) if t is not None else None) for k, t in enumerate(texts)]
    rows += [(100 + k, r.text, "en", "s", r.n_chars) for k, r in enumerate(documents.where("n_chars < 3000").collect())]
    gone = repeated_passages([r[1] for r in rows], 51)
    docs = spark.createDataFrame(rows, brute.DOCS)
    words = suffix_dedup.remove_repeats(docs, n_words=51).select("doc_id", "kept").collect()
    left = {r.doc_id: brute.words(bytes(r.kept).decode()) for r in words}
    want = {r[0]: [w for at, w in enumerate(brute.words(r[1])) if (i, at) not in gone] for i, r in enumerate(rows)}
    assert left == want and {(i, 60 + 1) for i in range(4)} <= gone
    kept = {r.doc_id: r.text for r in corpus_pipeline.drop_repeats(spark, docs, sf_dir).collect()}
    assert not repeated_passages(kept.values(), 51)
    assert all(n == 0 for _, n, _, _ in plain_repeats(kept.values(), 400))
    assert kept[8] == texts[8] and kept[9] == texts[9] and kept[5] is None and kept[7] == "."


def test_sequences_by_suffix_array_and_by_digest():
    rng = np.random.default_rng(3)
    for _ in range(60):
        parts = [rng.integers(0, 3, rng.integers(1, 40)).astype(np.uint64).tobytes() for _ in range(rng.integers(1, 8))]
        length = int(rng.integers(1, 9))
        texts = [np.frombuffer(p, np.uint64).tolist() for p in parts]
        all_ = Counter(tuple(t[k : k + length]) for t in texts for k in range(len(t) - length + 1))
        want = [[all_[tuple(t[k : k + length])] > 1 for k in range(len(t) - length + 1)] for t in texts]
        for find in (suffix_dedup.repeated_sequences, suffix_dedup.equal_sequences):
            assert [f.tolist() for f in find(parts, length)] == want


def test_word_digests_are_those_of_words():
    texts = ["The cat, the  CAT!", "", "é É 你好 x", "a" * 70_000 + " b a", None]
    seen = {}
    for text in texts:
        digests = common.word_digests(text).tolist()
        words = common.words_of(text)
        assert len(digests) == len(words)
        for word, d in zip(words, digests, strict=True):
            assert seen.setdefault(word, d) == d
    assert len(set(seen.values())) == len(seen)


def test_passage_bytes_beside_the_law(spark, sf_dir, documents):
    both = {r.doc_id: r for r in queries.op3_suffix_dedup(spark, sf_dir).collect()}
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    gone = repeated_passages([t for _, t in texts], 51)
    holds = {texts[k][0] for k, _ in gone}
    assert {d for d, r in both.items() if r.n_passage_bytes} == holds


# ---- benchmark passages -----------------------------------------------------------


def plain_hits(text, items, length):
    ws, hit, found = brute.words(text), set(), set()
    for item, value in items:
        iw = brute.words(value)
        size = min(length, len(iw))
        for s in range(len(iw) - size + 1) if size else ():
            w = iw[s : s + size]
            for p in range(len(ws) - size + 1):
                if ws[p : p + size] == w:
                    hit.update(range(p, p + size))
                    found.add(str(item))
    return len(ws), len(hit), sorted(found)


def check_hits(docs, items_df, **names):
    items = [(r[0], r[1]) for r in items_df.collect()]
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r.item_ids), r.contaminated)
                  for r in decontaminate.decontaminate(docs, items_df, **names).collect())
    want = Counter()
    for r in docs.collect():
        n, hit, found = plain_hits(r.text, items, 10)
        want[r.doc_id, n, hit, len(found), ",".join(found), hit > 0] += 1
    assert got == want


def test_hits_against_plain_version(spark, awkward):
    items = [
        (1, "The quick brown fox jumps over the lazy dog and runs to the river of the old town."),
        (10, "RIVER of the old"), (2, "ab ab"), (3, None), (4, ""), (5, "École École"), (6, "école école"), (7, "a"),
        (1, "you are one of those who are here, and one more"), (8, "x x x x x x x x x x x x"),
    ]
    extra = [(50, "École, École! you are one of those who are here and one more", "fr", "s", 1),
             (51, "x " * 40, "fr", "s", 1), (52, "...river of  the-old...", "fr", "s", 1)]
    docs = awkward.unionByName(spark.createDataFrame(extra, brute.DOCS))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    check_hits(docs, benchmark)
    check_hits(brute.odd_columns(docs), benchmark, block=2)
    check_hits(docs, benchmark.limit(0))
    check_hits(brute.empty(spark), benchmark)


def test_hits_of_documents(spark, sf_dir, documents):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(25)
    check_hits(documents.where("n_chars < 3000"), benchmark)


def test_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "alpha x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha q q q q q beta gamma"), (4, "alpha beta")],
        "doc_id int, text string",
    )
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id int, text string")
    docs = decontaminate.keyed(docs, "doc_id", "text")
    (windows,) = decontaminate.blocks_of(decontaminate.windows_of(items, "item_id", "text"), 100)
    windows = decontaminate.with_rarest(docs, windows, "text")
    index = decontaminate.postings(docs, windows.select("word"), "text", reach=8)
    found = decontaminate.proximity_matches(index, windows, 2).join(docs, decontaminate.DOC)
    assert {r.doc_id for r in found.collect()} == {1, 2}


def test_no_python_on_the_main_path(spark, sf_dir):
    plan = queries.op8_decontamination(spark, sf_dir)._jdf.queryExecution().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow") if w in plan]


# ---- near duplicates --------------------------------------------------------------


def plain_similarity(a, b):
    """Longest common subsequence of words, by the full table."""
    x, y = brute.words(a), brute.words(b)
    row = [0] * (len(y) + 1)
    for s in x:
        new = [0]
        for j, t in enumerate(y):
            new.append(row[j] + 1 if s == t else max(row[j + 1], new[j]))
        row = new
    return row[-1] / max(len(x), len(y)) if x and y else 0.0


def plain_classes(rows, threshold=0.8):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1] or "", rows[j][1] or ""
            if a == b or plain_similarity(a, b) >= threshold:
                parent[find(i)] = find(j)
    out = defaultdict(list)
    for i, r in enumerate(rows):
        out[find(i)].append(str(r[0]))
    return sorted(sorted(g) for g in out.values())


def got_classes(docs, rows):
    named = minhash.near_duplicates(docs)
    groups = defaultdict(list)
    for r in named.collect():
        groups[r.class_key if r.class_key is None else bytes(r.class_key)].append((r.doc_id, r.class_id, r.is_first))
    assert sum(map(len, groups.values())) == len(rows)
    for g in groups.values():
        ids = [x[0] for x in g]
        assert {x[1] for x in g} == {min((i for i in ids if i is not None), default=None)}
        assert any(x[2] for x in g)
    return sorted(sorted(str(x[0]) for x in g) for g in groups.values())


def near_copies(seed=7):
    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(4000)]
    rows, k = [], 0
    for _ in range(12):
        base = rng.choices(pool, k=rng.choice([30, 120, 400]))
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, len(base) // 100, len(base) // 30])):
                copy[rng.randrange(len(copy))] = rng.choice(pool)
            if rng.random() < 0.3:
                copy = copy[: len(copy) - len(copy) // 20]
            rows.append((k, " ".join(copy)))
            k += 1
    shuffled = " ".join(rows[0][1].split()[::-1])
    return rows + [(k, shuffled), (k + 1, rows[3][1].upper()), (k + 2, rows[5][1])]


def test_similarity_equals_alignment():
    rows = near_copies(3)
    for (_, a), (_, b) in zip(rows, rows[1:], strict=False):
        want = plain_similarity(a, b)
        got = minhash.similarity(minhash.sequence(a), minhash.sequence(b))
        assert got == pytest.approx(want) if want >= 0.8 else got < 0.8


def test_sketches_do_not_depend_on_blocks(monkeypatch):
    label = np.random.default_rng(1).integers(0, 2**63, 500, np.uint64)
    want = minhash.sketches(label)
    monkeypatch.setattr(minhash, "LABELS", 7)
    assert (minhash.sketches(label) == want).all() and len(set(want)) == minhash.SKETCHES
    assert len(minhash.sketches(label[:2])) == minhash.SKETCHES and not len(minhash.sketches(label[:0]))


@pytest.mark.parametrize("n", [5, 6, 10, 14, 15, 20, 60, 250])
def test_links_at_the_threshold_meet(n):
    rng = random.Random(n)
    pool = [f"w{k}" for k in range(3000)]
    met = links = 0
    for k in range(60):
        base = rng.choices(pool, weights=[1 / (r + 5) for r in range(3000)], k=n)
        copy, m = list(base), int(n * (0.1, 0.15, 0.18, 0.2)[k % 4])
        places = rng.sample(range(n), m) if k % 8 < 4 else range(n // 10, n, 5)[:m]
        for at in places:
            copy[at] = f"new{rng.randrange(10**6)}"
        a, b = " ".join(base), " ".join(copy)
        if plain_similarity(a, b) >= 0.8 - 1e-9:
            links += 1
            met += not set(minhash.meeting_places(a)).isdisjoint(minhash.meeting_places(b))
    assert links == 60 and (met == 60 if n < 15 else met >= 59)


def test_classes_against_all_pairs(spark, awkward, documents):
    rows = near_copies()
    want = plain_classes(rows)
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert got_classes(brute.odd_columns(docs), rows) == want
    got_classes(awkward, brute.awkward())
    assert minhash.near_duplicates(brute.empty(spark)).count() == 0


@pytest.mark.parametrize("members", [minhash.MEMBERS, 3])
def test_buckets_get_new_hubs_until_none_is_left(spark, monkeypatch, members):
    monkeypatch.setattr(minhash, "MEMBERS", members)
    base = [f"w{k}" for k in range(300)]
    # all share their first half, pairs share their second half as well
    rows = []
    for k in range(12):
        tail = [f"t{k // 2}x{j}" for j in range(280)]
        rows.append((k, " ".join(base + tail + [f"end{k}"])))
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = got_classes(docs, rows)
    assert got == sorted(sorted([str(2 * k), str(2 * k + 1)]) for k in range(6))


@pytest.mark.parametrize("members", [minhash.MEMBERS, 3])
def test_members_that_left_with_the_hub_stay_partners(spark, monkeypatch, members):
    monkeypatch.setattr(minhash, "MEMBERS", members)
    rng = random.Random(11)

    def chain(name, n):
        words, out = [f"{name}{k}" for k in range(100)], []
        for step in range(n):
            words[step * 12 % 100 : step * 12 % 100 + 12] = [f"{name}{step}x{j}" for j in range(12)]
            out.append(" ".join(words))
        return out

    texts = chain("h", 3) + chain("c", 14) + [" ".join(f"u{k}x{j}" for j in range(90 + k)) for k in range(4)]
    keys = [bytes([k]) for k in rng.sample(range(1, 200), len(texts))]
    keys[:3] = b"\x00", keys[1], keys[2]  # the first one's end is the hub
    rows = [(1, k, b"\x00") for k in keys]
    open_ = spark.createDataFrame(rows, "bucket long, key binary, hub binary")
    seqs = [(k, t, len(t.split())) for k, t in zip(keys, texts, strict=True)]
    links = minhash.links_in(open_, spark.createDataFrame(seqs, "key binary, text string, n long"), 0.8)
    named = {bytes(r.key): bytes(r.root) for r in minhash.components(corpus_pipeline.stored(links, "test-links")).collect()}
    groups = defaultdict(list)
    for n, k in enumerate(keys):
        groups[named.get(k, k)].append(str(n))
    assert plain_similarity(texts[0], texts[2]) < 0.8 <= plain_similarity(texts[1], texts[2])
    assert sorted(map(sorted, groups.values())) == plain_classes(list(enumerate(texts)))


def test_crowds_meet_by_their_rarest_words(spark, monkeypatch):
    """Texts that share a passage, and some of them more than that, in buckets too large for all pairs."""
    monkeypatch.setattr(minhash, "MEMBERS", 4)
    rng = random.Random(4)
    passage = [f"p{k}" for k in range(60)]
    texts = []
    for k in range(30):
        own = [f"o{k}x{j}" for j in range(60)]
        texts.append(passage + own)
        if k % 3 == 0:
            other = passage[:] + own[:]
            for at in rng.sample(range(120), 20):
                other[at] = f"e{k}y{at}"
            texts.append(other)
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert got_classes(docs, rows) == plain_classes(rows)
    # the filter by itself: every pair that belongs together has a rare word in common
    seqs = spark.createDataFrame([(str(k).encode(), t, len(t.split())) for k, t in rows], "key binary, text string, n long")
    crowd = seqs.selectExpr("key", "key as root")
    buckets = defaultdict(set)
    for r in minhash.rare_words(crowd, seqs, 0.8).collect():
        buckets[int(bytes(r.key))].add(r.bucket)
    for a in range(len(rows)):
        for b in range(a):
            if plain_similarity(rows[a][1], rows[b][1]) >= 0.8:
                assert buckets[a] & buckets[b]


def test_recall_against_all_pairs(documents):
    """Of all pairs of documents that align at 0.8 or more, those with one text apart, how many meet in a bucket."""
    rows = [(r.doc_id, r.text) for r in documents.collect() if r.text]
    rows = list({t: (k, t) for k, t in rows}.values())
    seqs = [minhash.sequence(t) for _, t in rows]
    places = [set(minhash.meeting_places(t).tolist()) for _, t in rows]
    met = linked = 0
    for a, (doc_id, _) in enumerate(rows):
        for b in range(len(rows)):
            if doc_id % 20 == 0 and a != b and minhash.similarity(seqs[a], seqs[b]) >= 0.8 - 1e-9:
                linked += 1
                met += bool(places[a] & places[b])
    assert met >= 0.99 * linked


def test_one_of_each_class_stays(spark, awkward):
    rows = near_copies()
    docs = spark.createDataFrame(rows + rows[:3], "doc_id int, text string")
    kept = minhash.keep_first(docs).collect()
    classes = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in kept) == sorted(set(classes.values()))
    whole = minhash.keep_first(brute.odd_columns(awkward))
    assert whole.columns == brute.odd_columns(awkward).columns


def test_components_of_long_chains(spark):
    pairs = [(bytes([k]), bytes([k + 1]), 1.0) for k in range(0, 60) if k != 30]
    links = spark.createDataFrame(pairs, "key binary, hub binary, similarity double")
    got = {bytes(r.key): bytes(r.root) for r in minhash.components(links).collect()}
    assert got == {bytes([k]): bytes([0 if k <= 30 else 31]) for k in range(61)}


def test_components_after_more_links(spark):
    rng = random.Random(3)
    links = [(bytes([a]), bytes([b]), 1.0) for a, b in (rng.sample(range(80), 2) for _ in range(60))]
    kind = "key binary, hub binary, similarity double"
    before = minhash.components(spark.createDataFrame(links[:35], kind))
    for more in (links[35:], links[:3], []):
        got = minhash.joined(before, spark.createDataFrame(more, kind)).collect()
        want = minhash.components(spark.createDataFrame(links[:35] + more, kind)).collect()
        assert sorted((bytes(r.key), bytes(r.root)) for r in got) == sorted((bytes(r.key), bytes(r.root)) for r in want)


def test_buckets_and_texts_of_single_documents_are_not_shuffled(spark):
    rows = [(k, f"one two three four five w{k}") for k in range(40)] + [(99, "one two three four five w7"), (None, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    found, made = minhash.sketched(docs, "doc_id", "text")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert made.count() == len(rows)
    got = {bytes(r.key): (r.id, r.n, r.sketch) for r in found.collect()}
    assert found.count() == len(got) == 41
    assert sorted(x[0] for x in got.values()) == sorted([*range(40), 5])
    assert all(x[1] == 6 and len(x[2]) > minhash.SKETCHES for x in got.values() if x[1])
    seqs = spark.createDataFrame([(bytes([k]), f"a{k} " * 9) for k in range(200)], "key binary, text string")
    pairs = spark.createDataFrame([(b"\x01", b"\x02")], "key binary, hub binary")
    taken = minhash.among(seqs, "key", minhash.bitmap(pairs, "hub"))
    assert [bytes(r.key) for r in taken.collect()] == [b"\x02"]
    # the rare words of a crowd bring the number of words: no join with the texts for it
    crowd = seqs.limit(9).selectExpr("key", "key as root")
    assert {r.n for r in minhash.rare_words(crowd, seqs, 0.8).collect()} == {9}


def test_rows_of_settled_buckets_and_single_texts_are_left_out_before_shuffles(spark):
    # of the words of 200 texts one alone is in two texts, of different classes
    words = [(k, bytes([k]), bytes([k]), 9) for k in range(200)] + [(7, b"\xf0", b"\xf0", 9), (8, b"\xf1", bytes([8]), 9)]
    rows = spark.createDataFrame(words, "bucket long, key binary, root binary, n int")
    left = minhash.of_several_roots(rows)
    assert sorted((r.bucket, bytes(r.key)) for r in left.collect()) == [(7, b"\x07"), (7, b"\xf0")]
    # buckets know their number of members
    sketched = spark.createDataFrame([(1, b"a", 3), (1, b"b", 3), (1, b"c", 4), (2, b"a", 3)], "bucket long, key binary, n int")
    assert {(r.bucket, r.members) for r in minhash.shared_buckets(sketched).collect()} == {(1, 3)}
    # only texts that occur more than once are shuffled as a whole
    docs = spark.createDataFrame([(k, f"text {k % 9}x{k // 9}") for k in range(90)] + [(90, "text 0x0")], "doc_id int, text string")
    keyed = docs.select(minhash.text_key("text").alias("key"))
    copied = minhash.bitmap(keyed.groupBy("key").count().where("count > 1"), "key")
    seqs, held = minhash.sequences(docs, keyed, "text", copied)
    assert seqs.count() == 90 and held[0].where("copied").count() == 2
    assert held[0].count() == 91


def test_members_of_buckets_are_compared_without_their_texts(spark, monkeypatch):
    """Pairs to align come from classes of words, each member once a bucket, however many lengths there are."""
    monkeypatch.setattr(minhash, "MEMBERS", 3)
    rng = random.Random(8)
    texts = []
    for k in range(6):
        own = [f"o{k}x{j}" for j in range(60 + 15 * k)]
        texts.append(own)
        texts.append([w if rng.random() > 0.1 else f"e{k}{w}" for w in own])
    words = [minhash.sequence(" ".join(t)) for t in texts]
    rows = [(bucket, bytes([k]), bytes([k]), len(w), minhash.binned(w)) for bucket in (1, 2) for k, w in enumerate(words)]
    # settled: of one class; longer than a byte counts
    rows += [(3, bytes([k]), b"\x00", 400, minhash.binned(np.zeros(400, np.uint64))) for k in (100, 101)]
    rows += [(4, bytes([k]), bytes([k]), 400, minhash.binned(np.zeros(400, np.uint64))) for k in (102, 103)]
    buckets = spark.createDataFrame(rows, "bucket long, key binary, root binary, n int, bins binary")
    got = {(r.key[0], r.hub[0]) for r in minhash.candidates(buckets, 0.8).collect()}
    alike = {
        (a, b) for b in range(12) for a in range(b) if minhash.similarity(words[a], words[b]) >= 0.8 - 1e-9
    }
    assert {(2 * k, 2 * k + 1) for k in range(6)} <= alike | got
    assert alike <= got and (102, 103) in got and (100, 101) not in got and len(got) < 20
    made = minhash.candidates(buckets, 0.8)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in made and "text" not in made


# ---- pipeline ---------------------------------------------------------------------


def test_pipeline(spark, sf_dir, documents):
    kept = documents
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        kept = corpus_pipeline.stored(stage(spark, kept, sf_dir), f"test-{name}")
        after = {r.doc_id for r in kept.select("doc_id").collect()}
        assert after <= before
        if name != "bpe":
            assert kept.schema.simpleString() == documents.schema.simpleString()
    final = kept.collect()
    texts = [r.text for r in final]
    assert len(final) > documents.count() / 2
    assert all(n == 0 for _, n, _, _ in plain_repeats([], 400)) and len(set(texts)) == len(texts)
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(5).collect()]
    assert not any(plain_hits(t, items, 10)[1] for t in texts)
    assert all(r.n_chars == len(r.text) and r.n_tokens == len(r.ids.split()) for r in final)


def test_pipeline_keeps_every_determined_language(spark, sf_dir, monkeypatch):
    language_id = corpus_pipeline.language_id
    docs = spark.createDataFrame([(1, "die", None, "s", 3), (2, "...", "de", "s", 3)], brute.DOCS)
    judged = docs.selectExpr("*", f"if(doc_id = 1, 'de', '{language_id.UNDETERMINED}') as lang_pred", "0.3D as score")
    monkeypatch.setattr(language_id, "train", lambda *_: None)
    monkeypatch.setattr(language_id, "predict", lambda *_: judged)
    kept = corpus_pipeline.identify_language(spark, docs, sf_dir).collect()
    assert [(r.doc_id, r.lang) for r in kept] == [(1, "de")]


def test_pipeline_stages_on_awkward_and_empty_tables(spark, sf_dir, awkward):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, awkward, sf_dir).collect()
        assert stage(spark, brute.empty(spark), sf_dir).count() == 0
