"""Phrases that occur more often than their parts suggest, by the stripes pattern.

Text (A-Z lower-cased) is cut at punctuation and line ends into pieces and at blanks into words. Everything is
counted per language. A phrase without its last word is a prefix, and each prefix keys a stripe: how often which
word comes next. Tasks count stripes in arrays and emit them in segments of
next words; equal segments are merged elementwise. So one structure holds

* the extensions: counts of all phrases of one more word, the empty prefix's being all words,
* the prefix totals: a prefix is itself an extension of the one before, so its stripe's total stands there,
* the subsumption maxima: the most frequent extension of a prefix.

A phrase is no more frequent than any part of it. So stripes are counted only along words that are frequent and whose
pairs and triples may be. Tasks know that from bitmaps: one of digests of the frequent words, and two of sieves. A sieve
is a row of counters that all pairs of frequent words, or triples of such pairs, are added up in by digest: those of a
frequent one reach the least count. Where digests share a bit or a counter, more is counted than
needs be, and the result is the same.

Every cut of a phrase of a words in two parts gives ``a * n / (l * r)``; the lowest counts. All arithmetic is in
integers of up to 38 digits. Phrases inside a longer one that is (nearly) as frequent are dropped: if such a
longer phrase exists, one longer by one word does as well, so looking at those is enough.

Null text counts as empty, null language as ``und``. Ties in score go by frequency, then by phrase in
byte order. Repeated rows count each. Long texts cost time in proportion; what a task holds is bounded apart from the
batch in hand. Empty tables give an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doselake.llm.common import quoted, stored

#: A-Z lower-cased, tab to blank, signs that end a piece to a comma.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b == 0x09 else 0x2C if b in b".,;:!?\n\x0b\x0c\r" else b
    for b in range(256)
)
BREAK = b","
UNKNOWN = "und"
#: Segments of the stripe of all words, and of any other stripe.
WORD_SEGMENTS, SEGMENTS = 4096, 16
#: Bytes of a block of a bitmap.
BLOCK = 4096
SCATTER, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
STRIPE = "lang string, prefix string, segment int, next array<string>, n array<bigint>"


@dataclass(frozen=True)
class Limits:
    """What tasks hold: none of it changes results."""

    #: Entries and words a task counts before it passes them on, bytes of text counted at once.
    entries: int = 1_000_000
    words: int = 400_000
    batch: int = 2_000_000
    #: Bits of the bitmap of words (2 MB), and of the sieve at most (128 MB): 2 to this power.
    word_bits: int = 24
    pair_bits: int = 30

    def sieve_bits(self, words: int, least: int) -> int:
        """Enough counters that the average one stays at an eighth of the least count, if that many are allowed."""
        return max(15, min(self.pair_bits, (8 * words // least).bit_length()))


def tokens(raw: bytes) -> list[bytes]:
    """Words of a text, and ``BREAK`` wherever a piece ends."""
    return raw.translate(LETTERS).replace(BREAK, b" , ").split()


def extended(digest: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Digests of phrases one word longer."""
    x = (digest * SCATTER + word + np.uint64(1)) * MIX
    return x ^ (x >> np.uint64(29))


def bucket_of(digest: np.ndarray, bits: int) -> np.ndarray:
    return (digest * SCATTER >> np.uint64(64 - bits)).astype(np.int64)


def holds(bitmap: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Whether the bits of digests are set."""
    bit = bucket_of(digest, (8 * len(bitmap) - 1).bit_length())
    return bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 > 0


def collected(blocks: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2^``bits`` bits from its blocks (block, bits)."""
    out = np.zeros(1 << bits >> 3, np.uint8).reshape(-1, BLOCK)
    for block, part in blocks.toLocalIterator():
        out[block] = np.frombuffer(bytes(part), np.uint8)
    return out.reshape(-1)


def word_digest(word: bytes) -> int:
    return zlib.crc32(word) << 32 | zlib.adler32(word)


def by_language(batches, size: int):
    """(language, texts joined by a break) of about ``size`` bytes or one text each."""
    waiting: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            raw = text.as_py()
            if not raw:
                continue
            waiting.setdefault(lang, []).append(raw)
            sizes[lang] += len(raw)
            if sizes[lang] >= size:
                yield lang, BREAK.join(waiting.pop(lang))
                del sizes[lang]
            elif sum(sizes.values()) >= 4 * size:
                yield from ((k, BREAK.join(v)) for k, v in waiting.items())
                waiting.clear()
                sizes.clear()
    yield from ((k, BREAK.join(v)) for k, v in waiting.items())


def segments(
    lang: str,
    prefixes: pa.Array,
    prefix: np.ndarray,
    names: pa.Array,
    word: np.ndarray,
    n: np.ndarray,
    segment: np.ndarray,
) -> pa.RecordBatch:
    """Stripes as a batch: entries (prefix, word, n) put together by prefix and segment."""
    order = np.lexsort((segment, prefix))
    prefix, word, n, segment = prefix[order], word[order], n[order], segment[order]
    new = np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (segment[1:] != segment[:-1])]) if len(order) else []
    at = np.flatnonzero(new)
    ends = pa.array(np.append(at, len(order)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(at), pa.string()),
            prefixes.take(pa.array(prefix[at])).cast(pa.string()),
            pa.array(segment[at].astype(np.int32)),
            pa.ListArray.from_arrays(ends, names.take(pa.array(word)).cast(pa.string())),
            pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int64))),
        ],
        names=["lang", "prefix", "segment", "next", "n"],
    )


def word_stripes(texts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Segments of each language's stripe of all words: the empty prefix."""

    def emit(lang: str, seen: Counter):
        seen.pop(BREAK, None)
        words = list(seen)
        place = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % WORD_SEGMENTS
        n = np.fromiter(seen.values(), np.int64, len(words))
        zero = np.zeros(len(words), np.int64)
        return segments(lang, pa.array([b""]), zero, pa.array(words, pa.binary()), np.arange(len(words)), n, place)

    def count(batches):
        seen: dict[str, Counter] = {}
        for lang, raw in by_language(batches, limits.batch):
            seen.setdefault(lang, Counter()).update(tokens(raw))
            if sum(map(len, seen.values())) > limits.words:
                yield from (emit(k, c) for k, c in seen.items())
                seen.clear()
        yield from (emit(k, c) for k, c in seen.items())

    return texts.mapInArrow(count, STRIPE)


class Vocabulary:
    """Numbers of the frequent words of one language as a task meets them; 0: breaks and other words."""

    def __init__(self, lang: str, bitmap: np.ndarray):
        self.lang, self.bitmap = lang, bitmap
        self.root = np.uint64(word_digest(lang.encode()))
        self.numbers: dict[bytes, int] = {BREAK: 0}
        self.names: list[bytes] = [b""]
        self._digests, self._marks = [0], [0]

    def ids(self, raw: bytes) -> np.ndarray:
        """Number of each word, with a break at the end."""
        found = tokens(raw)
        if new := list(set(found).difference(self.numbers)):
            self.numbers.update(dict.fromkeys(new, 0))
            marks = np.array([word_digest(w) for w in new], np.uint64)
            digests = extended(np.full(len(new), self.root), marks)
            for k in np.flatnonzero(holds(self.bitmap, digests)).tolist():
                self.numbers[new[k]] = len(self.names)
                self.names.append(new[k])
                self._marks.append(int(marks[k]))
                self._digests.append(int(digests[k]))
            self.digests, self.marks = np.array(self._digests, np.uint64), np.array(self._marks, np.uint64)
        return np.fromiter(map(self.numbers.__getitem__, [*found, BREAK]), np.int64, len(found) + 1)

    def forget(self) -> None:
        """Leave out the words that are not frequent: they are looked up again when they come."""
        self.numbers = {w: n for w, n in self.numbers.items() if n or w == BREAK}

    def pairs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where two frequent words follow each other, digests of the pairs)."""
        at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        return at, extended(self.digests[ids[at]], self.marks[ids[at + 1]]) if len(at) else np.empty(0, np.uint64)

    def linked(self, ids: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where pairs that may be frequent start, where two of them follow each other, digests of those triples)."""
        at, digests = self.pairs(ids)
        there = holds(pairs, digests)
        at, digests = at[there], digests[there]
        both = np.flatnonzero(at[1:] == at[:-1] + 1)
        triples = extended(digests[both], self.marks[ids[at[both] + 2]]) if len(both) else np.empty(0, np.uint64)
        return at, at[both], triples


def sieve(
    texts: DataFrame, words: np.ndarray, pairs: np.ndarray | None, bits: int, least: int, limits: Limits = Limits()
) -> np.ndarray:
    """Bitmap of the counters that reach ``least`` when pairs of frequent words are added up by digest.

    Given the bitmap of pairs, triples are.
    """
    shared = texts.sparkSession.sparkContext.broadcast((words, pairs))
    size = BLOCK * 8

    def emit(bucket: np.ndarray, n: np.ndarray):
        """Counters by block: places of two bytes, counts of one; beyond ``least`` they don't matter."""
        block = bucket // size
        at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(bucket) else []
        place = (bucket % size).astype("<u2")
        n = np.minimum(n, least).astype("<u4" if least > 255 else "u1")
        ends = [*at, len(bucket)]
        cuts = list(zip(ends, ends[1:], strict=False))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(block[at], pa.int64()),
                pa.array([place[a:b].tobytes() for a, b in cuts], pa.binary()),
                pa.array([n[a:b].tobytes() for a, b in cuts], pa.binary()),
            ],
            names=["block", "place", "n"],
        )

    def count(batches):
        held: dict[str, Vocabulary] = {}
        counts = Tally()
        frequent, pairs = shared.value
        for lang, raw in by_language(batches, limits.batch):
            if sum(len(v.numbers) for v in held.values()) > limits.words:
                for words in held.values():
                    words.forget()
            words = held.setdefault(lang, Vocabulary(lang, frequent))
            ids = words.ids(raw)
            digests = words.pairs(ids)[1] if pairs is None else words.linked(ids, pairs)[2]
            counts.add(bucket_of(digests, bits))
            if counts.entries > limits.entries and counts.pack() > limits.entries:
                yield emit(*counts.take())
        yield emit(*counts.take())

    def add(batches):
        last, sums = None, np.zeros(size, np.int64)

        def flags():
            return last, np.packbits(sums >= least, bitorder="little").tobytes()

        out = []
        for batch in batches:
            for block, place, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != last:
                    if last is not None:
                        out.append(flags())
                    last = block
                    sums[:] = 0
                sums[np.frombuffer(place, "<u2")] += np.frombuffer(n, "<u4" if least > 255 else "u1")
        if last is not None:
            out.append(flags())
        blocks, made = ([x[k] for x in out] for k in range(2))
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(made, pa.binary())], names=["block", "bits"])

    parts = texts.mapInArrow(count, "block long, place binary, n binary")
    parts = parts.repartition("block").sortWithinPartitions("block")
    return collected(parts.mapInArrow(add, "block long, bits binary"), bits)


class Tally:
    """How often numbers came."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.entries = 0

    def add(self, keys: np.ndarray) -> None:
        self.put(*np.unique(keys, return_counts=True))

    def put(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((keys, n))
        self.entries += len(keys)

    def pack(self) -> int:
        if len(self.parts) > 1:
            keys, back = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
            n = np.bincount(back, np.concatenate([c for _, c in self.parts]), len(keys)).astype(np.int64)
            self.parts = [(keys, n)]
            self.entries = len(keys)
        return self.entries

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.pack()
        keys, n = self.parts[0] if self.parts else (np.empty(0, np.int64), np.empty(0, np.int64))
        self.parts, self.entries = [], 0
        return keys, n


class Phrases:
    """What a task counts for one language: stripes of prefixes of 1 to ``longest`` words."""

    def __init__(self, lang: str, words: np.ndarray, pairs: np.ndarray, triples: np.ndarray, longest: int):
        self.lang, self.pairs, self.triples = lang, pairs, triples
        self.vocabulary = Vocabulary(lang, words)
        # numbers of phrases of each length, by prefix * 2^32 + word; 0 is no phrase
        self.numbers: list[dict[int, int]] = [{} for _ in range(longest)]
        self.names: list[list[bytes]] = [self.vocabulary.names] + [[b""] for _ in range(longest - 1)]
        self.tallies = [Tally() for _ in range(longest)]

    def numbered(self, length: int, keys: np.ndarray) -> np.ndarray:
        known, names = self.numbers[length - 1], self.names[length - 1]
        before, words = self.names[length - 2], self.names[0]
        out = np.empty(len(keys), np.int64)
        for k, key in enumerate(keys.tolist()):
            number = known.get(key)
            if number is None:
                number = known[key] = len(names)
                names.append(before[key >> 32] + b" " + words[key & 0xFFFFFFFF])
            out[k] = number
        return out

    def count(self, raw: bytes) -> None:
        ids = self.vocabulary.ids(raw)
        linked, triple = np.zeros(len(ids), bool), np.zeros(len(ids), bool)  # with the next word, the next two
        at, both, digests = self.vocabulary.linked(ids, self.pairs)
        linked[at] = True
        triple[both[holds(self.triples, digests)]] = True
        starts = np.flatnonzero(linked)
        now = ids[starts]
        for length in range(1, len(self.tallies) + 1):
            if length > 1:
                go = triple[starts + length - 2]
                starts, now = starts[go], now[go]
            if not len(starts):
                return
            keys, back, n = np.unique(now << 32 | ids[starts + length], return_inverse=True, return_counts=True)
            self.tallies[length - 1].put(keys, n)
            if length < len(self.tallies):
                now = self.numbered(length + 1, keys)[back]

    def size(self) -> int:
        return sum(t.entries for t in self.tallies) + sum(map(len, self.numbers))

    def emit(self):
        words = self.names[0]
        names = pa.array(words, pa.binary())
        place = np.array([zlib.crc32(w) % SEGMENTS for w in words], np.int64)
        for tally, prefixes in zip(self.tallies, self.names, strict=True):
            keys, n = tally.take()
            word = keys & 0xFFFFFFFF
            yield segments(self.lang, pa.array(prefixes, pa.binary()), keys >> 32, names, word, n, place[word])


def stripes(texts: DataFrame, bitmaps: tuple[np.ndarray, ...], longest: int, limits: Limits = Limits()) -> DataFrame:
    """Segments of the stripes of all prefixes of 1 to ``longest`` words; bitmaps of words, pairs, triples."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmaps)

    def count(batches):
        held: dict[str, Phrases] = {}
        for lang, raw in by_language(batches, limits.batch):
            if lang not in held:
                held[lang] = Phrases(lang, *shared.value, longest)
            held[lang].count(raw)
            if sum(len(p.vocabulary.numbers) for p in held.values()) > limits.words:
                for phrases in held.values():
                    phrases.vocabulary.forget()
            if sum(p.size() for p in held.values()) > limits.entries:
                for phrases in held.values():
                    for tally in phrases.tallies:
                        tally.pack()
                if sum(p.size() for p in held.values()) > limits.entries // 2:
                    for phrases in held.values():
                        yield from phrases.emit()
                    held.clear()
        for phrases in held.values():
            yield from phrases.emit()

    return texts.mapInArrow(count, STRIPE)


def merged(parts: DataFrame, least: int) -> DataFrame:
    """Stripe segments merged elementwise: (lang, prefix, segment, total, next), ``next`` as (word, n) with n >= ``least``.

    Each step keeps the rows where the first one put them.
    """
    key = ["lang", "prefix", "segment"]
    entries = parts.repartition(*key).select(*key, F.explode(F.arrays_zip("next", "n")).alias("e"))
    counts = entries.groupBy(*key, F.col("e.next").alias("word")).agg(F.sum("e.n").alias("n"))
    kept = F.collect_list(F.when(F.col("n") >= least, F.struct("word", "n")))
    return counts.groupBy(*key).agg(F.sum("n").alias("total"), kept.alias("next"))


def phrases_in(table: DataFrame) -> DataFrame:
    """(lang, phrase, a): the extensions that stripes hold."""
    rows = table.select("lang", "prefix", F.explode("next").alias("e"))
    phrase = F.when(F.col("prefix") == "", F.col("e.word")).otherwise(F.concat_ws(" ", "prefix", "e.word"))
    return rows.select("lang", phrase.alias("phrase"), F.col("e.n").alias("a"))


def word_bitmap(words: DataFrame, bits: int) -> np.ndarray:
    """Bits of all words (lang, phrase): of one size, however many there are."""

    def mark(batches):
        flags = np.zeros(1 << bits >> 3, np.uint8)
        for batch in batches:
            names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            marks = [(word_digest(lang.encode()), word_digest(word.encode())) for lang, word in names]
            at = bucket_of(extended(*np.array(marks, np.uint64).reshape(-1, 2).T), bits)
            np.bitwise_or.at(flags, at >> 3, (1 << (at & 7)).astype(np.uint8))
        blocks = flags.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array([blocks[k].tobytes() for k in used], pa.binary())],
            names=["block", "bits"],
        )

    parts = words.select("lang", "phrase").mapInArrow(mark, "block long, bits binary")
    return collected(parts.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits")), bits)


def count_stripes(
    docs: DataFrame, longest: int, least: int, text: str = "text", lang: str = "lang", limits: Limits = Limits()
) -> tuple[DataFrame, DataFrame]:
    """Merged stripes of all words, and of prefixes of 1 to ``longest`` - 1 words."""
    texts = docs.select(
        F.coalesce(quoted(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), quoted(text).alias("text")
    )
    words = stored(merged(word_stripes(texts, limits), least), "word-stripes")
    n = words.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    frequent = word_bitmap(phrases_in(words), max(15, limits.word_bits))
    bits = limits.sieve_bits(n, least)
    pairs = sieve(texts, frequent, None, bits, least, limits)
    triples = sieve(texts, frequent, pairs, bits, least, limits) if longest > 2 else pairs
    parts = stripes(texts, (frequent, pairs, triples), longest - 1, limits)
    return words, stored(merged(parts, least), "stripes")


def collocations(
    docs: DataFrame,
    longest: int = 5,
    least: int = 100,
    top: int | None = 2000,
    percent: int = 100,
    text: str = "text",
    lang: str = "lang",
    limits: Limits = Limits(),
) -> DataFrame:
    """Phrases of 2 to ``longest`` words with at least ``least`` occurrences: (lang, rank, phrase, a, l, r, n, score).

    ``score`` is ``floor(1000 a n / (l r))`` of the lowest-scoring cut, ``l`` and ``r`` the counts of its parts, ``n`` all
    words. Phrases within a longer one that has ``percent`` of their occurrences are dropped. ``top`` is how many
    phrases each language reports; None: all.
    """
    words, table = count_stripes(docs, longest, least, text, lang, limits)
    sizes = words.groupBy("lang").agg(F.sum("total").alias("n"))
    candidates = stored(phrases_in(table), "candidates")
    totals = phrases_in(words).unionByName(candidates)
    # longer by a word at the end: the stripe's largest entry; at the front: of all phrases with that rest
    largest = F.array_max(F.transform("next", lambda e: e.n))
    after = table.select("lang", F.col("prefix").alias("phrase"), largest.alias("a"))
    rest = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    before = candidates.select("lang", rest.alias("phrase"), "a")
    most = after.unionByName(before).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    free = F.col("most").isNull() | (100 * F.col("most") < percent * F.col("a"))
    left = candidates.join(most, ["lang", "phrase"], "left").where(free).drop("most")
    parts = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.size(parts) - 1))
    cuts = left.select("lang", "phrase", "a", cut.alias("k"))
    cuts = cuts.withColumns(
        {
            "first": F.array_join(F.slice(parts, F.lit(1), F.col("k")), " "),
            "rest": F.array_join(F.slice(parts, F.col("k") + 1, F.size(parts) - F.col("k")), " "),
        }
    )
    l_side = totals.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    r_side = totals.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cuts = cuts.join(l_side, ["lang", "first"]).join(r_side, ["lang", "rest"]).join(sizes, "lang")
    wide = {c: F.col(c).cast("decimal(17,0)") for c in "alrn"}
    cuts = cuts.withColumn("over", F.lit(1000).cast("decimal(4,0)") * wide["a"] * wide["n"])
    cuts = cuts.withColumn("under", wide["l"] * wide["r"]).withColumn("score", F.expr("over div under"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    scored = best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:
        # many tasks choose among their share first
        share = Window.partitionBy("lang", "salt").orderBy(*order)
        salted = scored.withColumn("salt", F.crc32("phrase") % 64).withColumn("place", F.row_number().over(share))
        scored = salted.where(F.col("place") <= top).drop("salt", "place")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = scored.withColumn("rank", rank)
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
