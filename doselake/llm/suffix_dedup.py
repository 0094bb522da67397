"""Repeated byte strings across documents, found with suffix arrays.

Each byte that lies in a string of ``length`` bytes that also starts somewhere else, in the same
or another document, is marked. Strings are judged on the input and overlaps count.

*Partition.* Of all 64-byte substrings of a string the smallest digest names it: equal
strings have equal names, and a text's strings fall into stretches of one name. A name with
one stretch that holds the naming substring once can't repeat. The stretches of a name are compared with each other only, each
distinct stretch once; a stretch that occurs twice is repeated as a whole.

*Suffix array.* A task takes the stretches of some names as one text and cuts it into tokens
that end at the first separator, so that no token is the beginning of another one and
token order is byte order. The suffixes of the token sequence are sorted by grouping
(``suffix_array``): groups of suffixes with one Lyndon prefix are processed from the largest down,
each splitting the groups its previous-smaller pointers lead to, and a second pass emits
every group in order. No renaming, no recursion, linear time. A byte position's suffix is the
rest of its token followed by a token suffix, so the byte-level order follows from the token-level
one. Neighbours that share ``length`` bytes are repeats.

A name with more than ``MOST`` distinct stretches is not held in one task: digests of its strings are
counted in a shuffle instead.

*Passages of words.* With ``n_words`` the same is done for sequences of that many words (case and what
stands between words don't count): a text is the sequence of its words' 64-bit digests, whose symbols go into the
suffix array as they are, and all from the first to the last word of a repeated sequence is marked.

*Hot names.* Names that can hold repeats, those with several distinct stretches, and those with very many are told by
bitmaps of fixed size, so that no join brings the stretches of a name together before each is there once. A name
that shares its bit with another is looked at in vain, which changes nothing.

Null counts as the empty text. Texts shorter than ``length`` have nothing to remove.
Repeated rows are repeats of each other. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from doselake.llm.common import (
    INVERSE,
    PRIME,
    WORD_BYTES,
    among,
    bitmap,
    discard,
    marked,
    mixed,
    numbered,
    partitions,
    powers,
    quoted,
    slices,
    stored,
    text_key,
    trimmed,
    word_digests,
)

#: Bytes of a string, and of the substrings that name it; for sequences of words, words.
LENGTH, GRAM, WORD_GRAM = 400, 64, 8
#: Bytes of a symbol: of a byte, and of a word's digest.
BYTES, WORDS = 1, 8
#: Strings in a stretch at most, distinct stretches of a name in a task at most, bytes sorted at once.
STRETCH, MOST, BATCH = 1024, 4000, 400_000
#: Bytes shifted by one make room for an end mark; 0xFF does not occur in UTF-8.
SHIFT = bytes(min(b + 1, 255) for b in range(256))
#: Separators tried one after the other until no token is long: blanks, all but letters and digits, all.
SEPARATORS = [
    re.compile(rb"[^\x00\x21\x0b]*[\x00\x21\x0b]"),
    re.compile(rb"[^\x00-\x30\x3b-\x41\x5c-\x61\x7c-\x80]*[\x00-\x30\x3b-\x41\x5c-\x61\x7c-\x80]"),
    re.compile(rb"[\x00-\xff]"),
]
LONG_TOKEN = 128


# ---- suffix sorting by grouping ---------------------------------------------------


def suffix_array(symbols: list[int]) -> list[int]:
    """Suffix array of ``symbols`` (all above 0)."""
    n = len(symbols) + 1  # with an end mark, smaller than all
    alphabet = sorted(set(symbols))
    number = {c: k for k, c in enumerate(alphabet, 1)}
    group = [number[c] for c in symbols]
    group.append(0)
    members: list[list[int]] = [[] for _ in range(len(alphabet) + 1)]
    for i, g in enumerate(group):
        members[g].append(i)
    live = [len(m) for m in members]
    above = list(range(1, len(members) + 1))
    below = list(range(-1, len(members) - 1))
    above[-1] = -1
    # left[i + 1] leads to the nearest position up to i that is not yet processed; 0: none
    left = list(range(n + 1))
    smaller = [-1] * n
    g = len(members) - 1
    while g > 0:
        here = members[g]
        if len(here) != live[g]:
            here = [i for i in here if group[i] == g]
        members[g] = None
        for i in here:
            left[i + 1] = i
        if len(here) == 1:
            i = here[0]
            x = i
            while left[x] != x:
                left[x] = x = left[left[x]]
            smaller[i] = x - 1
            if x:
                j = x - 1
                old = group[j]
                if live[old] > 1:
                    new = len(members)
                    members.append([j])
                    group[j] = new
                    live.append(1)
                    live[old] -= 1
                    up = above[old]
                    above.append(up)
                    below.append(old)
                    above[old] = new
                    below[up] = new
            g = below[g]
            continue
        pointers: dict[int, int] = {}
        for i in here:
            x = i
            while left[x] != x:
                left[x] = x = left[left[x]]
            smaller[i] = x - 1
            if x:
                pointers[x - 1] = pointers.get(x - 1, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for j, k in pointers.items():
            parts.setdefault((k, group[j]), []).append(j)
        # most pointers first: each part goes right above the group it leaves
        for _, old in sorted(parts, reverse=True) if len(parts) > 1 else parts:
            moved = parts[_, old]
            if len(moved) == live[old]:
                continue
            new = len(members)
            members.append(moved)
            for j in moved:
                group[j] = new
            live.append(len(moved))
            live[old] -= len(moved)
            up = above[old]
            above.append(up)
            below.append(old)
            above[old] = new
            below[up] = new
        g = below[g]
    start = [0] * len(members)
    g, at = 0, 0
    while g != -1:
        start[g] = at
        at += live[g]
        g = above[g]
    order = [0] * n
    placed = bytearray(n)
    order[0] = n - 1
    placed[n - 1] = 1
    for r in range(n):
        j = order[r] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[start[g]] = j
            start[g] += 1
            placed[j] = 1
            j = smaller[j]
    return order[1:]


def common_bytes(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Common prefix lengths of the byte suffixes at a and b, up to ``most`` (rounded up to 8)."""
    padded = np.concatenate([text, np.zeros(most + 16, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", padded.tobytes(), 0, (1,))
    out = np.zeros(len(a), np.int64)
    alive = np.arange(len(a))
    for k in range(0, most, 8):
        differ = words[a[alive] + k] ^ words[b[alive] + k]
        same = differ == 0
        out[alive[same]] += 8
        rest = differ[~same]
        lowest = (rest & (~rest + np.uint64(1))).astype(np.float64)
        out[alive[~same]] += np.log2(lowest).astype(np.int64) >> 3
        alive = alive[same]
        if not len(alive):
            break
    return out


def repeated_starts(stretches: list[bytes], length: int) -> list[np.ndarray]:
    """For each stretch, which of its strings of ``length`` bytes also start elsewhere in the stretches."""
    sizes = np.array([len(s) for s in stretches])
    joined = b"\x00".join(s.translate(SHIFT) for s in stretches) + b"\x00"
    for separator in SEPARATORS:
        tokens = separator.findall(joined)
        if max(map(len, tokens)) <= min(LONG_TOKEN, length - 1):
            break
    distinct = sorted(set(tokens))
    number = {t: k for k, t in enumerate(distinct, 1)}
    symbols = [number[t] for t in tokens]
    order = np.array(suffix_array(symbols), np.int64)
    n = len(symbols)
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.arange(n)
    rank[n] = n
    lengths = np.fromiter(map(len, tokens), np.int64, n)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    text = np.frombuffer(joined, np.uint8)
    shared = common_bytes(text, starts[order[:-1]], starts[order[1:]], length)
    # ids of the rests of tokens, the same for equal rests
    rests: dict[bytes, int] = {}
    bases, rest_ids = [0], []
    for t in distinct:
        rest_ids += [rests.setdefault(t[k:], len(rests)) for k in range(len(t))]
        bases.append(len(rest_ids))
    rest_ids, bases = np.array(rest_ids, np.int64), np.array(bases, np.int64)
    # every start of a whole string
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    counts = np.maximum(sizes - length + 1, 0)
    at = np.repeat(begins - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    token = np.searchsorted(starts, at, "right") - 1
    rest = rest_ids[bases[np.array(symbols, np.int64)[token] - 1] + at - starts[token]]
    left = starts[token + 1] - at
    place = rank[token + 1]
    by = np.lexsort((place, rest))
    same = np.flatnonzero(rest[by[1:]] == rest[by[:-1]])
    p, q = by[same], by[same + 1]
    low, high = place[p], place[q]
    # least shared prefix between the two ranks
    table, steps = [shared], 1
    while steps * 2 <= len(shared):
        table.append(np.minimum(table[-1][:-steps], table[-1][steps:]))
        steps *= 2
    span = high - low
    level = np.zeros(len(span), np.int64)
    level[span > 0] = np.log2(span[span > 0]).astype(np.int64)
    least = np.full(len(span), length, np.int64)
    for k in range(len(table)):
        rows = np.flatnonzero((level == k) & (span > 0) & (high < n))
        if len(rows):
            least[rows] = np.minimum(table[k][low[rows]], table[k][high[rows] - (1 << k)])
    # the suffix after the last token is empty
    least[high >= n] = 0
    hit = least + left[p] >= length
    marked = np.zeros(len(at), bool)
    marked[p[hit]] = marked[q[hit]] = True
    return np.split(marked, np.cumsum(counts)[:-1])


def repeated_sequences(stretches: list[bytes], length: int) -> list[np.ndarray]:
    """The same for stretches of words: which of their sequences of ``length`` also start elsewhere."""
    digests = [np.frombuffer(s, np.uint64) for s in stretches]
    sizes = np.array([len(d) for d in digests])
    _, number = np.unique(np.concatenate(digests), return_inverse=True)
    # a sign that no word has ends every stretch
    ends = np.cumsum(sizes)
    symbols = np.insert(number + 2, ends, 1)
    order = np.array(suffix_array(symbols.tolist()), np.int64)
    padded = np.concatenate([symbols, np.zeros(length, np.int64)])
    a, b = order[:-1], order[1:]
    alike = np.arange(len(a))
    for k in range(length):
        alike = alike[padded[a[alike] + k] == padded[b[alike] + k]]
    hit = np.zeros(len(symbols), bool)
    hit[a[alike]] = hit[b[alike]] = True
    begins = np.concatenate([[0], ends[:-1]]) + np.arange(len(sizes))
    counts = np.maximum(sizes - length + 1, 0)
    return [hit[b : b + n] for b, n in zip(begins.tolist(), counts.tolist(), strict=True)]


def equal_sequences(stretches: list[bytes], length: int) -> list[np.ndarray]:
    """What ``repeated_sequences`` gives, by sorting digests of all sequences; equal ones are compared word by word."""
    digests = [np.frombuffer(s, np.uint64) for s in stretches]
    sizes = np.array([len(d) for d in digests])
    words = np.concatenate([*digests, np.zeros(length, np.uint64)])
    h = sequence_digests(words, length)
    counts = np.maximum(sizes - length + 1, 0)
    begins = np.cumsum(sizes) - sizes
    at = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    order = np.argsort(h[at], kind="stable")
    a, b = at[order[:-1]], at[order[1:]]
    alike = np.flatnonzero(h[a] == h[b])
    for k in range(length):
        if (words[a[alike] + k] != words[b[alike] + k]).any():
            # two sequences with one digest may hide equal ones that are not neighbours
            return repeated_sequences(stretches, length)
    hit = np.zeros(len(words), bool)
    hit[a[alike]] = hit[b[alike]] = True
    return [hit[b : b + n] for b, n in zip(begins.tolist(), counts.tolist(), strict=True)]


# ---- names and stretches ----------------------------------------------------------


def units(text: str | None, width: int) -> bytes:
    """A text as symbols of ``width`` bytes."""
    return (text or "").encode("utf-8", "replace") if width == BYTES else word_digests(text).tobytes()


def sequence_digests(digests: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit digest of every sequence of ``size`` words."""
    n = len(digests) - size + 1
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + digests[k : k + n])
    return h


def gram_digests(raw: bytes, size: int) -> np.ndarray:
    """A 64-bit digest of every substring of ``size`` bytes."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)) * powers(PRIME, n), out=sums[1:])
    h = (sums[size:] - sums[:-size]) * powers(INVERSE, n)[: n - size + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    least, done = h, 1
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
    return least


def stretches_of(raw: bytes, length: int, width: int = BYTES) -> list[tuple[int, int, int, int, bool]]:
    """(name, digest of the stretch, first string, number of strings, may it repeat itself).

    Only a stretch that holds its naming substring twice can hold equal strings.
    """
    if len(raw) < length * width:
        return []
    gram = min(GRAM if width == BYTES else WORD_GRAM, length)
    grams = gram_digests(raw, gram) if width == BYTES else sequence_digests(np.frombuffer(raw, np.uint64), gram)
    names = sliding_least(grams, length - gram + 1)
    cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
    out = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        for s in range(a, b, STRETCH):
            e = min(b, s + STRETCH)
            digest = hashlib.blake2b(raw[s * width : (e + length - 1) * width], digest_size=8).digest()
            twice = np.count_nonzero(grams[s : e + length - gram] == names[a]) > 1
            out.append((int(names[a]) - (1 << 63), int.from_bytes(digest, "little", signed=True), s, e - s, twice))
    return out


def stretches(docs: DataFrame, length: int, width: int = BYTES) -> DataFrame:
    """(name, digest, key, id, start, n, twice) of all documents (key, id, text)."""

    def cut(batches):
        for batch in slices(batches):
            cols: list[list] = [[], [], [], [], [], [], []]
            for key, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for name, digest, start, n, twice in stretches_of(units(text, width), length, width):
                    for col, x in zip(cols, (name, digest, key, doc, start, n, twice), strict=True):
                        col.append(x)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                names=["name", "digest", "key", "id", "start", "n", "twice"],
            )

    return docs.mapInArrow(trimmed(cut), "name long, digest long, key binary, id string, start int, n int, twice boolean")


def cut_out(docs: DataFrame, wanted: DataFrame, length: int, width: int = BYTES) -> DataFrame:
    """(name, digest, bytes) of the wanted stretches (name, digest, key, id, start, n)."""
    per_doc = wanted.groupBy("key", "id").agg(F.collect_list(F.struct("name", "digest", "start", "n")).alias("cuts"))
    rows = among(docs, "key", bitmap(wanted, "key")).join(per_doc, ["key", "id"]).select("text", "cuts")

    def cut(batches):
        for batch in slices(batches):
            cols: list[list] = [[], [], []]
            for text, cuts in zip(batch.column(0), batch.column(1), strict=True):
                raw = units(text.as_py(), width)
                for c in cuts.as_py():
                    cols[0].append(c["name"])
                    cols[1].append(c["digest"])
                    cols[2].append(raw[c["start"] * width : (c["start"] + c["n"] + length - 1) * width])
            kinds = (pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["name", "digest", "raw"]
            )

    return rows.mapInArrow(trimmed(cut), "name long, digest long, raw binary")


def intervals(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2].tolist(), edge[1::2].tolist()


def sorted_repeats(cuts: DataFrame, length: int, find) -> DataFrame:
    """(name, digest, spans) of repeated strings; ``find`` tells them among the stretches of some names."""

    def judge(batch: dict[tuple[int, int], bytes]):
        rows = []
        for (name, digest), flags in zip(batch, find(list(batch.values()), length), strict=True):
            if flags.any():
                rows.append((name, digest, [{"s": s, "e": e} for s, e in zip(*intervals(flags), strict=True)]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
            ],
            names=["name", "digest", "spans"],
        )

    def work(batches):
        held: dict[tuple[int, int], bytes] = {}
        size, last = 0, None
        for batch in batches:
            for name, digest, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if name != last and size >= BATCH:
                    yield from judge(held)
                    held, size = {}, 0
                last = name
                if (name, digest) not in held:
                    held[name, digest] = raw
                    size += len(raw)
        if held:
            yield from judge(held)

    return (
        cuts.repartition(partitions(cuts.sparkSession), "name")
        .sortWithinPartitions("name")
        .mapInArrow(trimmed(work), "name long, digest long, spans array<struct<s:int,e:int>>")
    )


def counted_repeats(cuts: DataFrame, length: int, width: int = BYTES) -> DataFrame:
    """The same for names with very many stretches, by counting 128-bit digests of their strings."""

    def work(batches):
        for batch in batches:
            for name, digest, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                n = len(raw) // width - length + 1
                size = length * width
                strings = [
                    hashlib.blake2b(raw[k : k + size], digest_size=16).digest() for k in range(0, n * width, width)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(strings, pa.binary()),
                        pa.array([name] * n, pa.int64()),
                        pa.array([digest] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                    ],
                    names=["string", "name", "digest", "at"],
                )

    strings = cuts.dropDuplicates(["name", "digest"]).mapInArrow(
        work, "string binary, name long, digest long, at int"
    )
    twice = strings.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string")
    span = F.struct(F.col("at").alias("s"), (F.col("at") + 1).alias("e"))
    return strings.join(twice, "string").groupBy("name", "digest").agg(F.collect_list(span).alias("spans"))


def repeated_spans(docs: DataFrame, length: int, width: int = BYTES, find=None) -> DataFrame:
    """(key, id, spans): ranges of symbols to remove, of documents that have any; docs: (key, id, text)."""
    find = find or (repeated_starts if width == BYTES else repeated_sequences)
    all_ = stored(stretches(docs, length, width), "repeat-stretches")
    counts = all_.groupBy("name").agg(F.count("*").alias("n"), F.bool_or("twice").alias("twice"))
    found = stored(among(all_, "name", bitmap(counts.where("n > 1 or twice"), "name")), "repeat-candidates")
    discard(all_)
    distinct = found.groupBy("name", "digest").agg(
        F.count("*").alias("copies"),
        F.first("twice").alias("twice"),
        F.min(F.struct("key", "id", "start", "n")).alias("rep"),
    )
    distinct = stored(distinct, "repeat-distinct")
    sizes = distinct.groupBy("name").agg(F.count("*").alias("n"))
    several = marked(distinct, "name", bitmap(sizes.where("n > 1"), "name"), "several").where("several or twice")
    several = several.select("name", "digest", "rep.*")
    many = sizes.where(F.col("n") > MOST)
    if many.isEmpty():
        spans = sorted_repeats(cut_out(docs, several, length, width), length, find)
    else:
        parts = stored(marked(several, "name", bitmap(many, "name"), "many"), "repeat-several")
        few = cut_out(docs, parts.where("not many").drop("many"), length, width)
        rest = cut_out(docs, parts.where("many").drop("many"), length, width)
        spans = sorted_repeats(few, length, find).unionByName(counted_repeats(rest, length, width))
    once = distinct.where("copies = 1").select("name", "digest")
    whole = F.array(F.struct(F.lit(0).alias("s"), F.col("rep.n").alias("e")))
    every = distinct.where("copies > 1").select("name", "digest", whole.alias("spans"))
    spans = stored(spans.join(once, ["name", "digest"], "left_semi").unionByName(every), "repeat-spans")
    shifted = F.transform(
        "spans",
        lambda x: F.struct(
            (F.col("start") + x["s"]).alias("s"), (F.col("start") + x["e"] + (length - 1)).alias("e")
        ),
    )
    return (
        found.join(spans, ["name", "digest"])
        .select("key", "id", shifted.alias("spans"))
        .groupBy("key", "id")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def passages(raw: bytes, spans: list[dict]) -> list[dict]:
    """Byte ranges of ranges of words."""
    word = np.frombuffer(raw.translate(WORD_BYTES), np.uint8) != 0x20
    starts, ends = intervals(word)
    return [{"s": starts[x["s"]], "e": ends[x["e"] - 1]} for x in spans]


def row_id(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    n_words: int | None = None,
    also_words: int | None = None,
) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept (the remaining bytes) and removed spans.

    Repeats are strings of ``length`` bytes, or passages of ``n_words`` words if that is given. With ``also_words``,
    n_passage_bytes counts the bytes in repeated passages of so many words, which stay; they are only counted, by
    digests and comparison instead of suffix arrays. Those names replace
    columns of the input.
    """
    made = T.StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    span = T.StructType().add("s", "integer").add("e", "integer")
    made = made.add("kept", "binary").add("spans", T.ArrayType(span))
    if also_words:
        made = made.add("n_passage_bytes", "long")
    own = [k for k, c in enumerate(docs.columns) if c.lower() not in made.names]
    key, id_ = text_key(text), row_id(doc_id)
    narrow = docs.select(key.alias("key"), id_.alias("id"), quoted(text).alias("text"))
    found = repeated_spans(narrow, n_words, WORDS) if n_words else repeated_spans(narrow, length)
    rows = numbered(docs.select("*", key, id_))
    at, width = docs.columns.index(text), len(docs.columns)
    rows = rows.withColumnsRenamed({f"c{width}": "key", f"c{width + 1}": "id"}).join(found, ["key", "id"], "left")
    if also_words:
        more = repeated_spans(narrow, also_words, WORDS, equal_sequences).withColumnRenamed("spans", "more")
        rows = rows.join(more, ["key", "id"], "left")
    rows = rows.drop("key", "id")
    schema = T.StructType([docs.schema[docs.columns[k]] for k in own] + made.fields)
    arrow = to_arrow_schema(made)

    def work(batches):
        for batch in slices(batches):
            rows = []
            for row, value in enumerate(batch.column(at)):
                raw = (value.as_py() or "").encode("utf-8", "replace")
                found = batch.column(width)[row].as_py() or []
                gone = merged(passages(raw, found) if n_words and found else found)
                end, parts = 0, []
                for s, e in gone:
                    parts.append(raw[end:s])
                    end = e
                parts.append(raw[end:])
                kept = b"".join(parts)
                made = [len(raw), len(raw) - len(kept), len(gone), kept, [{"s": s, "e": e} for s, e in gone]]
                if also_words:
                    more = batch.column(width + 1)[row].as_py()
                    made.append(sum(e - s for s, e in merged(passages(raw, more))) if more else 0)
                rows.append(made)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in own] + [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)],
                names=schema.names,
            )

    return rows.mapInArrow(trimmed(work), schema)
