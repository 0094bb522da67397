"""Near duplicates by Order MinHash, verified by banded alignment.

A text is seen as its pairs of neighbouring words, each labelled with how often it occurred before, so
that no label repeats. One sketch keeps the ``KEPT`` smallest labels under a random order, in the
order of the text; texts close in edit distance agree in it often, texts with the same
words in another order do not. ``SKETCHES`` independent sketches are taken. Documents
that agree in one meet in a bucket. However edits are scattered, of two texts aligned at 0.8 three sevenths of all
labels at least are in both. Texts of few words meet exactly, in what is left of them
without any of the words that the threshold lets be left out (``remainders``).

Most buckets hold one text. A bitmap of those seen twice, of fixed size, keeps the others out of all shuffles but that
which counts them, and one of the texts in such buckets all other texts. Pairs whose lengths alone rule them out
are not aligned.

In a bucket the first document is the hub, and all others are compared with it first. That
joins most of what belongs together. Where a bucket then still holds members of several classes, all pairs
of them that no links join yet are compared, those with the hub's class included: up to ``MEMBERS`` members with as
many others in a task. So no link that would join two classes is left out, but links within a class
are; ``n_pairs`` counts the links that were met, not all there are. The members of a bucket of more than ``MEMBERS`` meet
again by their rarest words instead, which loses none of the pairs (``rare_words``): many texts that share one passage
are not compared with each other for it. All of these carry how many words of each of ``BINS`` classes their text has, from
which follows what two texts have in common at most; texts are fetched only for pairs that this leaves. A comparison aligns the two word
sequences in the band of offsets
that the threshold allows; similarity is the share of the longer text's words that are
aligned, in order, with equal ones. Pairs of ``threshold`` or more are links, and classes are
the connected components of the links.

Equal texts (hence all nulls and empty texts) are one class from the start and compared once.
Texts without words have no labels and only equal ones join them. The class is named by its smallest document: the lowest doc_id, then the lowest text
digest; null ids come last. A repeated row is a copy. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doselake.llm.common import (
    among,
    bitmap,
    bits_at,
    discard,
    flagged,
    mixed,
    partitions,
    place,
    shielded,
    slices,
    stored,
    text_key,
    trimmed,
    word_digests,
)

WORDS, THRESHOLD = 2, 0.8
#: With these a pair of Jaccard value 3/7 over labels (0.8 of the words aligned, the others evenly scattered) agrees in
#: a sketch with a chance of (3/7)^3 and is missed with one of 1e-4; of 20 words, the fewest that are not
#: met exactly, 4 changed ones with 2e-3. Fewer labels would let unlike texts meet by the thousand.
SKETCHES, KEPT = 112, 3
#: Remainders of a text at most; with more it has sketches only.
REMAINDERS = 1200
SEEDS = np.random.default_rng(20190705).integers(1, 2**63, SKETCHES, np.uint64) | np.uint64(1)
MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Labels hashed at once, members of a bucket in one tile at most, pairs looked at at once.
LABELS, MEMBERS, PAIRS = 16_384, 256, 4096
#: Classes of words for a first look at two texts, by the first bits of a word's digest.
BINS, CLASS_SHIFT = 512, np.uint64(55)
#: Counters that tell rare words from common ones, and of these in a block.
COUNTERS, COUNTER_BLOCK = 1 << 16, 1024


def sequence(text: str | None) -> np.ndarray:
    """Digests of the words."""
    return word_digests(text)


def labels(d: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Digests of the labelled shingles of a word sequence, in text order."""
    if not len(d):
        return d
    size = min(words, len(d))
    n = len(d) - size + 1
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + d[k : k + n])
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = np.arange(n) - first
    return mixed(h + occurrence * np.uint64(0xD6E8FEB86659FD93))


def smallest(h: np.ndarray) -> np.ndarray:
    """Places of the ``KEPT`` smallest values of each row, or of all."""
    rows = np.arange(len(h))
    out = np.empty((len(h), min(KEPT, h.shape[1])), np.int64)
    values = h.copy()
    for k in range(out.shape[1]):
        out[:, k] = values.argmin(axis=1)
        values[rows, out[:, k]] = np.iinfo(np.uint64).max
    return out


def sketches(label: np.ndarray) -> np.ndarray:
    """One 64-bit value per sketch: its smallest labels in text order; none for no labels."""
    if not len(label):
        return np.empty(0, np.int64)
    least = at = None
    for start in range(0, len(label), LABELS):
        h = label[None, start : start + LABELS] * SEEDS[:, None]
        h ^= h >> np.uint64(29)
        h *= MIX
        few = smallest(h)
        some, h = few + start, np.take_along_axis(h, few, 1)
        if least is not None:
            h, some = np.concatenate([least, h], 1), np.concatenate([at, some], 1)
            few = smallest(h)
            h, some = np.take_along_axis(h, few, 1), np.take_along_axis(some, few, 1)
        least, at = h, some
    value = np.arange(SKETCHES, dtype=np.uint64)
    for x in label[np.sort(at, axis=1)].T:
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + x)
    return value.view(np.int64)


def remainders(d: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """One 64-bit value per way to leave out up to 1 - ``threshold`` of few words; none for many words."""
    n = len(d)
    most = int((1 - threshold) * n + 1e-9)
    # among over REMAINDERS words one left out is too much already; sums over many words have huge terms
    if not n or most and n > REMAINDERS or sum(math.comb(n, k) for k in range(most + 1)) > REMAINDERS:
        return np.empty(0, np.int64)
    words, out = d.tolist(), set()
    for k in range(most + 1):
        for rest in itertools.combinations(words, n - k):
            value = hashlib.blake2b(np.array(rest, np.uint64).tobytes(), digest_size=8, person=b"rest").digest()
            out.add(int.from_bytes(value, "little", signed=True))
    return np.array(sorted(out), np.int64)


def meeting_places(text: str | None, threshold: float = THRESHOLD) -> np.ndarray:
    """Buckets of a text."""
    return buckets_of(sequence(text), threshold)


def buckets_of(d: np.ndarray, threshold: float) -> np.ndarray:
    return np.concatenate([sketches(labels(d)), remainders(d, threshold)])


def aligned(a: list[int], b: list[int], band: int) -> int:
    """Most pairs of equal words in an alignment whose places differ by at most ``band``.

    Bit j of ``open_`` is 0 if the best alignment grows at b's word j; a row of the table is
    one addition. The window of bits moves along with the band.
    """
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    low = high = done = open_ = 0
    for i, x in enumerate(a):
        if i - band > low:
            done += ~open_ & 1 if low < high else 0
            open_ >>= 1
            low += 1
        top = min(len(b), i + band + 1)
        if top > high:
            open_ |= ((1 << (top - high)) - 1) << (high - low)
            high = top
        hit = places.get(x, 0) >> low & open_
        if hit:
            open_ = ((open_ + hit) | (open_ - hit)) & ((1 << (high - low)) - 1)
    return done + (high - low) - open_.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Aligned words / words of the longer text, 0.0 if that can't reach the threshold."""
    most = max(len(a), len(b))
    need = threshold * most - 1e-9
    if not most or min(len(a), len(b)) < need:
        return 0.0
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if np.minimum(n[i], m[j]).sum() < need:
        return 0.0
    # each side leaves at most most - need words out, so no aligned places differ by more
    band = int(most - need) + 1
    return aligned(a.tolist(), b.tolist(), band) / most


def sketched(docs: DataFrame, doc_id: str, text: str, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(key, id, n, sketch): per distinct text its key, its first id, its words, its buckets; and the table it reads.

    Only texts that occur more than once, and those a bitmap takes for such, are shuffled with their buckets.
    """
    rows = docs.select(text_key(text).alias("key"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    copied = bitmap(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")
    shared = docs.sparkSession.sparkContext.broadcast(copied)
    kind = docs.schema[doc_id].dataType.simpleString()

    def sketch(batches):
        for batch in slices(batches):
            words = [sequence(t.as_py()) for t in batch.column(2)]
            made = [buckets_of(d, threshold) for d in words]
            ends = np.cumsum([0, *map(len, made)]).astype(np.int32)
            flat = pa.array(np.concatenate([np.empty(0, np.int64), *made]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(d) for d in words], pa.int32()),
                 pa.ListArray.from_arrays(ends, flat), pa.array(bits_at(shared.value, batch.column(3).to_numpy()))],
                names=["key", "id", "n", "sketch", "copied"],
            )

    schema = f"key binary, id {kind}, n int, sketch array<bigint>, copied boolean"
    made = stored(rows.withColumn("at", place("key")).mapInArrow(trimmed(sketch), schema), "near-sketched")
    several = made.where("copied").groupBy("key")
    several = several.agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    return made.where("not copied").drop("copied").unionByName(stored(several, "near-copied")), made


def sequences(docs: DataFrame, wanted: DataFrame, text: str, copied: np.ndarray) -> tuple[DataFrame, list[DataFrame]]:
    """(key, text) of the wanted keys, and of a few others: texts, which take less room than digests of words; and the
    tables it reads.

    Only texts whose bit is set in ``copied`` may occur more than once and are shuffled for that.
    """
    rows = docs.select(text_key(text).alias("key"), F.col(text).alias("text"))
    rows = flagged(rows, "key", {"wanted": bitmap(wanted, "key"), "copied": copied})
    made = stored(rows.where("wanted").drop("wanted"), "near-sequences")
    several = stored(made.where("copied").drop("copied").dropDuplicates(["key"]), "near-sequences")
    return made.where("not copied").drop("copied").unionByName(several), [made, several]


def verified(pairs: DataFrame, seqs: DataFrame, threshold: float) -> DataFrame:
    """(key, hub, similarity) of all pairs."""
    # of the texts only those of a side are shuffled for it
    hubs = among(seqs, "key", bitmap(pairs, "hub")).select(F.col("key").alias("hub"), F.col("text").alias("hub_text"))
    sides = pairs.join(among(seqs, "key", bitmap(pairs, "key")), "key").join(hubs, "hub")

    def align(batches):
        for batch in slices(batches):
            got = [
                similarity(sequence(a.as_py()), sequence(b.as_py()), threshold)
                for a, b in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(got, pa.float64())],
                names=["key", "hub", "similarity"],
            )

    return sides.select("key", "hub", "text", "hub_text").mapInArrow(
        trimmed(align), "key binary, hub binary, similarity double"
    )


def shared_buckets(rows: DataFrame) -> DataFrame:
    """(bucket, key, n, hub, hub_n, members) of every bucket of two or more of (bucket, key, n)."""
    seen = rows.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    rows = among(rows, "bucket", bitmap(seen, "bucket"))
    hubs = rows.groupBy("bucket").agg(F.min(F.struct("key", "n")).alias("hub"), F.count("*").alias("members"))
    hubs = hubs.where("members > 1")
    hubs = hubs.select("bucket", F.col("hub.key").alias("hub"), F.col("hub.n").alias("hub_n"), "members")
    return rows.join(hubs, "bucket").select("bucket", "key", "n", "hub", "hub_n", "members")


def of_several_roots(rows: DataFrame) -> DataFrame:
    """The rows (bucket, root, ...) of buckets with several roots, and of a few others, without a shuffle of whole rows."""
    roots = rows.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return among(rows, "bucket", bitmap(roots, "bucket"))


def rare_words(crowd: DataFrame, seqs: DataFrame, threshold: float) -> DataFrame:
    """(bucket, key, root, n, bins): other buckets for the members (key, root) of crowded ones: their rarest words.

    Texts that belong together have at least ``threshold`` of the longer one's labelled words in common. So with
    all words in one order, each text's first ``n - ceil(threshold n) + 1`` hold one that is the other's as well. The order is
    that of a table of counters, the rarest first; what texts of a crowd have in common comes last.
    """
    seqs = among(seqs, "key", bitmap(crowd, "key"))
    docs = stored(crowd.join(seqs, "key").select("key", "root", "text"), "near-crowds")

    def count(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for batch in slices(batches):
            for text in batch.column(2):
                counts += np.bincount(labels(sequence(text.as_py()), 1) >> np.uint64(48), minlength=COUNTERS)
        blocks = counts.reshape(-1, COUNTER_BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()), pa.array([b.tobytes() for b in blocks], pa.binary())],
            names=["block", "n"],
        )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(n, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([n.tobytes() for n in sums.values()], pa.binary())],
            names=["block", "n"],
        )

    parts = docs.mapInArrow(count, "block int, n binary").repartition("block").mapInArrow(add, "block int, n binary")
    table = np.zeros((COUNTERS // COUNTER_BLOCK, COUNTER_BLOCK), np.int64)
    for block, n in parts.toLocalIterator():
        table[block] = np.frombuffer(bytes(n), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(table.reshape(-1))

    def rarest(batches):
        for batch in slices(batches):
            held, n, bins = [], [], []
            for text in batch.column(2):
                words = sequence(text.as_py())
                label = labels(words, 1)
                n.append(len(label))
                bins.append(binned(words))
                order = np.lexsort((label, shared.value[label >> np.uint64(48)]))
                held.append(label[order[: len(label) - math.ceil(threshold * len(label) - 1e-9) + 1]].view(np.int64))
            at = np.repeat(np.arange(len(held)), [len(x) for x in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.empty(0, np.int64), *held])), *(batch.column(k).take(pa.array(at)) for k in (0, 1)),
                 pa.array(np.array(n, np.int32)[at]), pa.array(bins, pa.binary()).take(pa.array(at))],
                names=["bucket", "key", "root", "n", "bins"],
            )

    return docs.mapInArrow(rarest, "bucket long, key binary, root binary, n int, bins binary")


def binned(words: np.ndarray) -> bytes:
    """How many words of each class a text has, a byte for each class."""
    return np.minimum(np.bincount(words >> CLASS_SHIFT, minlength=BINS), 255).astype(np.uint8).tobytes()


def with_bins(rows: DataFrame, seqs: DataFrame) -> DataFrame:
    """``rows`` (key, ...) with the classes of their texts' words."""

    def make(batches):
        for batch in slices(batches):
            made = [binned(sequence(text.as_py())) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["key", "bins"])

    seqs = among(seqs, "key", bitmap(rows, "key")).select("key", "text")
    return rows.join(seqs.mapInArrow(trimmed(make), "key binary, bins binary"), "key")


def in_common(a: np.ndarray, b: np.ndarray, more: np.ndarray) -> np.ndarray:
    """How many words the texts of two tables of classes have in common at most; ``more`` of both are not in the tables."""
    return np.minimum(a, b).sum(axis=1, dtype=np.int64) + more


def comparable(sizes, roots, table, first: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Which of the texts may belong together: of other classes, with lengths that allow it and words enough in common.

    The first ``first`` are compared with the others, or all with each other if there are no others.
    """
    if first < len(sizes):
        a, b = np.divmod(np.arange(first * (len(sizes) - first)), len(sizes) - first)
        b += first
    else:
        a, b = np.triu_indices(first, 1)
    need = threshold * np.maximum(sizes[a], sizes[b]) - 1e-9
    open_ = np.flatnonzero((roots[a] != roots[b]) & (np.minimum(sizes[a], sizes[b]) >= need))
    a, b, need = a[open_], b[open_], need[open_]
    more = sizes - table.sum(axis=1, dtype=np.int64)
    kept = np.zeros(len(a), bool)
    for at in range(0, len(a), PAIRS):
        x, y = a[at : at + PAIRS], b[at : at + PAIRS]
        kept[at : at + PAIRS] = in_common(table[x], table[y], np.minimum(more[x], more[y])) >= need[at : at + PAIRS]
    return a[kept], b[kept]


def candidates(rows: DataFrame, threshold: float) -> DataFrame:
    """(key, hub): all pairs that may belong together of members of different classes of one bucket.

    Members (bucket, key, root, n, bins) of a bucket of more than ``MEMBERS`` are cut into tiles of so many, by length; a task
    compares the members of two tiles, or of one. What it compares is classes of words: texts do not travel with their buckets.
    """
    member = F.xxhash64("key")
    buckets = rows.groupBy("bucket").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.count("*").alias("members"),
        F.bit_xor(member).alias("x"),
        F.sum(F.shiftright(member, 20)).alias("s"),
    )
    # of buckets with the same members one
    kept = buckets.where("low <> high").groupBy("members", "x", "s").agg(F.min("bucket").alias("bucket"))
    kept = stored(kept.select("bucket", "members"), "near-open")
    large = bitmap(kept.where(F.col("members") > MEMBERS), "bucket")
    rows = flagged(rows, "bucket", {"kept": bitmap(kept, "bucket"), "large": large}).where("kept").drop("kept")
    whole = rows.where("not large").select(
        "bucket", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(False).alias("second"), "key", "root", "n", "bins"
    )
    held = whole
    if large.any():
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("n", "key")) - 1
        tiled = stored(rows.where("large").withColumn("tile", F.floor(rank / MEMBERS).cast("int")), "near-tiles")
        ends = (F.min("root").alias("low"), F.max("root").alias("high"), F.min("n").alias("least"), F.max("n").alias("most"))
        tiles = tiled.groupBy("bucket", "tile").agg(*ends)
        left = tiles.select("bucket", F.col("tile").alias("i"), F.struct("low", "high", "most").alias("a"))
        right = tiles.select("bucket", F.col("tile").alias("j"), F.struct("low", "high", "least").alias("b"))
        # in order of lengths: not one root in both, and lengths that allow it
        several = (F.col("a.low") != F.col("b.high")) | (F.col("a.high") != F.col("b.low"))
        alike = F.col("a.most") >= threshold * F.col("b.least") - 1e-6
        pairs = left.join(right, "bucket").where(F.col("i") <= F.col("j")).where(several & alike).select("bucket", "i", "j")
        first = pairs.withColumn("tile", F.col("i")).join(tiled, ["bucket", "tile"]).withColumn("second", F.lit(False))
        second = pairs.where("i < j").withColumn("tile", F.col("j")).join(tiled, ["bucket", "tile"])
        held = held.unionByName(first.unionByName(second.withColumn("second", F.lit(True))).select(whole.columns))

    def judge(keys: list, roots: list, sizes: list, tables: list, first: int):
        number: dict[bytes, int] = {}
        roots = np.array([number.setdefault(r, len(number)) for r in roots])
        table = np.frombuffer(b"".join(tables), np.uint8).reshape(-1, BINS)
        a, b = comparable(np.array(sizes, np.int64), roots, table, first, threshold)
        return zip([keys[k] for k in a.tolist()], [keys[k] for k in b.tolist()], strict=True)

    def work(batches):
        last, members, first = None, ([], [], [], []), 0
        out: set[tuple[bytes, bytes]] = set()
        for batch in batches:
            for bucket, i, j, later, *member in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (bucket, i, j) != last:
                    out.update(judge(*members, first))
                    last, members, first = (bucket, i, j), ([], [], [], []), 0
                first += not later
                for held, x in zip(members, member, strict=True):
                    held.append(x)
            if len(out) > PAIRS:
                yield listed(out)
                out = set()
        out.update(judge(*members, first))
        yield listed(out)

    def listed(out) -> pa.RecordBatch:
        pairs = [(min(x), max(x)) for x in out]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in pairs], pa.binary()) for k in (0, 1)], names=["key", "hub"])

    found = (
        held.repartition(partitions(rows.sparkSession), "bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j", "second")
        .mapInArrow(trimmed(work), "key binary, hub binary")
    )
    return stored(found.distinct(), "near-candidates")


def links_in(open_: DataFrame, seqs: DataFrame, threshold: float) -> DataFrame:
    """Links (key, hub, similarity) in buckets (bucket, key, hub) whose components are those of all links in them."""
    sizes = seqs.select("key", "n")
    hubs = sizes.select(F.col("key").alias("hub"), F.col("n").alias("hub_n"))
    members = open_.groupBy("bucket").agg(F.count("*").alias("members"))
    return linked(open_.join(sizes, "key").join(hubs, "hub").join(members, "bucket"), seqs.drop("n"), threshold)[0]


def linked(open_: DataFrame, seqs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links (key, hub, similarity) in buckets (bucket, key, n, hub, hub_n, members) whose components are those of all links
    in them, and (key, root) of these components.

    First every text is compared with one of its hubs, then all members of a bucket with its hub, but for those that
    this has joined already. Buckets whose members that leaves in several
    components are parted by length and their members compared with each other.
    """
    alike = F.least("n", "hub_n") >= threshold * F.greatest("n", "hub_n") - 1e-6
    pairs = open_.where(alike & (F.col("key") != F.col("hub"))).select("key", "hub").distinct()
    pairs = stored(pairs, "near-candidates")
    enough = F.col("similarity") >= threshold - 1e-9
    first = stored(pairs.groupBy("key").agg(F.min("hub").alias("hub")), "near-first")
    found = stored(verified(first, seqs, threshold).where(enough), "near-pairs")
    roots = components(found)
    sides = pairs.join(first, ["key", "hub"], "left_anti").join(roots, "key", "left")
    sides = sides.join(roots.select(F.col("key").alias("hub"), F.col("root").alias("hub_root")), "hub", "left")
    apart = F.coalesce("root", "key") != F.coalesce("hub_root", "hub")
    more = stored(sides.where(apart).select("key", "hub"), "near-more")
    more = stored(verified(more, seqs, threshold).where(enough), "near-pairs")
    found = found.unionByName(more)
    discard(pairs)
    roots = joined(roots, more)
    # two members are a hub and its only other one, already compared
    rooted = open_.where("members > 2").join(roots, "key", "left")
    rooted = stored(rooted.select("bucket", "key", "n", "members", F.coalesce("root", "key").alias("root")), "near-rooted")
    rows = stored(of_several_roots(rooted), "near-open")
    discard(rooted)
    crowded = F.col("members") > MEMBERS
    rest = with_bins(rows.where(~crowded).drop("members"), seqs)
    crowd = stored(rows.where(crowded).select("key", "root").distinct(), "near-crowd")
    if not crowd.isEmpty():
        rest = rest.unionByName(rare_words(crowd, seqs, threshold))
    elif rows.isEmpty():
        return found, roots
    last = candidates(stored(rest, "near-words"), threshold)
    last = stored(verified(last, seqs, threshold).where(enough), "near-pairs")
    return found.unionByName(last), joined(roots, last)


def links_of(docs: DataFrame, doc_id: str, text: str, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(key, id) of all distinct texts, links (key, hub, similarity) that give the classes, (key, root) of texts with links."""
    sketches, made = sketched(docs, doc_id, text, threshold)
    texts = stored(sketches.select("key", "id"), "near-texts")
    open_ = stored(shared_buckets(sketches.select(F.explode("sketch").alias("bucket"), "key", "n")), "near-buckets")
    copied = bitmap(made.where("copied"), "key")
    discard(made)
    seqs, held = sequences(docs, open_, text, copied)
    pair = F.least("key", "hub").alias("key"), F.greatest("key", "hub").alias("hub"), "similarity"
    found, roots = linked(open_, seqs, threshold)
    links = stored(found.select(*pair).dropDuplicates(["key", "hub"]), "near-links")
    for table in (open_, *held):
        discard(table)
    return texts, links, roots


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots``, as of ``components``, after more links: only components that these join are gone through again."""
    ends = links.select("key", "hub").join(roots, "key", "left").select("hub", F.coalesce("root", "key").alias("a"))
    hubs = roots.select(F.col("key").alias("hub"), "root")
    ends = ends.join(hubs, "hub", "left").select(F.col("a").alias("key"), F.coalesce("root", "hub").alias("hub"))
    ends = stored(ends.where("key <> hub").distinct(), "near-ends")
    if ends.isEmpty():
        return roots
    top = components(ends)
    new = top.select("key", F.col("key").alias("root")).join(roots, "key", "left_anti")
    top = top.select(F.col("key").alias("root"), F.col("root").alias("up"))
    after = roots.select("key", "root").unionByName(new).join(top, "root", "left")
    return stored(after.select("key", F.coalesce("up", "root").alias("root")), "near-roots")


def components(links: DataFrame) -> DataFrame:
    """(key, root): the smallest key of each connected component, for keys that have links."""
    edges = links.select(F.col("key").alias("a"), F.col("hub").alias("b"))
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "near-edges")
    roots = stored(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("key"), F.least("a", "m").alias("root")),
        "near-roots",
    )
    table = roots
    while True:
        # the least root among neighbours, then the root of that root: paths halve each round
        near = both.join(roots.select(F.col("key").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("n"))
        better = roots.join(near, F.col("key") == F.col("a")).select(
            "key", F.col("root").alias("old"), F.least("root", "n").alias("root")
        )
        jump = roots.select(F.col("key").alias("root"), F.col("root").alias("up"))
        after = better.join(jump, "root", "left").select(
            "key", "old", F.least("root", F.coalesce("up", "root")).alias("root")
        )
        after = stored(after, "near-roots")
        discard(table)
        table, roots = after, after.select("key", "root")
        if after.where("root <> old").isEmpty():
            discard(both)
            return roots


def classes(docs: DataFrame, doc_id: str, text: str, threshold: float) -> DataFrame:
    """Per distinct text: its class, the id and the text of the class's first document, its links met."""
    texts, links, roots = links_of(docs, doc_id, text, threshold)
    degree = (
        links.select("key")
        .unionAll(links.select(F.col("hub").alias("key")))
        .groupBy("key")
        .agg(F.count("*").alias("n_pairs"))
    )
    named = texts.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    order = F.struct(F.col("id").isNull().alias("no"), F.col("id").alias("id"), F.col("key").alias("key"))
    first = named.groupBy("root").agg(F.min(order).alias("first"))
    return (
        named.join(first, "root")
        .join(degree, "key", "left")
        .select(
            F.col("key").alias("_key"),
            F.col("root").alias("class_key"),
            F.col("first.id").alias("class_id"),
            F.coalesce("n_pairs", F.lit(0)).cast("long").alias("n_pairs"),
            (F.col("first.key") == F.col("key")).alias("_first_text"),
        )
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document: doc_id, class_id (doc_id of the class's first), n_pairs, is_first.

    ``n_pairs`` counts the verified links of the document's text that were met on the way to its class (0: it is
    alone), which are not all links within the class; ``class_key`` names the class
    also where ids repeat.
    """
    named = classes(docs, doc_id, text, threshold)
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("_key"))
    return rows.join(named, "_key").select(
        "doc_id",
        "class_id",
        "class_key",
        "n_pairs",
        (F.col("_first_text") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("is_first"),
    )


@shielded("doc_id", "text")
def keep_first(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with one document of each class, whole rows; of rows repeated in id and text, one."""
    named = classes(docs, doc_id, text, threshold).where("_first_text")
    named = named.select("_key", F.struct(F.col("class_id").alias("id")).alias("_id"))
    rows = docs.withColumns({"_key": text_key(text), "_id": F.struct(F.col(doc_id).alias("id"))})
    kept = rows.join(named, ["_key", "_id"], "left_semi").dropDuplicates(["_key", "_id"])
    return kept.drop("_key", "_id")
