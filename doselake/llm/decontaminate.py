"""Benchmark passages in training documents, found through a positional inverted index.

Test items are cut into windows of ``WINDOW`` consecutive words (a shorter item is one
window). Corpus-wide counts of the test words tell which word of each window is rarest. The
index stores the postings of those words only: document, position and the words
around it. A window's other words are looked up from there, each at its own offset from
the rarest one: all at their offsets is a phrase match, all somewhere within reach a proximity
match. So the work follows the lists of rare words, never those of common ones.

Words are runs of 0-9, a-z (A-Z lowered) and non-ASCII characters. Null and empty
texts and items have no words, hence no windows and no hits. Rows that are repeated, or
share a doc_id, are judged each by its own text. Empty tables give empty results or no hits.
All documents are whole; the test set is the query set, taken in blocks of ``BLOCK_WINDOWS``
windows, so that what is broadcast is bounded. Columns the result adds replace the input's.

Only DataFrame expressions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doselake.llm.common import shielded, stored

WINDOW = 10
#: Windows searched for at once: bounds what is broadcast (some hundred bytes each).
BLOCK_WINDOWS = 100_000
#: What stands between words; the letters that are lowered.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOC = ["_h1", "_h2"]


def lowered(word: Column) -> Column:
    """A-Z lowered. The slow translation only runs on words that lower() would change."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


def raw_words(text: str) -> Column:
    """Words as they stand, with an empty string before a leading and after a trailing gap."""
    return F.split(F.coalesce(F.col(text), F.lit("")), BETWEEN)


def n_words(raw: Column) -> Column:
    empty = (F.element_at(raw, 1) == "").cast("long") + (F.element_at(raw, -1) == "").cast("long")
    return F.greatest(F.size(raw).cast("long") - empty, F.lit(0).cast("long"))


def windows_of(items: DataFrame, item_id: str, text: str, length: int = WINDOW) -> DataFrame:
    """Distinct windows (words, n, item_ids)."""
    words = F.filter(
        F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), BETWEEN), lambda w: w != ""
    )
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - length + 1))
    return (
        items.select(F.col(item_id).cast("string").alias("item_id"), words.alias("words"))
        .where((F.size("words") > 0) & F.col("item_id").isNotNull())
        .select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("words", F.col("start"), F.lit(length)).alias("words"))
        .groupBy("words")
        .agg(F.collect_set("item_id").alias("item_ids"))
        .withColumn("n", F.size("words"))
    )


def postings(docs: DataFrame, terms: DataFrame, text: str, reach: int | None = None) -> DataFrame:
    """(document, word, pos) for every place of a word in ``terms``; with ``reach``, the words around.

    ``around`` starts at ``pos - before`` and spans ``reach`` words to either side.
    ``terms`` is broadcast: callers bound it.
    """
    rows = docs.select(*DOC, raw_words(text).alias("_words"))
    placed = rows.select(
        *DOC,
        "_words",
        (F.element_at("_words", 1) == "").cast("int").alias("_lead"),
        F.posexplode("_words").alias("_at", "_raw"),
    ).withColumn("word", lowered(F.col("_raw")))
    found = placed.join(F.broadcast(terms), "word")
    pos = (F.col("_at") - F.col("_lead")).alias("pos")
    if reach is None:
        return found.select(*DOC, "word", pos)
    first = F.greatest(F.col("_at") - reach, F.col("_lead"))
    around = F.slice("_words", first + 1, F.col("_at") - first + reach + 1)
    return found.select(
        *DOC,
        "word",
        pos,
        (F.col("_at") - first).alias("before"),
        F.transform(around, lowered).alias("around"),
    )


def with_rarest(docs: DataFrame, windows: DataFrame, text: str) -> DataFrame:
    """Windows with their rarest word over all documents and its offset."""
    terms = windows.select(F.explode("words").alias("word")).distinct()
    counts = postings(docs, terms, text).groupBy("word").agg(F.count("*").alias("df"))
    ranked = (
        windows.select("wid", F.posexplode("words").alias("offset", "word"))
        .join(counts, "word", "left")
        .groupBy("wid")
        .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "word", "offset")).alias("r"))
    )
    return windows.join(ranked, "wid").select(
        "wid", "words", "n", "item_ids", F.col("r.word").alias("word"), F.col("r.offset").alias("offset")
    )


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(document, wid, start, n): places where all words stand at their offsets."""
    first = F.col("before") - F.col("offset")
    there = F.slice("around", first + 1, F.col("n"))
    return (
        index.join(F.broadcast(windows), "word")
        .where((first >= 0) & (there == F.col("words")))
        .select(*DOC, "wid", (F.col("pos") - F.col("offset")).alias("start"), "n")
    )


def proximity_matches(index: DataFrame, windows: DataFrame, slop: int) -> DataFrame:
    """(document, wid, pos): places of the rarest word with all others at most ``n - 1 + slop`` away.

    The index must reach that far.
    """
    wide = F.col("n") - 1 + slop
    first = F.greatest(F.col("before") - wide, F.lit(0))
    near = F.slice("around", first + 1, F.col("before") - first + wide + 1)
    return (
        index.join(F.broadcast(windows), "word")
        .where(F.size(F.array_except("words", near)) == 0)
        .select(*DOC, "wid", "pos")
    )


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """With two digests that tell rows apart by doc_id and text."""
    return docs.withColumns(
        {
            "_h1": F.xxhash64(F.col(doc_id), F.col(text)),
            "_h2": F.xxhash64(F.col(text), F.lit(1), F.col(doc_id)),
        }
    )


def blocks_of(windows: DataFrame, size: int) -> list[DataFrame]:
    """Numbered windows in blocks of at most about ``size``."""
    n = windows.count()
    blocks = max(1, -(-n // size))
    numbered = windows.withColumn("wid", F.unhex(F.md5(F.array_join("words", " ").cast("binary"))))
    if blocks == 1:
        return [numbered]
    part = F.pmod(F.xxhash64("words"), F.lit(blocks))
    return [numbered.where(part == k) for k in range(blocks)]


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    length: int = WINDOW,
    block: int = BLOCK_WINDOWS,
) -> tuple[DataFrame, DataFrame]:
    """Keyed documents, and per contaminated document n_hit, n_items and item_ids."""
    docs = keyed(docs, doc_id, text)
    matches = []
    for windows in blocks_of(stored(windows_of(items, item_id, item_text, length), "windows"), block):
        windows = stored(with_rarest(docs, windows, text), "windows-ranked")
        terms = windows.select("word").distinct()
        index = stored(postings(docs, terms, text, reach=length - 1), "postings")
        matches.append(
            phrase_matches(index, windows.drop("item_ids")).join(windows.select("wid", "item_ids"), "wid")
        )
    found = stored(reduce(DataFrame.unionByName, matches), "matches")
    spans = found.select(*DOC, "start", (F.col("start") + F.col("n")).alias("end")).distinct()
    before = Window.partitionBy(*DOC).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    new = F.greatest(F.col("end") - F.greatest(F.col("start"), reached), F.lit(0))
    hits = spans.withColumn("_new", new).groupBy(*DOC).agg(F.sum("_new").alias("n_hit"))
    ids = (
        found.select(*DOC, F.explode("item_ids").alias("item_id"))
        .groupBy(*DOC)
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    return docs, hits.join(ids, DOC)


@shielded("doc_id", "text", made=("n_words", "n_hit", "n_items", "item_ids", "contaminated"))
def decontaminate(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **names
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, item_ids (sorted as strings) and contaminated."""
    rows, hits = find_contamination(docs, items, doc_id, text, **names)
    rows = rows.select(*DOC, *docs.columns, n_words(raw_words(text)).alias("n_words"))
    out = rows.join(hits, DOC, "left")
    return out.select(
        *docs.columns,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
