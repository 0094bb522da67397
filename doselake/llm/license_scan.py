"""License notices in texts: exact phrases, and blocks that contain a template.

Words are runs of 0-9, a-z (A-Z lowered) and non-ASCII characters. Every run of ``BLOCK`` consecutive words of a
text, or of twice as many words as the template has if that is more, is a block; the text is one if it is shorter. A
block matches a template if it holds at least ``threshold`` of the template's distinct words.
Templates may have any length.

The join is exact and filtered as set-similarity joins are. Template words are put in
order of how many documents of the whole corpus hold them, rarest first. With overlap
``a = ceil(threshold * size)`` needed, a matching block holds one of the first
``size - a + 1`` words (prefix filter), has at least ``a`` distinct words (length filter),
and after its first hit at place ``i`` enough template words remain, ``size - i >= a``
(positional filter). What passes is counted: blocks need to be looked at only where they begin with a word of the
template, and the counts slide from one to the next. Overlapping matches of a template are reported once, by
the best block.

Null and empty texts have no words, no places and no labels. Repeated rows are treated
alike, no row depends on another. Other columns pass through, the result's names replace
columns of the same name.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doselake.llm.common import shielded, words_of

#: Phrases whose exact places are reported, with their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Openings and notices of well-known licenses, with their labels.
TEMPLATES = {
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy "
    "of this software and associated documentation files",
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-notice": "you may not use this file except in compliance with the license you "
    "may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification "
    "are permitted provided that the following conditions are met",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it "
    "under the terms of the gnu general public license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4 0 "
    "international license",
}
THRESHOLD = 0.8
BLOCK = 64
OUT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "blocks",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("label", T.StringType()),
                        T.StructField("first_word", T.LongType()),
                        T.StructField("containment", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]  # rarest first
    need: int
    block: int  # words of a block

    @property
    def prefix(self) -> tuple[bytes, ...]:
        return self.words[: len(self.words) - self.need + 1]


def document_counts(docs: DataFrame, vocabulary: set[bytes], text: str = "text") -> dict:
    """How many rows hold each word of a small vocabulary; no more rows come back than it has words."""

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                seen.update(vocabulary.intersection(words_of(t.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
            names=["word", "n"],
        )

    parts = docs.select(text).mapInArrow(count, "word binary, n long")
    return {bytes(r[0]): r[1] for r in parts.groupBy("word").agg(F.sum("n")).collect()}


def ordered_templates(templates: dict[str, str], counts: dict, threshold: float) -> list[Template]:
    out = []
    for label, phrase in templates.items():
        all_ = words_of(phrase)
        words = sorted(set(all_), key=lambda w: (counts.get(w, 0), w))
        need = max(1, math.ceil(threshold * len(words) - 1e-9))
        out.append(Template(label, tuple(words), need, max(BLOCK, 2 * len(all_))))
    return out


def phrase_places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Starts of all places where the phrase's words stand one after the other."""
    out, at, n = [], -1, len(phrase)
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return out
        if words[at : at + n] == phrase:
            out.append(at)


def matching_blocks(words: list[bytes], templates: list[Template], holders: dict) -> list[tuple]:
    """(label, first word, containment) of the blocks that contain a template, overlapping ones once."""
    hits: dict[int, list[tuple[int, int]]] = {}
    for at, w in enumerate(words):
        for k, place in holders.get(w, ()):
            hits.setdefault(k, []).append((at, place))
    found = []
    for k, places in hits.items():
        t = templates[k]
        prefix = len(t.words) - t.need
        # length filter, on the whole text first
        if len({p for _, p in places}) < t.need:
            continue
        rare = [at for at, p in places if p <= prefix]
        held = [0] * len(t.words)
        distinct = end = r = 0
        best: tuple[float, int] | None = None
        for i, (start, place) in enumerate(places):
            end = max(end, i)
            while end < len(places) and places[end][0] < start + t.block:
                held[places[end][1]] += 1
                distinct += held[places[end][1]] == 1
                end += 1
            while r < len(rare) and rare[r] < start:
                r += 1
            if best and start >= best[1] + t.block:
                found.append((t.label, best[1], best[0]))
                best = None
            near = r < len(rare) and rare[r] < start + t.block  # prefix filter
            if near and end - i >= t.need and distinct >= t.need:
                first = next(p for p, n in enumerate(held) if n)
                if len(t.words) - first >= t.need:  # positional filter
                    share = distinct / len(t.words)
                    best = max(best, (share, start), key=lambda b: (b[0], -b[1])) if best else (share, start)
            held[place] -= 1
            distinct -= held[place] == 0
        if best:
            found.append((t.label, best[1], best[0]))
    return sorted(found, key=lambda b: (b[1], b[0]))


@shielded("text", made=tuple(f.name for f in OUT))
def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    templates: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with word count, phrase places, labels, best containment and matching blocks."""
    templates = TEMPLATES if templates is None else templates
    base = {tuple(words_of(p)): label for p, label in (PHRASES if phrases is None else phrases).items()}
    vocabulary = {w for t in templates.values() for w in words_of(t)}
    order = ordered_templates(templates, document_counts(docs, vocabulary, text), threshold)
    holders: dict[bytes, list[tuple[int, int]]] = {}
    for k, t in enumerate(order):
        for place, w in enumerate(t.words):
            holders.setdefault(w, []).append((k, place))
    rarest = {w for t in order for w in t.prefix}
    openers = {p[0] for p in base}
    kept = docs.columns
    schema = T.StructType([docs.schema[c] for c in kept] + OUT.fields)

    def judge(value: str | None) -> tuple:
        words = words_of(value)
        distinct = set(words)
        places, labels = [], set()
        if not distinct.isdisjoint(openers):
            for phrase, label in base.items():
                if here := phrase_places(words, list(phrase)):
                    places += here
                    labels.add(label)
        blocks = []
        if not distinct.isdisjoint(rarest):
            blocks = matching_blocks(words, order, holders)
        best = max([1.0 if places else 0.0, *(c for _, _, c in blocks)])
        return (
            len(words),
            len(places),
            min(places, default=None),
            max(places, default=None),
            ",".join(sorted(labels)),
            ",".join(sorted(labels | {b[0] for b in blocks})),
            best,
            [{"label": b, "first_word": s, "containment": c} for b, s, c in blocks],
        )

    def scan(batches):
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        block = pa.list_(
            pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("containment", pa.float64())])
        )
        for batch in batches:
            rows = [judge(t.as_py()) for t in batch.column("_text")]
            made = [
                pa.array([r[i] for r in rows], kind) for i, kind in enumerate([*types, block])
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + made, names=schema.names
            )

    return docs.select(*kept, F.col(text).alias("_text")).mapInArrow(scan, schema)
