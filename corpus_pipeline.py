"""The corpus pipeline: documents in, tokens of clean distinct documents out.

Stages and what they decide:

1. ``language_id`` drops documents without a determinable language and sets ``lang``.
2. ``near_dedup`` keeps one document of every class of near duplicates.
3. ``suffix_dedup`` cuts out every passage of 51 words that also stands elsewhere, then every 400 bytes that do
   in what is left; ``n_chars`` follows.
   Characters cut in part go whole; a document of which no word is left goes.
4. ``decontamination`` drops documents that hold a benchmark passage.
5. ``bpe`` adds ``n_tokens``, ``ids`` and the ``decoded`` text.

Nulls: a null text has no language and goes in the first stage; other columns may be null. Empty
tables pass through empty. Columns beyond those of ``documents`` are carried along.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doselake.llm import bpe, decontaminate, language_id, minhash, suffix_dedup
from doselake.llm.common import stored, table, trimmed
from doselake.llm.queries import PASSAGE, tokenizer_file

#: No SQL: language models, sketches, suffix arrays and merges; tests compare with brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = language_id.load_pieces(tokenizer_file("piece_bpe_32k.model"))
    model = language_id.train(docs, pieces)
    judged = language_id.predict(docs, model)
    known = F.col("lang_pred") != language_id.UNDETERMINED
    return judged.where(known).withColumn("lang", F.col("lang_pred")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = stored(without(docs, suffix_dedup.remove_repeats(docs, n_words=PASSAGE)), "pipeline-passages")
    return without(docs, suffix_dedup.remove_repeats(docs))


def without(docs: DataFrame, made: DataFrame) -> DataFrame:
    """``docs`` after ``remove_repeats`` gave ``made``."""
    names = made.columns

    def whole(batches):
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(names)}
            kept = [k.as_py().decode("utf-8", "ignore") for k in cols["kept"]]
            changed = [n.as_py() > 0 for n in cols["n_removed"]]
            texts = [k if c else t.as_py() for k, c, t in zip(kept, changed, cols["text"], strict=True)]
            cols["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)

    changed = F.col("n_removed") > 0
    out = made.mapInArrow(trimmed(whole), made.schema).where(~changed | F.col("text").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"))
    out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return made.where(~F.col("contaminated")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeats),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every stage's result is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
