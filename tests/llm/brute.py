"""Plain versions of the training-data operators, and small tables of awkward rows."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def awkward(long: int = 30_000) -> list[tuple]:
    """Nulls, empty and long texts, repeated rows, odd characters, ids that repeat."""
    prose = "The quick brown fox jumps over the lazy dog and runs to the river of the old town. "
    texts = [
        None,
        "",
        " ",
        "\n\t",
        "!!! ### $$$",
        "a",
        prose,
        prose * 8,
        prose * 8,
        "École ÉCOLE été straße ΑΣ İstanbul 你好世界 ½ ² Ⅷ 12 345",
        "x" * 2000,
        "ab" * 1500,
        prose * (long // len(prose)),
        "tail without end " * 3 + "x",
    ]
    rows = [(k, t, "en", "s", len(t) if t is not None else None) for k, t in enumerate(texts)]
    rows += [rows[7], (6, "another text with the id of one before", None, None, 38), (None, "no id", "de", "s", 5)]
    return rows


def empty(spark):
    return spark.createDataFrame([], DOCS)


def odd_columns(df):
    """With extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ("key", "id", "word", "n", "name", "digest", "score", "shard", "size", "spans", "lang_pred")
    return df.select("*", *(F.lit(k).alias(n) for k, n in enumerate(names)))


def own_names(df):
    """With extra columns named as the operators name theirs inside."""
    from pyspark.sql import functions as F

    names = ("_key", "_id", "_text", "_salt", "_place", "_lang", "_h1", "_h2", "_cut", "_spans", "_host", "c0", "c1", "a.b")
    return df.select("*", *(F.lit(k).alias(n) for k, n in enumerate(names)))
