"""SpotSigs fingerprints: what follows the common words of a text.

Every common word ("the", "der", "de", ...) is an anchor; the anchor and the next
``CHAIN`` content words make one signature. The start of a text counts as an anchor too,
so a text with words has at least one. The fingerprint is the set of signature digests
(32 bits each), sorted and written in base64. Likeness is the Jaccard value of two
sets; sets whose lengths alone rule a wanted floor out are not compared.

Words are runs of 0-9, a-z (A-Z lowered) and non-ASCII characters. Null counts as the
empty text. Texts without words have the empty fingerprint; two empty fingerprints are
alike (1.0), an empty and another one are not (0.0). Equal texts have equal fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doselake.llm.common import partitions, words_of

#: Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    w.encode()
    for w in (
        "a an and are as at be by for from had has have he her his in is it its not of on or she that the "
        "their there they this to was we were which will with you "
        "auf aus bei das dem den der des die ein eine einem einen einer es für ich im ist mit nicht sich sie "
        "und von war wie zu zum zur "
        "au aux avec ce ces dans de des du elle en est et il la le les leur ne nous pas par pour que qui se "
        "sont sur un une vous "
        "al con del el ella en es las lo los más no para pero por que su sus una y"
    ).split()
)
CHAIN = 2
#: Words whose digests a worker remembers at once.
REMEMBERED = 300_000
PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class WordDigests(dict):
    """64-bit digest of a word, lowest bit set for anchors; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little") >> 1 << 1
        self[word] = value = value | (word in ANCHORS)
        return value


_digests = WordDigests()


def signatures(text: str | None) -> np.ndarray:
    """Sorted distinct 32-bit signature digests of a text."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint32)
    d = np.fromiter(map(_digests.__getitem__, words), np.uint64, len(words))
    anchor = (d & np.uint64(1)).astype(bool)
    content = np.flatnonzero(~anchor)
    at = np.concatenate([[-1], np.flatnonzero(anchor)])
    heads = np.concatenate([np.zeros(1, np.uint64), d[anchor]])
    following = np.concatenate([d[content], np.zeros(CHAIN, np.uint64)])
    first = np.searchsorted(content, at, "right")
    mixed = heads * PRIMES[0]
    for k in range(CHAIN):
        mixed = (mixed ^ following[first + k]) * PRIMES[1 + k % 2]
        mixed ^= mixed >> np.uint64(29)
    return np.unique((mixed >> np.uint64(32)).astype(np.uint32))


def encoded(signature: np.ndarray) -> str:
    return base64.b64encode(signature.astype("<u4").tobytes()).decode()


def decoded(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4").astype(np.uint32)


def jaccard(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard value of two sorted sets; 0.0 if their lengths keep it below ``floor``."""
    small, large = sorted((len(a), len(b)))
    if large == 0:
        return 1.0
    if small < floor * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def length_part(n: int, floor: float) -> int:
    """Part of a set of length ``n``; sets two or more parts apart can't reach ``floor``."""
    return 0 if n == 0 else 1 + math.floor(math.log(n) / -math.log(floor))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, text) cut into ranges of doc_id; rows marked ``ghost`` only stand before others.

    Within a partition rows are sorted by (bucket, ghost first, doc_id), and every
    bucket starts with the row before its first one, the last row of all before the first.
    """
    n = partitions(docs.sparkSession)
    low = F.lit(-(2**63)).cast("long")
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), low).alias("_at"),
    )
    cuts = [k / n for k in range(1, n)]
    found = base.agg(F.percentile_approx("_at", cuts, 10_000)).first()[0] or []
    bounds = F.array(*[F.lit(x).cast("long") for x in sorted(set(found))])
    base = base.withColumn(
        "_bucket", F.size(F.filter(bounds, lambda b: b < F.col("_at"))) if found else F.lit(0)
    )
    ends = sorted(base.groupBy("_bucket").agg(F.max("_at")).collect())
    sends = [(ends[i][1], ends[(i + 1) % len(ends)][0]) for i in range(len(ends))]
    copies = F.array(
        F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("ghost")),
    )
    if sends:
        targets = F.create_map(*[F.lit(x).cast("long" if i % 2 == 0 else "int") for p in sends for i, x in enumerate(p)])
        ghost = F.struct(F.element_at(targets, F.col("_at")).alias("bucket"), F.lit(True).alias("ghost"))
        copies = F.when(
            F.map_contains_key(targets, F.col("_at")), F.concat(copies, F.array(ghost))
        ).otherwise(copies)
    spread = base.withColumn("_copy", F.explode(copies)).select(
        "doc_id", "text", "_at", F.col("_copy.bucket").alias("bucket"), F.col("_copy.ghost").alias("ghost")
    )
    return spread.repartitionById(n, F.col("bucket")).sortWithinPartitions(
        "bucket", F.desc("ghost"), "_at", "text"
    )


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of each text, of its edited text, and their likeness.

    The next document is the one with the next lower doc_id, after the lowest the highest;
    rows with one doc_id are ordered by text, null ids are lowest. The edited text has its
    last third replaced by the beginning of the next document.
    """
    id_type = docs.schema[doc_id].dataType

    def compare(batches):
        last: tuple | None = None
        for batch in batches:
            made = []
            rows = zip(
                batch.column("doc_id").to_pylist(),
                batch.column("text").to_pylist(),
                batch.column("ghost").to_pylist(),
                strict=True,
            )
            for key, value, ghost in rows:
                own = signatures(value)
                if not ghost:
                    other, theirs = last
                    cut = len(value) // 3
                    edit = value[: len(value) - cut] + other[:cut]
                    changed = signatures(edit)
                    made.append(
                        (
                            key,
                            len(value),
                            hashlib.sha256(edit.encode("utf-8", "replace")).hexdigest(),
                            encoded(own),
                            encoded(changed),
                            jaccard(own, changed),
                            jaccard(own, theirs),
                        )
                    )
                last = value, own
            if made:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(col), kind)
                        for col, kind in zip(
                            zip(*made, strict=True),
                            (None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()),
                            strict=True,
                        )
                    ],
                    names=[
                        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                        "near_edited", "near_next",
                    ],
                )

    return with_next(docs, doc_id, text).mapInArrow(
        compare,
        f"doc_id {id_type.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
