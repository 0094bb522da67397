"""Helpers the training-data operators share."""

from __future__ import annotations

import ctypes
import functools
import inspect
import mmap
import tempfile
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doselake.session import work_dir

#: Byte map for words: A-Z lower-cased, ASCII outside 0-9 and a-z to spaces,
#: bytes of other characters kept.
WORD_BYTES = bytes(
    b + 32
    if 0x41 <= b <= 0x5A
    else b
    if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8: runs of digits, a-z (A-Z lowered) and non-ASCII."""
    raw = (text or "").encode("utf-8", "replace").translate(WORD_BYTES)
    return raw.split()


#: Base of the digests of words, odd; powers of it and of its inverse, as many as were needed so far.
PRIME = 0x9E3779B97F4A7C15
INVERSE = pow(PRIME, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of an odd number, modulo 2^64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        # what long texts need is not kept
        if n <= 1 << 20:
            _powers[base] = held
    return held[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def span_digests(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit digests of parts of a text, the same wherever they stand."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(PRIME, len(raw)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(INVERSE, len(raw))[starts]
    return mixed(h + (ends - starts).astype(np.uint64))


def word_digests(text: str | None) -> np.ndarray:
    """64-bit digests of the words of a text, in order."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace").translate(WORD_BYTES), np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], raw != 0x20, [False]]).astype(np.int8)))
    return span_digests(raw, edge[::2], edge[1::2]) if len(edge) else np.empty(0, np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Empty a table that ``stored`` wrote and that nothing reads any more."""
    files = df.inputFiles()
    if files:
        nothing = df.sparkSession.createDataFrame([], df.schema)
        nothing.write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])


#: Bits of a bitmap of values, 2 to this power (16 MB), and of one of its blocks.
BITS, BLOCK_BITS = 27, 1 << 15


def trimmed(work: Callable) -> Callable:
    """``work`` on Arrow batches, after which its worker gives back the memory that it has no more use for.

    Workers are kept for other tasks, several to a task where such steps follow one another, and else keep it as well.
    """

    @functools.wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            # of the GNU C library; others have no such function
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def place(column: str) -> Column:
    """Where the bit of a column's value is in a bitmap."""
    return F.pmod(F.xxhash64(column), F.lit(1 << BITS))


def bits_at(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The bits of a map, which may be a folded one."""
    at = places & (8 * len(bits) - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """A bit for every value of a column, in a map of bounded size, however many values there are.

    While at most one bit in 32 is set the map is folded in half: small maps are quicker to send and to look into.
    """
    at = place(column) + 1
    bits = rows.select(F.bitmap_bucket_number(at).alias("block"), F.bitmap_bit_position(at).alias("at"))
    out = np.zeros((1 << BITS >> 15, BLOCK_BITS >> 3), np.uint8)
    # as large as the map at most, and one job instead of one a partition
    for block, part in bits.groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits")).collect():
        out[block - 1] = np.frombuffer(bytes(part), np.uint8)
    out = out.reshape(-1)
    while len(out) > BLOCK_BITS >> 3 and 32 * int(np.bitwise_count(out).sum()) <= 4 * len(out):
        half = len(out) // 2
        out = out[:half] | out[half:]
    return out


def marked(rows: DataFrame, column: str, bits: np.ndarray, flag: str) -> DataFrame:
    """``rows`` with a flag: whether the bit of a column's value is set. Of other values one may have the same bit."""
    return flagged(rows, column, {flag: bits})


def flagged(rows: DataFrame, column: str, maps: dict[str, np.ndarray]) -> DataFrame:
    """``rows`` with a flag of each of the maps, as ``marked`` gives it, in one step."""
    shared = rows.sparkSession.sparkContext.broadcast(list(maps.values()))
    names = [*rows.columns, *maps]

    def look(batches):
        for batch in batches:
            places = batch.column(batch.num_columns - 1).to_numpy()
            there = [pa.array(bits_at(bits, places)) for bits in shared.value]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *there], names=names)

    schema = T.StructType([*rows.schema.fields, *(T.StructField(flag, T.BooleanType()) for flag in maps)])
    return rows.withColumn(next(iter(maps)), place(column)).mapInArrow(trimmed(look), schema)


def among(rows: DataFrame, column: str, bits: np.ndarray) -> DataFrame:
    """The rows for which ``marked`` is true: a filter before a shuffle, not instead of a join."""
    return marked(rows, column, bits, "_there").where("_there").drop("_there")


def slices(batches, rows: int = 500):
    """Arrow batches in pieces of at most so many rows: texts as Python objects take several times their size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns named by their places, which no name of the user's can clash with."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns))))


def shielded(*columns: str, made: tuple[str, ...] = ()) -> Callable:
    """Lets an operator see its table's columns by place, so that names it uses itself can't clash with the user's.

    ``columns`` are its parameters that name columns. Columns it adds, ``made``, replace the user's of the same name.
    """

    def wrap(operator):
        signature = inspect.signature(operator)

        @functools.wraps(operator)
        def run(docs: DataFrame, *args, **kwargs):
            bound = signature.bind(docs, *args, **kwargs)
            bound.apply_defaults()
            places = {name: f"c{k}" for k, name in enumerate(docs.columns)}
            bound.arguments |= {c: places[bound.arguments[c]] for c in columns}
            bound.arguments[next(iter(signature.parameters))] = numbered(docs)
            out = operator(*bound.args, **bound.kwargs)
            names = {place: name for name, place in places.items() if name.lower() not in made}
            kept = [c for c in out.columns if c in names or c not in places.values()]
            return out.select(*(F.col(c).alias(names.get(c, c)) for c in kept))

        return run

    return wrap


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: str = "text") -> Column:
    """16-byte digest of a text; the empty text and null share one."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


class Mapped:
    """Bytes laid in an unnamed temporary file and mapped, so that a worker pages in what it reads.

    The file has no name once open, so nothing stays behind in an executor's folder.
    """

    def __init__(self, blob: bytes):
        file = tempfile.TemporaryFile()
        file.write(blob)
        file.flush()
        self.file = file
        self.view = memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
