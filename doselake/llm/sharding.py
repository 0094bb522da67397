"""Shards of near-equal bytes: the minimax contiguous partition of groups of equal texts.

Groups (all rows with one text) stand in the order of their text digest, which has
nothing to do with size or source. Among all ways to cut this sequence into ``n`` runs the
one is taken whose heaviest run is lightest: the smallest capacity for which filling the
shards one after the other, each as far as it goes, reaches the end.

The search needs only prefix sums. The driver knows some of them at any time, at first
the ends of 65,536 digest ranges. Filling from known places only gives a capacity that is
surely enough, filling as if every place were a group's end one that is surely not too
large. While they differ, the ranges the cuts may fall into are split further by one
scan of the stored prefix sums. Driver memory is bounded by the number of ranges, whatever the
number of groups.

Null texts are a group of their own and, like empty ones, have size 1. A group is never cut,
so a text that holds a third of all rows makes one heavy shard. Repeated rows each
get a slot. An empty table gives an empty result. Slots count from 0 within a shard, in the
order of digest, then doc_id. Columns ``size text_crc32 law shard slot grown_shard`` of the
input are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doselake.llm.common import partitions, shielded, stored

LAW = "bytes"
#: Digest ranges known at first, and parts looked at by one scan, whatever the number of groups.
RANGES, SPLIT = 65_536, 131_072


class PrefixSums:
    """What the driver knows of the groups' prefix sums."""

    def __init__(self, ends: np.ndarray, counts: np.ndarray):
        self.ends = np.concatenate([[0], ends]).astype(np.int64)
        #: whether the interval that ends here holds one group
        self.single = np.concatenate([[True], counts == 1])

    @property
    def total(self) -> int:
        return int(self.ends[-1])

    def sure_cuts(self, capacity: int, n: int) -> list[int]:
        """Places filling reaches at least, using known ends only."""
        at, cuts = 0, []
        for _ in range(n):
            at = int(self.ends[np.searchsorted(self.ends, at + capacity, "right") - 1])
            cuts.append(at)
        return cuts

    def best_cuts(self, capacity: int, n: int) -> list[int]:
        """Places filling reaches at most, unknown ends taken to lie anywhere."""
        at, cuts = 0, []
        for _ in range(n):
            at = min(at + capacity, self.total)
            k = int(np.searchsorted(self.ends, at, "right")) - 1
            if at > self.ends[k] and self.single[k + 1]:
                at = int(self.ends[k])
            cuts.append(at)
        return cuts

    def smallest(self, cuts, n: int, low: int) -> int:
        """Smallest capacity for which ``cuts`` reaches the end."""
        high = max(low, self.total)
        while low < high:
            mid = (low + high) // 2
            if cuts(mid, n)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return low

    def open_intervals(self, low: list[int], high: list[int]) -> np.ndarray:
        """Numbers of the intervals of several groups that hold places from low to high."""
        wanted: set[int] = set()
        for a, b in zip(low, high, strict=True):
            i = int(np.searchsorted(self.ends, a, "right"))
            j = int(np.searchsorted(self.ends, b, "left"))
            wanted.update(range(i, min(j, len(self.ends) - 1) + 1))
        rows = np.array(sorted(wanted), np.int64)
        return rows[~self.single[rows]]

    def insert(self, ends: np.ndarray, single: np.ndarray) -> None:
        """Add ends; what is said of an end anew replaces what was."""
        merged, first = np.unique(np.concatenate([ends, self.ends]), return_index=True)
        self.single = np.concatenate([single, self.single])[first]
        self.ends = merged


def split_intervals(groups: DataFrame, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last end of every part of every interval, and whether one group ends there after
    the end before; one scan."""
    parts = max(2, SPLIT // len(low))
    shared = groups.sparkSession.sparkContext.broadcast((low, high))

    def summed(batches):
        low, high = shared.value
        for pdf in batches:
            end = pdf["end"].to_numpy(np.int64)
            k = np.minimum(np.searchsorted(high, end), len(high) - 1)
            inside = (end > low[k]) & (end <= high[k])
            end, k = end[inside], k[inside]
            width = -(-(high[k] - low[k]) // parts)
            part = k * parts + (end - low[k] - 1) // width
            found = pd.DataFrame({"part": part, "end": end}).groupby("part")["end"]
            yield found.agg(first="min", last="max", n="size").reset_index()

    found = (
        groups.where(F.col("end").between(int(low[0]) + 1, int(high[-1])))
        .select("end")
        .mapInPandas(summed, "part long, first long, last long, n long")
        .groupBy("part")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
        .toPandas()
    )
    several = found[found["n"] > 1]
    ends = np.concatenate([found["first"].to_numpy(np.int64), several["last"].to_numpy(np.int64)])
    return ends, np.concatenate([np.ones(len(found), bool), (several["n"] == 2).to_numpy(bool)])


def minimax_cuts(groups: DataFrame, known: PrefixSums, n: int, largest: int) -> list[int]:
    """Where to end each of ``n`` shards; ``groups`` has one row per group with its ``end``."""
    least = max(1, largest, -(-known.total // n))
    while True:
        enough = known.smallest(known.sure_cuts, n, least)
        least = known.smallest(known.best_cuts, n, least)
        low, high = known.sure_cuts(least, n), known.best_cuts(enough, n)
        rows = known.open_intervals(low, high)
        if not len(rows):
            return known.sure_cuts(enough, n)
        known.insert(*split_intervals(groups, known.ends[rows - 1], known.ends[rows]))


@shielded("doc_id", "text", made=("size", "text_crc32", "law", "shard", "slot", "grown_shard"))
def assign_shards(
    docs: DataFrame, n_shards: int = 16, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without its text, with size, text_crc32, law, shard, slot and grown_shard."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c != text]
    value = F.coalesce(F.col(text), F.lit(""))
    rows = stored(
        docs.select(
            *kept,
            (F.octet_length(value) + 1).cast("long").alias("size"),
            F.crc32(value.cast("binary")).alias("text_crc32"),
            F.when(F.col(text).isNull(), F.lit(b"")).otherwise(F.unhex(F.sha2(value.cast("binary"), 256))).alias("_key"),
            # spreads the rows of one text over many tasks
            F.pmod(F.xxhash64(doc_id), F.lit(max(64, partitions(spark)))).cast("int").alias("_salt"),
        ),
        "shard-rows",
    )
    cells = rows.groupBy("_key", "_salt").agg(
        F.count("*").alias("n"), F.first("size").alias("size")
    )
    groups = cells.groupBy("_key").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("bytes")
    )
    head = F.coalesce(F.conv(F.hex(F.substring("_key", 1, 2)), 16, 10).cast("int"), F.lit(0))
    groups = stored(groups.withColumn("_range", head), "shard-groups")
    ranges = (
        groups.groupBy("_range")
        .agg(
            F.sum("bytes").alias("bytes"),
            F.sum("n").alias("rows"),
            F.count("*").alias("groups"),
            F.max("bytes").alias("largest"),
        )
        .toPandas()
        .sort_values("_range")
    )
    ends = ranges["bytes"].to_numpy(np.int64).cumsum()
    offsets = pd.DataFrame(
        {
            "_range": ranges["_range"].astype("int32"),
            "before": ends - ranges["bytes"].to_numpy(np.int64),
            "rows_before": ranges["rows"].to_numpy(np.int64).cumsum() - ranges["rows"].to_numpy(np.int64),
        }
    )
    # one row per digest range: at most RANGES
    offsets = F.broadcast(
        spark.createDataFrame(offsets, "_range int, before long, rows_before long")
    )
    so_far = Window.partitionBy("_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    placed = stored(
        groups.withColumns({"_b": F.sum("bytes").over(so_far), "_n": F.sum("n").over(so_far)})
        .join(offsets, "_range")
        .select(
            "_key",
            (F.col("before") + F.col("_b") - F.col("bytes")).alias("start"),
            (F.col("before") + F.col("_b")).alias("end"),
            (F.col("rows_before") + F.col("_n") - F.col("n")).alias("first_row"),
        ),
        "shard-sums",
    )
    cuts: list[int] = []
    if len(ranges):
        known = PrefixSums(ends, ranges["groups"].to_numpy(np.int64))
        cuts = minimax_cuts(placed, known, n_shards, int(ranges["largest"].max()))
    shard = F.lit(0)
    for cut in cuts[:-1]:
        shard = shard + (F.col("start") >= cut).cast("int")
    placed = placed.withColumn("shard", shard)
    firsts = {r[0]: r[1] for r in placed.groupBy("shard").agg(F.min("first_row")).collect()}
    first = F.lit(0).cast("long")
    for k, row in firsts.items():
        first = F.when(F.col("shard") == k, F.lit(row).cast("long")).otherwise(first)
    before = Window.partitionBy("_key").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "_key", "_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("in_group")
    )
    cells = cells.join(placed, "_key").select(
        "_key", "_salt", "shard", (F.col("first_row") - first + F.col("in_group")).alias("_slot")
    )
    place = F.row_number().over(Window.partitionBy("_key", "_salt").orderBy(doc_id))
    out = rows.withColumn("_place", place).join(cells, ["_key", "_salt"])
    return out.select(
        *kept,
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("_slot") + F.col("_place") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
