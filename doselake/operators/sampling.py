"""Weighted sampling over integer ranges.

Items of a dimension share the line of integers ``[0, total)``: each owns a range
as long as its weight, and a draw modulo ``total`` falls into exactly one. The
line is cut into equal cells, so that a draw needs only the few items of its cell.

Small dimensions become literal arrays and the lookup is plain arithmetic inside
the projection. Any other dimension is an equi-join on the cell, with about two
candidates per draw on average whatever the weights are. Cells are equally
likely, so that join key is not skewed even if one item has most of the weight.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from doselake.functions.draws import digit, int_div
from doselake.operators.lookup import first_names, fits_broadcast, size_of
from doselake.operators.profile import ITEMS
from doselake.sources.months import as_label

#: Fourth attribute, filled for municipalities: the name of their state.
STATE_NAME = "item_4"


def _bigint(n: int) -> Column:
    return F.lit(n).cast("bigint")


def ranges(weights: DataFrame, items: Sequence[str] = ITEMS) -> DataFrame:
    """Add ``lo, hi, total, n_items`` per dimension. Items lie in hash order.

    The running sum has two levels, within and across 4096 hash groups, so that
    no task sorts a whole dimension.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in items])
    hashed = (
        weights.where(F.col("weight") > 0)
        .withColumn("_hash", F.md5(text))
        .withColumn("_group", F.substring("_hash", 1, 3))
    )
    within = Window.partitionBy("dimension", "_group").orderBy("_hash")
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    group = hashed.groupBy("dimension", "_group").agg(
        F.sum("weight").alias("_w"), F.count(F.lit(1)).alias("_n")
    )
    whole = Window.partitionBy("dimension")
    before = whole.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = group.select(
        "dimension",
        "_group",
        F.coalesce(F.sum("_w").over(before), _bigint(0)).alias("_before"),
        F.sum("_w").over(whole).alias("total"),
        F.sum("_n").over(whole).alias("n_items"),
    )
    hi = F.col("_before") + F.sum("weight").over(upto)
    return (
        hashed.join(offsets, ["dimension", "_group"])
        .withColumn("hi", hi)
        .withColumn("lo", F.col("hi") - F.col("weight"))
        .drop("_hash", "_group", "_before")
    )


def cells(ranged: DataFrame) -> DataFrame:
    """One row per cell and item whose range reaches into it."""
    width = int_div(F.col("total") + F.col("n_items") - 1, F.col("n_items"))
    first, last = int_div(F.col("lo"), F.col("width")), int_div(F.col("hi") - 1, F.col("width"))
    return ranged.withColumn("width", width).withColumn("cell", F.explode(F.sequence(first, last)))


def with_state_names(weights: DataFrame) -> DataFrame:
    """Give municipalities the name of their state: first name per code, unknown is ``""``."""
    order = F.col("ordinal") if "ordinal" in weights.columns else -F.col("weight")
    states = weights.where(F.col("dimension") == "uf").select(
        "item_1", "item_2", F.struct(order.alias("o"), "item_2").alias("_order")
    )
    names = first_names(states, "item_1", "item_2", "_order").select(
        F.lit("municipio").alias("dimension"),
        F.col("item_1").alias("item_3"),
        F.col("item_2").alias(STATE_NAME),
    )
    return weights.join(names, ["dimension", "item_3"], "left").withColumn(
        STATE_NAME, F.coalesce(STATE_NAME, F.lit(""))
    )


#: Bounds of a dimension kept as literal arrays, and of its items per cell.
INLINE_ROWS, INLINE_BYTES, INLINE_DEPTH = 8192, 1024 * 1024, 16
_SEPARATOR = "\x1f"
#: Stands for null in literal arrays.
_NULL = "\x1e"


def _constant(values: Sequence, kind: str) -> Column:
    """An array literal from one string, folded to a constant when the query is planned."""
    array = F.split(F.lit(_SEPARATOR.join(str(v) for v in values)), _SEPARATOR)
    return array if kind == "string" else array.cast(f"array<{kind}>")


@dataclass(frozen=True)
class Inline:
    """A small dimension: upper range ends, items, and the first item of each cell."""

    total: int
    width: int
    depth: int  # most items in one cell
    ends: list[int]
    starts: list[int]
    items: Mapping[str, list[str | None]]

    @staticmethod
    def of(rows: Sequence) -> Inline | None:
        """From all rows of a dimension; None if some cell holds too many items."""
        rows = sorted(rows, key=lambda r: r["hi"])
        ends = [r["hi"] for r in rows]
        total = ends[-1]
        width = max(1, total // (8 * len(ends)))
        starts = [bisect_right(ends, at) for at in range(0, total, width)]
        beyond = starts[1:] + [len(ends) - 1]
        depth = max(b - a + 1 for a, b in zip(starts, beyond, strict=True))
        items = {c: [r[c] for r in rows] for c in (*ITEMS, STATE_NAME)}
        marks = (_SEPARATOR, _NULL)
        clash = any(m in (v or "") for values in items.values() for v in values for m in marks)
        if depth > INLINE_DEPTH or clash:
            return None
        return Inline(total, width, depth, ends, starts, items)

    # The lookup has three steps, one projection each: later steps use the result
    # of an earlier one several times, and a merged expression would repeat it.

    def position(self, draw: str) -> Column:
        """The draw's place on the line."""
        return digit(F.col(draw), self.total)

    def first(self, x: Column) -> Column:
        """The first item of the cell of ``x``."""
        cell = int_div(x, _bigint(self.width)).cast("int")
        return F.get(_constant(self.starts, "int"), cell)

    def index(self, x: Column, first: Column) -> Column:
        """The item of ``x``. Ends rise, so it is as many items on as ends are passed."""
        ends = _constant(self.ends, "bigint")
        steps = [
            F.when(x >= F.get(ends, first + k), 1).otherwise(0) for k in range(self.depth - 1)
        ]
        return sum(steps, first)

    def item(self, name: str, index: Column) -> Column:
        values = self.items[name]
        found = F.get(_constant([_NULL if v is None else v for v in values], "string"), index)
        return F.nullif(found, F.lit(_NULL)) if None in values else found


@dataclass(frozen=True)
class Sampler:
    """Weight tables prepared for sampling, stored as Parquet by dimension."""

    spark: SparkSession
    path: str
    stats: Mapping[str, tuple[int, int, int, int]]  # total, cell width, rows, bytes
    inline: Mapping[str, Inline]

    @staticmethod
    def prepare(weights: DataFrame, path: str, inline_rows: int = INLINE_ROWS) -> Sampler:
        """Write the cell table to ``path``; read back totals, and the items of small dimensions."""
        spark = weights.sparkSession
        prepared = cells(ranges(with_state_names(weights)))
        (
            prepared.select("dimension", "cell", "lo", "hi", *ITEMS, STATE_NAME, "total", "width")
            .hint("rebalance", "dimension")
            .write.mode("overwrite")
            .partitionBy("dimension")
            .parquet(path)
        )
        stored = spark.read.parquet(path)
        totals = stored.groupBy("dimension").agg(
            F.max("total").alias("total"),
            F.max("width").alias("width"),
            *size_of(stored),
        )
        stats = {name: tuple(measured) for name, *measured in totals.collect()}
        small = [
            name
            for name, (_, _, rows, size) in stats.items()
            if rows <= inline_rows and size <= INLINE_BYTES
        ]
        items: dict[str, list] = {}
        # measured above: a bounded number of rows per dimension
        first_cells = stored.where(F.col("dimension").isin(small)).where(
            F.col("cell") == int_div(F.col("lo"), F.col("width"))
        )
        for row in first_cells.collect():
            items.setdefault(row["dimension"], []).append(row)
        made = {name: Inline.of(rows) for name, rows in items.items()}
        return Sampler(spark, path, stats, {n: i for n, i in made.items() if i is not None})

    def joins(self, picks: Iterable[str]) -> bool:
        """Whether picking from these dimensions joins a table, which may deal rows out anew."""
        return any(d in self.stats and d not in self.inline for d in picks)

    def pick(self, df: DataFrame, picks: Mapping[str, Mapping[str, str]]) -> DataFrame:
        """Add columns of the items hit by the draw columns ``d_<dimension>``.

        ``picks`` maps a dimension to ``{item: output column}``. Literal arrays
        and joins give the same items, nulls included; a dimension without weights
        gives nulls. A joined table is broadcast if its
        measured size is small, otherwise both sides are shuffled on the evenly
        spread cell.
        """
        inline = {d: self.inline[d] for d in picks if d in self.inline}
        x, at = {d: f"_x_{d}" for d in picks}, {d: f"_at_{d}" for d in picks}
        df = df.withColumns({x[d]: i.position(f"d_{d}") for d, i in inline.items()})
        df = df.withColumns({at[d]: i.first(F.col(x[d])) for d, i in inline.items()})
        df = df.withColumns({at[d]: i.index(F.col(x[d]), F.col(at[d])) for d, i in inline.items()})
        df = df.withColumns(
            {
                out: i.item(item, F.col(at[d]))
                for d, i in inline.items()
                for item, out in picks[d].items()
            }
        ).drop(*x.values(), *at.values())
        for d in picks:
            if d not in inline:
                df = self._join(df, d, picks[d])
        return df

    def _join(self, df: DataFrame, dimension: str, names: Mapping[str, str]) -> DataFrame:
        if dimension not in self.stats:
            return df.withColumns({out: F.lit(None).cast("string") for out in names.values()})
        total, width, rows, size = self.stats[dimension]
        x, cell, lo, hi = "_x", "_cell", "_lo", "_hi"
        table = (
            self.spark.read.parquet(self.path)
            .where(F.col("dimension") == dimension)
            .select(
                F.col("cell").alias(cell),
                F.col("lo").alias(lo),
                F.col("hi").alias(hi),
                *[F.col(item).alias(out) for item, out in names.items()],
            )
        )
        if fits_broadcast(rows, size):
            table = F.broadcast(table)
        drawn = df.withColumn(x, digit(F.col(f"d_{dimension}"), total)).withColumn(
            cell, int_div(F.col(x), _bigint(width))
        )
        hit = (F.col(x) >= F.col(lo)) & (F.col(x) < F.col(hi))
        return drawn.join(table, cell).where(hit).drop(x, cell, lo, hi)


# ---- dates -------------------------------------------------------------------


def month_calendar(spark: SparkSession, months: Iterable[int | str]) -> DataFrame:
    """One row per month: ``year_month`` and its week days and weekend days as arrays."""
    labels = sorted({as_label(m) for m in months})
    rows = spark.createDataFrame([(m,) for m in labels], "year_month string")
    first = F.to_date(F.concat("year_month", F.lit("-01")))
    days = F.sequence(first, F.last_day(first))
    return rows.select(
        "year_month",
        F.filter(days, lambda d: F.weekday(d) < 5).alias("week_days"),
        F.filter(days, lambda d: F.weekday(d) >= 5).alias("weekend_days"),
    )


def _by_class(d: Column, weekend_weight: Column, week_weight: Column) -> Column:
    """A day, given the weight of a single weekend day and of a single week day."""
    week, weekend = F.col("week_days"), F.col("weekend_days")
    w, k = F.size(weekend).cast("bigint"), F.size(week).cast("bigint")
    x = F.pmod(d, w * weekend_weight + k * week_weight)
    in_weekend = x < w * weekend_weight
    i = int_div(x, weekend_weight)
    j = int_div(x - w * weekend_weight, week_weight)
    return F.when(in_weekend, F.get(weekend, i.cast("int"))).otherwise(F.get(week, j.cast("int")))


def biased_day(d: Column) -> Column:
    """A day of the month, a week day three times as likely as a weekend day (0.18 : 0.06).

    Needs the columns of ``month_calendar``.
    """
    return _by_class(d, _bigint(1), _bigint(3))


def resampled_day(d: Column) -> Column:
    """The variant that draws any day and moves 88 % of weekend draws to a week day.

    With W weekend and K week days its exact odds are 12K for each weekend day
    and 100K + 88W for each week day.
    """
    w = F.size("weekend_days").cast("bigint")
    k = F.size("week_days").cast("bigint")
    return _by_class(d, 12 * k, 100 * k + 88 * w)
