"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model predicts each byte of a text from the ``ORDER - 1`` bytes before it, one model per language,
trained on the trusted documents of that language. Its numbers come from count
joins: all ``ORDER``-grams are counted over the whole trusted text; the lower orders count in how
many contexts a gram occurs; per context, the grams seen once, twice and more often give the
weight of the next lower order; three discounts per order come from counts of counts.

Documents are kept if their perplexity is at most the ``QUANTILE`` quantile of the trusted documents of
their language. Scoring reads the model from a broadcast while it has at most ``MODEL_ROWS`` rows; a
larger one is joined with the grams of the documents instead, with the same results.

Null and empty texts have no perplexity and are not kept. In a language without trusted
text nothing is known: perplexity and threshold are null and the document is kept. A null language is
a language of its own. A document is trusted if any of its labels says so. Repeated rows are judged
alike; an empty table gives an empty result. Columns the result adds replace the input's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doselake.llm.common import shielded, stored

ORDER, QUANTILE = 4, 0.99
MODEL_ROWS = 6_000_000
#: Bytes counted or scored at once.
BLOCK = 4_000_000
#: Discounts of grams seen once, twice, more often, where counts of counts give none.
PLAIN = (0.5, 0.75, 0.9)
NO_LANG = "\x00"


def gram_codes(texts: list[bytes], order: int) -> np.ndarray:
    """Codes of the grams that end at each byte of each text, zeros before its start."""
    gap = bytes(order - 1)
    raw = np.frombuffer(gap + gap.join(texts), np.uint8).astype(np.int64)
    n = len(raw) - order + 1
    codes = np.zeros(n, np.int64)
    for k in range(order):
        codes = codes << 8 | raw[k : k + n]
    if len(texts) > 1:
        # drop what ends in a gap
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        keep = np.ones(n, bool)
        ends = np.cumsum(lengths + order - 1)[:-1]
        for k in range(order - 1):
            keep[ends - 1 - k] = False
        codes = codes[keep]
    return codes


def blocks(texts: list[str | None], most: int = BLOCK):
    """Positions and bytes of texts in blocks of about ``most`` bytes."""
    rows, held, size = [], [], 0
    for k, t in enumerate(texts):
        raw = (t or "").encode("utf-8", "replace")
        rows.append(k)
        held.append(raw)
        size += len(raw)
        if size >= most:
            yield rows, held
            rows, held, size = [], [], 0
    if rows:
        yield rows, held


def count_grams(rows: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n) over all rows (lang, text)."""

    def emit(lang, grams, n):
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"]
        )

    def work(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                for _, raw in blocks([texts[i] for i in np.flatnonzero(langs == lang)]):
                    yield emit(lang, *np.unique(gram_codes(raw, order), return_counts=True))

    parts = rows.mapInArrow(work, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) from how many grams occur once, twice, three and four times."""
    n = [F.sum((F.col("n") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    made = []
    for k, plain in zip((1, 2, 3), PLAIN, strict=True):
        d = k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
        made.append(F.when(d.isNotNull() & (d > 0) & (d < k), d).otherwise(F.lit(plain)).alias(f"d{k}"))
    return counts.groupBy("lang").agg(*n).select("lang", *made)


def train(trusted: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, n_bytes, gram, logp, log_weight): a row per gram of 0 to ``order`` bytes.

    ``logp`` is the gram's log probability after its first bytes (null for contexts only seen as
    such), ``log_weight`` what is added when a byte after this context was not seen (null if it is no context).
    """
    counts = {order: stored(count_grams(trusted, order), "grams")}
    for k in range(order - 1, 0, -1):
        low = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
        shorter = counts[k + 1].groupBy("lang", low.alias("gram")).agg(F.count("*").alias("n"))
        counts[k] = stored(shorter, "grams")
    probs = counts[1].select("lang").distinct().select(
        "lang", F.lit(0).cast("long").alias("gram"), F.lit(1 / 256).alias("p")
    )
    weights, levels = [], []
    for k in range(1, order + 1):
        context = F.shiftright("gram", 8)
        c = counts[k].join(F.broadcast(discounts(counts[k])), "lang")
        d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        c = c.select("lang", "gram", "n", d.alias("d"), context.alias("context"))
        heads = stored(
            c.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("weight")),
            "contexts",
        )
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)) if k > 1 else F.lit(0).cast("long")
        lower = probs.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
        probs = stored(
            c.withColumn("suffix", suffix)
            .join(heads, ["lang", "context"])
            .join(lower, ["lang", "suffix"])
            .select(
                "lang", "gram", ((F.col("n") - F.col("d")) / F.col("total") + F.col("weight") * F.col("lower")).alias("p")
            ),
            "gram-probs",
        )
        levels.append(probs.select("lang", F.lit(k).alias("n_bytes"), "gram", F.log("p").alias("logp")))
        weights.append(
            heads.select("lang", F.lit(k - 1).alias("n_bytes"), F.col("context").alias("gram"), F.log("weight").alias("log_weight"))
        )
    zero = levels[0].select("lang").distinct().select(
        "lang", F.lit(0).alias("n_bytes"), F.lit(0).cast("long").alias("gram"), F.log(F.lit(1 / 256)).alias("logp")
    )
    model = zero
    for level in levels:
        model = model.unionByName(level)
    contexts = weights[0]
    for w in weights[1:]:
        contexts = contexts.unionByName(w)
    return stored(model.join(contexts, ["lang", "n_bytes", "gram"], "full"), "quality-model")


class Model:
    """Sorted grams of one language per length, for vectorised lookups."""

    def __init__(self, n_bytes: np.ndarray, gram: np.ndarray, logp: np.ndarray, weight: np.ndarray, order: int):
        self.order, self.tables = order, []
        for k in range(order + 1):
            rows = np.flatnonzero(n_bytes == k)
            rows = rows[np.argsort(gram[rows])]
            self.tables.append((gram[rows], logp[rows], weight[rows]))

    def find(self, k: int, codes: np.ndarray, column: int) -> np.ndarray:
        """Values of codes of k bytes, nan where there is none."""
        grams = self.tables[k][0]
        if not len(grams):
            return np.full(len(codes), np.nan)
        at = np.minimum(np.searchsorted(grams, codes), len(grams) - 1)
        return np.where(grams[at] == codes, self.tables[k][column][at], np.nan)

    def logp(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of each gram's last byte after the others."""
        total = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        for k in range(self.order, -1, -1):
            part = codes[open_] & ((1 << 8 * k) - 1)
            got = self.find(k, part, 1)
            seen = ~np.isnan(got)
            total[open_[seen]] += got[seen]
            open_, part = open_[~seen], part[~seen]
            if not len(open_):
                break
            weight = self.find(k - 1, part >> 8, 2)
            total[open_] += np.where(np.isnan(weight), 0.0, weight)
        return total


def model_shards(model: DataFrame) -> dict[str, tuple]:
    """The whole model on the driver; the caller has checked its size."""
    pdf = model.toPandas()
    return {
        lang: (g["n_bytes"].to_numpy(), g["gram"].to_numpy(), g["logp"].to_numpy(float), g["log_weight"].to_numpy(float))
        for lang, g in pdf.groupby("lang")
    }


def scored_by_lookup(docs: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """``docs`` (.., _lang, _text last) with perplexity in place of those two."""
    kept = docs.columns[:-2]
    schema = T.StructType([*(docs.schema[c] for c in kept), docs.schema["_lang"], T.StructField("perplexity", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model_shards(model))

    def work(batches):
        models: dict[str, Model] = {}
        for batch in batches:
            langs = np.array(batch.column(len(kept)).to_pylist(), object)
            texts = batch.column(len(kept) + 1).to_pylist()
            out: list[float | None] = [None] * len(texts)
            for lang in sorted(set(langs) & set(shared.value)):
                if lang not in models:
                    models[lang] = Model(*shared.value[lang], order)
                mine = [i for i in np.flatnonzero(langs == lang) if texts[i]]
                for rows, raw in blocks([texts[i] for i in mine], BLOCK // 4):
                    logs = models[lang].logp(gram_codes(raw, order))
                    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
                    sums = np.add.reduceat(logs, np.cumsum(lengths) - lengths)
                    for k, value in zip(rows, np.exp(-sums / lengths).tolist(), strict=True):
                        out[mine[k]] = value
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(kept) + 1)] + [pa.array(out, pa.float64())], names=schema.names
            )

    return docs.mapInArrow(work, schema)


def scored_by_join(docs: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """The same for a model too large to broadcast: distinct grams of each document meet the model in joins."""
    kept = docs.columns[:-2]
    # a row's number must not change if the row is read again
    numbered = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "quality-rows")

    def grams(batches):
        for batch in batches:
            for row, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                codes, n = np.unique(gram_codes([text.encode("utf-8", "replace")], order), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(codes), pa.int64()), pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)],
                    names=["_row", "lang", "code", "n"],
                )

    texts = numbered.where(F.length("_text") > 0).select("_row", "_lang", "_text")
    open_ = texts.mapInArrow(grams, "_row long, lang string, code long, n long").withColumn("logp", F.lit(0.0))
    open_ = open_.join(model.select("lang").distinct(), "lang", "left_semi")
    sums = None
    for k in range(order, -1, -1):
        mask = F.lit((1 << 8 * k) - 1)
        level = model.where((F.col("n_bytes") == k) & F.col("logp").isNotNull())
        level = level.select("lang", F.col("gram").alias("g"), F.col("logp").alias("got"))
        met = open_.withColumn("g", F.col("code").bitwiseAND(mask)).join(level, ["lang", "g"], "left")
        done = met.where(F.col("got").isNotNull()).groupBy("_row").agg(
            F.sum(F.col("n") * (F.col("logp") + F.col("got"))).alias("s"), F.sum("n").alias("n")
        )
        sums = done if sums is None else sums.unionByName(done)
        if k:
            heads = model.where((F.col("n_bytes") == k - 1) & F.col("log_weight").isNotNull())
            heads = heads.select("lang", F.col("gram").alias("h"), "log_weight")
            open_ = met.where(F.col("got").isNull()).withColumn("h", F.shiftright("g", 8)).join(heads, ["lang", "h"], "left")
            open_ = open_.select(
                "_row", "lang", "code", "n", (F.col("logp") + F.coalesce("log_weight", F.lit(0.0))).alias("logp")
            )
    per_row = sums.groupBy("_row").agg(F.exp(-F.sum("s") / F.sum("n")).alias("perplexity"))
    return numbered.join(per_row, "_row", "left").select(*kept, "_lang", "perplexity")


@shielded("doc_id", "text", "lang", made=("perplexity", "threshold", "keep"))
def judge_quality(
    docs: DataFrame,
    trusted_ids: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    quantile: float = QUANTILE,
    order: int = ORDER,
    model_rows: int = MODEL_ROWS,
) -> DataFrame:
    """``docs`` without text, with perplexity, threshold and keep; ``trusted_ids`` has ids of trusted documents."""
    kept = [c for c in docs.columns if c != text]
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("_id")).distinct()
    name = F.coalesce(F.col(lang), F.lit(NO_LANG))
    rows = docs.select(F.col(doc_id).alias("_id"), name.alias("lang"), F.col(text).alias("text"))
    # the ids grow with the documents: the same join at every size
    trusted = rows.where(F.length("text") > 0).join(ids.hint("merge"), "_id", "left_semi")
    trusted = trusted.select("lang", "text")
    model = train(trusted, order)
    score = scored_by_lookup if model.count() <= model_rows else scored_by_join
    scores = score(docs.select(*kept, name.alias("_lang"), F.col(text).alias("_text")), model, order)
    scores = stored(scores, "quality-scores")
    known = model.select(F.col("lang").alias("_lang")).distinct().withColumn("_known", F.lit(True))
    # one row per language
    limits = (
        scores.join(ids, F.col(doc_id) == F.col("_id"), "left_semi")
        .groupBy("_lang")
        .agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))
        .join(known, "_lang", "full")
    )
    return scores.join(limits, "_lang", "left").select(
        *kept,
        "perplexity",
        "threshold",
        F.when(F.col("_known").isNull(), True)
        .otherwise(F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))
        .alias("keep"),
    )
