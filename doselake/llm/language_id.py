"""Language identification by unigram pieces, summed over all segmentations.

Every language has a probability for each piece of a fixed public vocabulary. A word's
probability is the sum over all ways to cut it into pieces of the product of their
probabilities; a forward pass along the word computes it without listing them. A
text's score in a language is the sum of its words' log probabilities, the language with the
highest one is predicted, and its share among all languages is the score.

Training counts the words of each language over all training rows and runs a few rounds
of expectation maximisation over the distinct words: a forward and a backward pass give
how often each piece is expected to occur, tasks add these up per language and piece.
Models have (languages x pieces) numbers, whatever the size of the corpus.

Texts are lower-cased; words are runs of letters and marks, of any length. Where probabilities of a word become too
small for plain numbers, because it is long or has many letters outside the vocabulary, the passes run over
their logarithms. Null texts and texts without a letter are ``und`` with score
0, as is everything if there is nothing to learn from. Ties go to the first language in
alphabetical order. Repeated rows are judged alike. Training rows with a null text or null
language are left out. Other columns pass through; ``lang_pred`` and ``score`` are replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doselake.llm.common import shielded, slices, stored, trimmed

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Letters of the longest piece, first letter of a word's first piece.
PIECE, HEAD = 12, "▁"
#: Words of more letters, or of a smaller probability, are passed over in logarithms; letters of a block of words.
LONG, TINY, CELLS = 200, 1e-250, 200_000
#: Rounds of expectation maximisation, count added to each piece, probability of a letter outside the vocabulary.
ROUNDS, ADDED, OUTSIDE = 2, 0.1, 1e-9
UNDETERMINED = "und"
#: Distinct words a task remembers the score of, and those it counts before it emits them: memory, not results.
REMEMBERED, COUNTED = 300_000, 200_000
BASE = np.uint64(0x100000001B3)


def load_pieces(path: str) -> list[str]:
    """Pieces of a public vocabulary that are made of letters, lower-cased."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(
        p for p in found if len(p) <= PIECE and WORD.fullmatch(p.removeprefix(HEAD)) is not None
    )


def words_of(text: str | None) -> list[str]:
    """Words of a text."""
    return WORD.findall(text.lower()) if text else []


class Lattice:
    """The pieces found in words, looked up for many words at once."""

    def __init__(self, pieces: list[str]):
        width = max(map(len, pieces), default=1)
        digests = [self._digest(p) for p in pieces]
        order = np.argsort(np.array(digests, np.uint64), kind="stable")
        self.digests = np.array(digests, np.uint64)[order]
        self.ids, self.width = order.astype(np.int64), width
        self.filter = np.zeros(1 << 20, bool)
        self.filter[self._mixed(self.digests) >> np.uint64(44)] = True

    @staticmethod
    def _mixed(x: np.ndarray) -> np.ndarray:
        return x * np.uint64(0x9E3779B97F4A7C15)

    @staticmethod
    def _digest(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def edges(self, words: list[str]):
        """(length, widths, ids): ids[k] maps (word, start) to the piece of k + 1 letters there, or -1."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        most = int(lengths.max())
        codes = np.zeros((len(words), most), np.uint64)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32)
        inside = np.arange(most) < lengths[:, None]
        codes[inside] = flat.astype(np.uint64) + np.uint64(1)
        found = []
        rolling = np.zeros_like(codes)
        for k in range(min(self.width, most)):
            span = most - k
            rolling = rolling[:, :span] * BASE + codes[:, k:]
            ids = np.full((len(words), span), -1, np.int64)
            ok = inside[:, k:] & self.filter[self._mixed(rolling) >> np.uint64(44)]
            r, c = np.nonzero(ok)
            if len(r):
                want = rolling[r, c]
                at = np.minimum(np.searchsorted(self.digests, want), len(self.digests) - 1)
                hit = self.digests[at] == want
                ids[r[hit], c[hit]] = self.ids[at[hit]]
            found.append(ids)
        return lengths, found

    def forward(self, lengths, found, probs: np.ndarray) -> np.ndarray:
        """alpha[language, word, place]: probability of the letters up to a place, all segmentations."""
        n, most = found[0].shape
        alpha = np.zeros((len(probs), n, most + 1))
        alpha[:, :, 0] = 1.0
        for end in range(1, most + 1):
            alpha[:, :, end] = alpha[:, :, end - 1] * OUTSIDE
            for k in range(min(len(found), end)):
                start = end - k - 1
                ids = found[k][:, start]
                rows = np.flatnonzero(ids >= 0)
                if len(rows):
                    alpha[:, rows, end] += alpha[:, rows, start] * probs[:, ids[rows]]
        return alpha

    def backward(self, lengths, found, probs: np.ndarray) -> np.ndarray:
        n, most = found[0].shape
        beta = np.zeros((len(probs), n, most + 1))
        beta[:, np.arange(n), lengths] = 1.0
        for start in range(most - 1, -1, -1):
            open_ = lengths > start
            beta[:, open_, start] = beta[:, open_, start + 1] * OUTSIDE
            for k in range(min(len(found), most - start)):
                ids = found[k][:, start]
                rows = np.flatnonzero(ids >= 0)
                if len(rows):
                    beta[:, rows, start] += beta[:, rows, start + k + 1] * probs[:, ids[rows]]
        return beta

    def log_probs(self, words: list[str], probs: np.ndarray) -> np.ndarray:
        """[word, language] log probabilities."""
        out = np.empty((len(words), len(probs)))
        for rows in by_length(words) if len(probs) else ():
            if len(words[rows[0]]) > LONG:
                rest = rows
            else:
                lengths, found = self.edges([words[i] for i in rows])
                alpha = self.forward(lengths, found, probs)[:, np.arange(len(rows)), lengths]
                small = alpha.min(axis=0) < TINY
                out[rows[~small]] = np.log(alpha[:, ~small]).T
                rest = rows[small]
            for row in rest.tolist():
                out[row] = self.log_pass(self.pieces_at(words[row]), len(words[row]), np.log(probs))[:, -1]
        return out

    def pieces_at(self, word: str) -> list[list[tuple[int, int]]]:
        """(start, piece) of the pieces that end before each place of a word."""
        _, found = self.edges([word])
        out: list[list[tuple[int, int]]] = [[] for _ in range(len(word) + 1)]
        for k, ids in enumerate(found):
            for start in np.flatnonzero(ids[0] >= 0).tolist():
                out[start + k + 1].append((start, int(ids[0, start])))
        return out

    @staticmethod
    def log_pass(ends: list[list[tuple[int, int]]], n: int, logs: np.ndarray) -> np.ndarray:
        """[language, place]: log probability of the letters up to a place, all segmentations."""
        alpha = np.zeros((len(logs), n + 1))
        outside = np.log(OUTSIDE)
        for end in range(1, n + 1):
            ways = [alpha[:, end - 1] + outside, *(alpha[:, start] + logs[:, piece] for start, piece in ends[end])]
            alpha[:, end] = np.logaddexp.reduce(ways)
        return alpha

    def log_expected(self, word: str, logs: np.ndarray, total: np.ndarray, count: float) -> None:
        """Add the expected uses of pieces in one word that occurs ``count`` times; one language."""
        n, ends = len(word), self.pieces_at(word)
        begins: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for end, pieces in enumerate(ends):
            for start, piece in pieces:
                begins[n - start].append((n - end, piece))
        alpha, beta = self.log_pass(ends, n, logs)[0], self.log_pass(begins, n, logs)[0][::-1]
        for end, pieces in enumerate(ends):
            for start, piece in pieces:
                total[piece] += count * np.exp(alpha[start] + logs[0, piece] + beta[end] - alpha[n])

    def expected(self, words: list[str], counts: np.ndarray, probs: np.ndarray, n_pieces: int) -> np.ndarray:
        """Expected number of uses of each piece in words that occur ``counts`` times; one language."""
        total = np.zeros(n_pieces)
        for rows in by_length(words):
            if len(words[rows[0]]) > LONG:
                for row in rows.tolist():
                    self.log_expected(words[row], np.log(probs), total, counts[row])
                continue
            lengths, found = self.edges([words[i] for i in rows])
            alpha = self.forward(lengths, found, probs)[0]
            beta = self.backward(lengths, found, probs)[0]
            whole = alpha[np.arange(len(rows)), lengths]
            small = whole < TINY
            for row in rows[small].tolist():
                self.log_expected(words[row], np.log(probs), total, counts[row])
            weight = np.where(small, 0.0, counts[rows] / np.where(small, 1.0, whole))
            for k, ids in enumerate(found):
                r, c = np.nonzero(ids >= 0)
                p = ids[r, c]
                use = alpha[r, c] * probs[0, p] * beta[r, c + k + 1] * weight[r]
                total += np.bincount(p, use, n_pieces)
        return total


def by_length(words: list[str], most: int = 4096):
    """Row numbers in blocks of words of similar length, long ones apart, of a bounded number of letters."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    at, short = 0, int(np.count_nonzero(lengths <= LONG))
    while at < len(order):
        end = min(at + most, short if at < short else len(order))
        while end > at + 1 and (end - at) * lengths[order[end - 1]] > CELLS:
            end = at + (end - at + 1) // 2
        yield order[at:end]
        at = end


@dataclass
class LanguageModel:
    langs: list[str]
    pieces: list[str]
    probs: np.ndarray  # [language, piece]


def count_words(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, word, n) over all rows."""

    def emit(seen: dict[str, Counter]):
        for name, words in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(words), pa.string()), pa.array([HEAD + w for w in words], pa.string()),
                 pa.array(list(words.values()), pa.int64())],
                names=["lang", "word", "n"],
            )

    def count(batches):
        seen: dict[str, Counter] = {}
        for batch in slices(batches):
            for value, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.setdefault(name, Counter()).update(words_of(value))
                if sum(map(len, seen.values())) > COUNTED:
                    yield from emit(seen)
                    seen = {}
        yield from emit(seen)

    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, lang)
    parts = rows.mapInArrow(trimmed(count), "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, pieces: list[str], text: str = "text", lang: str = "lang") -> LanguageModel:
    """Piece probabilities of every language in ``lang``."""
    words = stored(count_words(docs, text, lang), "language-words")
    langs = sorted(r[0] for r in words.select("lang").distinct().collect())
    probs = np.full((len(langs), len(pieces)), 1.0 / max(1, len(pieces)))
    number = {name: k for k, name in enumerate(langs)}
    for _ in range(ROUNDS if langs else 0):
        shared = words.sparkSession.sparkContext.broadcast((pieces, probs, number))

        def expect(batches, shared=shared):
            pieces, probs, number = shared.value
            lattice, total = Lattice(pieces), {}
            for batch in batches:
                names = np.array(batch.column(0).to_pylist(), object)
                texts, n = batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(float)
                for name in set(names):
                    rows = np.flatnonzero(names == name)
                    k = number[name]
                    got = lattice.expected([texts[i] for i in rows], n[rows], probs[k : k + 1], len(pieces))
                    total[k] = total.get(k, 0) + got
            for k, got in total.items():
                used = np.flatnonzero(got)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)), pa.array(got[used])],
                    names=["lang", "piece", "n"],
                )

        parts = words.mapInArrow(trimmed(expect), "lang int, piece int, n double")
        # languages x pieces rows at most
        got = parts.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros_like(probs)
        counts[got["lang"], got["piece"]] = got["n"]
        counts += ADDED
        probs = counts / counts.sum(axis=1, keepdims=True)
    return LanguageModel(langs, pieces, probs)


class Scorer:
    """Scores texts; remembers the log probabilities of a bounded number of words."""

    def __init__(self, model: LanguageModel):
        self.model, self.lattice = model, Lattice(model.pieces)
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.model.langs)))

    def learn(self, new: list[str]) -> None:
        at, end = len(self.rows), len(self.rows) + len(new)
        if end > len(self.table):
            # twice as long, so that what is there is copied now and then only
            more = max(end, 2 * len(self.table)) - at
            self.table = np.concatenate([self.table[:at], np.zeros((more, self.table.shape[1]))])
        self.table[at:end] = self.lattice.log_probs([HEAD + w for w in new], self.model.probs)
        self.rows.update(zip(new, range(at, end), strict=True))

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        split = [words_of(t) for t in texts] if self.model.langs else [[]] * len(texts)
        new = set().union(*split).difference(self.rows)
        if len(self.rows) + len(new) > REMEMBERED:
            self.forget()
            new = set().union(*split)
        self.learn(sorted(new))
        out = []
        for words in split:
            if not words:
                out.append((UNDETERMINED, 0.0))
                continue
            rows = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
            logs = self.table[rows].sum(axis=0)
            best = int(np.argmax(logs))
            out.append((self.model.langs[best], float(1.0 / np.exp(logs - logs[best]).sum())))
        return out


@shielded("text", made=("lang_pred", "score"))
def predict(docs: DataFrame, model: LanguageModel, text: str = "text", batch_chars: int = 2_000_000) -> DataFrame:
    """``docs`` with lang_pred and score."""
    kept = docs.columns
    # the text is sent once, with the columns that pass through
    place = kept.index(text)
    schema = T.StructType(
        [docs.schema[c] for c in kept]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            at, n, texts = 0, batch.num_rows, batch.column(place)
            while at < n:
                part, size, end = [], 0, at
                while end < n and (size < batch_chars or end == at):
                    part.append(texts[end].as_py())
                    size += len(part[-1] or "")
                    end += 1
                rows = scorer.score(part)
                piece = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(i) for i in range(len(kept))]
                    + [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())],
                    names=schema.names,
                )
                at = end

    return docs.mapInArrow(trimmed(work), schema)
