"""Byte-pair encoding with a transducer lexicon, and decoding.

The frequent words of the corpus are compiled into a minimal acyclic automaton: words
share prefixes and, by merging equal states bottom up, suffixes. Every transition carries
how many words come before those it leads to, so the sum along a path numbers the word,
and the number finds its token ids in a table beside the automaton. Both are one file, which Spark hands to every
executor once and all tasks there map into memory; they walk all new words of a batch at once. Words it lacks
are merged exactly, lowest merge rank first, all new ones of a batch in the same rounds (``merging``).

Text is treated as the tokenizer file says: special tokens are cut out of the raw text,
the rest is put in NFC and lower case, and split into contractions, runs of letters, single
digits and runs of other signs; white space is dropped. Decoding joins the tokens
of the ids by a space, as a file without decoder asks.

Null counts as the empty text: no tokens, empty strings. Rows do not depend on each other;
repeated rows are encoded alike, an empty table gives an empty result. Long texts cost
time in proportion; a worker remembers a bounded number of chunks of text, and when that is reached those it met more than once. Columns ``n_tokens ids decoded`` of the
input are replaced, all others are carried along, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import tempfile
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doselake.llm.common import numbered, slices, stored, trimmed
from doselake.llm.merging import Memory, Merges, spans, strings

#: Words of the lexicon at most, bytes of its longest word.
LEXICON_WORDS, LONGEST = 100_000, 32
#: Chunks a worker remembers at most, with so many letters and ids in all; signs of a batch of texts.
REMEMBERED, REMEMBERED_ROOM, BATCH = 200_000, 4_000_000, 500_000
#: Distinct chunks a task counts before it passes them on.
COUNTED = 200_000
#: White space that str.split() takes for such and the tokenizer does not.
ODD_SPACE = regex.compile(r"[\x1c-\x1f]")
SPACE = regex.compile(r"\p{White_Space}+")


def laid(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(all parts one after the other, where each starts and the last ends)."""
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])


@dataclass
class Rules:
    """What a tokenizer file of this kind says, as tasks need it. Symbols are token ids."""

    pattern: str
    special: dict[str, int]
    inner: np.ndarray  # symbol of each byte, of the last byte of a word
    last: np.ndarray
    merges: Merges
    n_tokens: int
    tokens: tuple[np.ndarray, np.ndarray]  # text of every token and a space
    numbers: tuple[np.ndarray, np.ndarray]  # every id in decimal and a space

    @classmethod
    def load(cls, path: str) -> Rules:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        suffix = model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        texts = {i: t for t, i in (model["vocab"] | special).items()}
        n = max(texts, default=-1) + 1
        # what is no token itself gets a symbol beyond them, and is left out in the end
        symbols = dict(model["vocab"])

        def symbol(part: str) -> int:
            return symbols.setdefault(part, n + len(symbols))

        table = {}
        for rank, (left, right) in enumerate(model["merges"]):
            table.setdefault((symbol(left) << 32) + symbol(right), (symbol(left + right), rank))
        signs = byte_signs()
        return cls(
            split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"),
            special,
            np.array([symbol(s) for s in signs], np.int64),
            np.array([symbol(s + suffix) for s in signs], np.int64),
            Merges.of(table),
            n,
            laid([(texts.get(i, "") + " ").encode() for i in range(n)]),
            laid([b"%d " % i for i in range(n)]),
        )

    def __post_init__(self):
        self.lines = regex.compile(self.pattern + r"|\n")

    def words(self, chunks: list[str]) -> tuple[list[str], list[int]]:
        """(words of pieces of text without white space and special tokens, one after the other; number of each piece)."""
        # a line each: nothing in the pattern or the forms of letters reaches over the end of a line
        text = "\n".join(chunks)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        found = self.lines.findall(text.lower())
        ends = [k for k, w in enumerate(found) if w == "\n"] + [len(found)]
        counts = [b - a - 1 for a, b in zip([-1, *ends[:-1]], ends, strict=True)]
        return [w for w in found if w != "\n"], counts if chunks else []

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all words one after the other, number of ids of each)."""
        flat = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        symbol = self.inner[flat]
        symbol[ends - 1] = self.last[flat[ends - 1]]
        opens = np.zeros(len(flat), bool)
        opens[ends - lengths] = True
        place = self.merges.rounds(symbol, opens)
        place = place[symbol[place] < self.n_tokens]
        word = np.searchsorted(ends, place, side="right")
        return symbol[place].astype(np.int32), np.bincount(word, minlength=len(words))

    def written(self, table: tuple[np.ndarray, np.ndarray], ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
        """The parts of ``table`` that ``ids`` name, row by row, without the space at the end."""
        data, starts = table
        sizes = np.diff(starts)[ids]
        ends = np.cumsum(lengths)[lengths > 0]
        sizes[ends - 1] -= 1
        upto = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(lengths)])]
        return strings(data[spans(starts[ids], sizes)], np.diff(upto), pa.string())


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@dataclass
class Lexicon:
    """A minimal acyclic automaton over bytes that numbers its words, with token ids for each number."""

    blob: bytes | None
    n_moves: int
    n_states: int
    n_words: int
    n_ids: int
    file: str = ""
    opened: bool = field(default=False, repr=False)

    @classmethod
    def compile(cls, words: list[bytes], ids: dict[bytes, list[int]]) -> Lexicon:
        """``words`` sorted and distinct."""
        # Suffixes are shared as soon as no later word can extend them.
        registry: dict[tuple, int] = {}
        final, moves = [], []  # of finished states; moves: ((byte, state), ...)

        def finish(is_final: bool, out: list[tuple[int, int]]) -> int:
            shape = (is_final, *out)
            if (state := registry.get(shape)) is None:
                state = registry[shape] = len(final)
                final.append(is_final)
                moves.append(out)
            return state

        path: list[list] = [[False, []]]  # open states of the current word
        last = b""
        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            for k in range(len(last), shared, -1):
                state = finish(*path.pop())
                path[-1][1].append((last[k - 1], state))
            path += [[False, []] for _ in word[shared:]]
            path[-1][0] = True
            last = word
        for k in range(len(last), 0, -1):
            state = finish(*path.pop())
            path[-1][1].append((last[k - 1], state))
        root = finish(*path.pop())
        # States are finished after all they lead to, so one pass counts the words below.
        below = [0] * len(final)
        keys, to, skipped = [], [], []
        for state, out in enumerate(moves):
            n = int(final[state])
            for byte, target in out:
                keys.append(state * 256 + byte)
                to.append(target)
                skipped.append(n)
                n += below[target]
            below[state] = n
        assert root == len(final) - 1 and below[root] == len(words)
        starts = np.zeros(len(words) + 1, np.int64)
        np.cumsum([len(ids[w]) for w in words], out=starts[1:])
        flat = [i for w in words for i in ids[w]]
        blob = b"".join(
            np.array(x, kind).tobytes()
            for x, kind in (
                (keys, np.int64), (starts, np.int64), (to, np.int32), (skipped, np.int32),
                (flat, np.int32), (final, np.uint8),
            )
        )
        return cls(blob, len(keys), len(final), len(words), len(flat))

    def shared(self, spark: SparkSession) -> Lexicon:
        """The same as a file that every executor fetches once; what travels to tasks is its name."""
        name = f"lexicon-{hashlib.sha256(self.blob).hexdigest()[:32]}"
        folder = os.path.join(tempfile.gettempdir(), f"doselake-{os.getpid()}")
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, name)
        if not os.path.exists(path):
            with open(path, "wb") as out:
                out.write(self.blob)
        spark.sparkContext.addFile(path)
        return Lexicon(None, self.n_moves, self.n_states, self.n_words, self.n_ids, name)

    def open(self) -> Lexicon:
        if not self.opened:
            if self.blob is None:
                with open(SparkFiles.get(self.file), "rb") as file:
                    view = memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
            else:
                view = memoryview(self.blob)
            at = 0
            for name, kind, n in (
                ("keys", np.int64, self.n_moves), ("starts", np.int64, self.n_words + 1),
                ("to", np.int32, self.n_moves), ("skipped", np.int32, self.n_moves),
                ("ids", np.int32, self.n_ids), ("final", np.uint8, self.n_states),
            ):
                setattr(self, name, np.frombuffer(view, kind, n, at))
                at += n * np.dtype(kind).itemsize
            self.opened = True
        return self

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 for words the automaton does not accept."""
        out = np.full(len(words), -1, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        rows = np.flatnonzero(lengths <= LONGEST)
        if not self.n_moves or not len(rows):
            return out
        sizes = lengths[rows]
        letters = np.zeros((len(rows), LONGEST), np.uint8)
        flat = np.frombuffer(b"".join([words[row] for row in rows.tolist()]), np.uint8)
        letters.reshape(-1)[spans(np.arange(len(rows)) * LONGEST, sizes)] = flat
        state = np.full(len(rows), self.n_states - 1, np.int64)
        number = np.zeros(len(rows), np.int64)
        alive = np.arange(len(rows))
        for k in range(LONGEST + 1):
            ended = lengths[rows[alive]] == k
            done = alive[ended]
            good = done[self.final[state[done]] == 1]
            out[rows[good]] = number[good]
            alive = alive[~ended]
            if not len(alive):
                break
            key = state[alive] * 256 + letters[alive, k]
            at = np.minimum(np.searchsorted(self.keys, key), self.n_moves - 1)
            ok = self.keys[at] == key
            alive, at = alive[ok], at[ok]
            state[alive] = self.to[at]
            number[alive] += self.skipped[at]
        return out

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.starts[number] : self.starts[number + 1]].tolist()


class Encoder:
    """Encodes batches of texts; each chunk without white space once, while it is remembered."""

    def __init__(self, rules: Rules, lexicon: Lexicon):
        self.rules, self.lexicon = rules, lexicon.open()
        self.cut = regex.compile("(" + "|".join(map(regex.escape, rules.special)) + ")")
        self.memory = Memory(REMEMBERED, REMEMBERED_ROOM)
        self.begin()

    def begin(self) -> None:
        memory, special = self.memory, self.rules.special
        memory.forget()
        for text in special:
            memory.known[text]
        memory.add(np.array(list(special.values()), np.int32), np.ones(len(special), np.int64), 0)
        self.fresh()

    def fresh(self) -> None:
        """From now on it counts how often chunks are met."""
        self.met = np.zeros(self.memory.words, np.int64)

    def tidy(self) -> None:
        """Forget chunks met once since the last time, or all if that leaves too many."""
        memory, kept = self.memory, len(self.rules.special)
        chunks = list(memory.known)
        often = np.flatnonzero(self.met[: len(chunks)] > 1)
        often = often[often >= kept]
        sizes = memory.sizes[often]
        ids = memory.ids[spans(memory.starts[often], sizes)]
        self.begin()
        words = [chunks[k] for k in often.tolist()]
        letters = sum(map(len, words))
        if len(words) <= memory.words // 2 and letters + len(ids) <= memory.room // 2:
            for word in words:
                memory.known[word]
            memory.add(ids, sizes, letters)

    def split(self, text: str) -> list[str]:
        special = self.rules.special
        if any(t in text for t in special):
            return [c for p in self.cut.split(text) for c in ([p] if p in special else spaced(p))]
        return spaced(text)

    def learn(self, new: list[str]) -> None:
        """Encode chunks not seen before: their words by the lexicon, the rest by merging."""
        words, n_words = self.rules.words(new)
        distinct = list(dict.fromkeys(words))
        place = dict(zip(distinct, range(len(distinct)), strict=True))
        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        distinct = encoded(distinct)
        number = self.lexicon.numbers(distinct)
        held, other = np.flatnonzero(number >= 0), np.flatnonzero(number < 0)
        starts, sizes = (np.zeros(len(distinct), np.int64) for _ in range(2))
        first = self.lexicon.starts[number[held]]
        sizes[held] = self.lexicon.starts[number[held] + 1] - first
        known = self.lexicon.ids[spans(first, sizes[held])]
        starts[held] = np.cumsum(sizes[held]) - sizes[held]
        merged = np.empty(0, np.int32)
        if len(other):
            merged, sizes[other] = self.rules.merge([distinct[k] for k in other.tolist()])
            starts[other] = len(known) + np.cumsum(sizes[other]) - sizes[other]
        ids = np.concatenate([known, merged])[spans(starts[at], sizes[at])]
        upto = np.concatenate([[0], np.cumsum(sizes[at])])
        counts = np.diff(upto[np.cumsum([0, *n_words])])
        self.memory.add(ids, counts, sum(map(len, new)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        if self.memory.full():
            self.tidy()
        chunks, counts = [], []
        for text in texts:
            parts = self.split(text)
            chunks += parts
            counts.append(len(parts))
        known = self.memory.known
        new = [c for c in dict.fromkeys(chunks) if c not in known]
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        numbers = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
        if new:
            self.learn(new)
        if len(known) > len(self.met):
            self.met = np.concatenate([self.met, np.zeros(len(known) - len(self.met), np.int64)])
        self.met[: len(known)] += np.bincount(numbers, minlength=len(known))
        return self.memory.gather(numbers, counts)


def encoded(words: list[str]) -> list[bytes]:
    """The words, none of which holds an end of line, in UTF-8."""
    return "\n".join(words).encode("utf-8", "replace").split(b"\n") if words else []


def spaced(text: str) -> list[str]:
    """Chunks between white space."""
    if ODD_SPACE.search(text):
        return [c for c in SPACE.split(text) if c]
    return text.split()


#: The encoder of the lexicon that tasks of this worker used last: it remembers beyond a task.
_last: dict[str, Encoder] = {}


def encoder_of(rules: Rules, lexicon: Lexicon) -> Encoder:
    if lexicon.file not in _last:
        _last.clear()
        _last[lexicon.file] = Encoder(rules, lexicon)
    return _last[lexicon.file]


def count_words(docs: DataFrame, rules: Rules, text: str = "text") -> DataFrame:
    """How often each word occurs in the whole corpus (word binary, n long)."""
    shared = docs.sparkSession.sparkContext.broadcast(rules)

    def emit(chunks: Counter):
        words: dict[str, int] = {}
        found, n_words = shared.value.words(list(chunks))
        for w, n in zip(found, np.repeat(np.fromiter(chunks.values(), np.int64, len(chunks)), n_words).tolist(), strict=True):
            words[w] = words.get(w, 0) + n
        made = pa.array(encoded(list(words)), pa.binary())
        short = pa.array(np.fromiter(map(len, made.to_pylist()), np.int64, len(made)) <= LONGEST)
        counts = pa.array(words.values(), pa.int64())
        yield pa.RecordBatch.from_arrays([made.filter(short), counts.filter(short)], names=["word", "n"])

    def count(batches):
        seen: Counter = Counter()
        for batch in slices(batches):
            for value in batch.column(0).to_pylist():
                seen.update(spaced(value or ""))
                if len(seen) > COUNTED:
                    yield from emit(seen)
                    seen = Counter()
        yield from emit(seen)

    parts = docs.select(text).mapInArrow(trimmed(count), "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(
    docs: DataFrame, rules: Rules, text: str = "text", most: int = LEXICON_WORDS
) -> Lexicon:
    """The lexicon of the most frequent words, ``most`` of them or as many as the next lower count allows.

    Counts cover all rows. The driver gets a histogram of counts and then the chosen words.
    """
    counts = stored(count_words(docs, rules, text), "word-counts")
    # steps of about one percent: a few thousand at any size
    step = F.floor(F.log2("n") * 64).cast("int")
    steps = sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect(), reverse=True)
    least, total = None, 0
    for number, words in steps:
        total += words
        if total > most:
            break
        least = number
    top = counts.where(step >= least).select("word").collect() if least is not None else []
    words = sorted(bytes(r[0]) for r in top)
    ids, sizes = rules.merge(words) if words else ([], [])
    ends = np.cumsum([0, *sizes]).tolist()
    return Lexicon.compile(words, {w: ids[ends[k] : ends[k + 1]].tolist() for k, w in enumerate(words)})


def encode_decode(
    docs: DataFrame, rules: Rules, lexicon: Lexicon, text: str = "text", batch_chars: int = BATCH
) -> DataFrame:
    """``docs`` with n_tokens, ids (decimal, joined by one space) and the decoded text."""
    made = T.StructType().add("n_tokens", "long").add("ids", "string").add("decoded", "string")
    names = [c for c in docs.columns if c.lower() not in ("n_tokens", "ids", "decoded")]
    schema = T.StructType([docs.schema[c] for c in names] + made.fields)
    kept, source = [docs.columns.index(c) for c in names], docs.columns.index(text)
    spark = docs.sparkSession
    shared, lexicon = spark.sparkContext.broadcast(rules), lexicon.shared(spark)

    def work(batches):
        rules = shared.value
        encoder = encoder_of(rules, lexicon)
        for batch in batches:
            texts, at = batch.column(source), 0
            while at < batch.num_rows:
                part, size, end = [], 0, at
                while end < batch.num_rows and (size < batch_chars or end == at):
                    part.append(texts[end].as_py() or "")
                    size += len(part[-1])
                    end += 1
                ids, lengths = encoder.encode(part)
                columns = [
                    pa.array(lengths, pa.int64()),
                    rules.written(rules.numbers, ids, lengths),
                    rules.written(rules.tokens, ids, lengths),
                ]
                piece = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([*(piece.column(k) for k in kept), *columns], names=schema.names)
                at = end

    return numbered(docs).mapInArrow(trimmed(work), schema)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Count, compile and encode in one call."""
    rules = Rules.load(path)
    return encode_decode(docs, rules, build_lexicon(docs, rules, text), text)
