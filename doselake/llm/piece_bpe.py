"""SentencePiece encoding by vectorised merge rounds, and decoding.

Text becomes pieces as the sentencepiece library makes them from a BPE model with byte fallback: white
space is kept as a mark, one mark is put in front, and of all neighbours that form a piece of the vocabulary the
best ranked are merged first, leftmost first. No piece holds a mark after another sign, or a line break next to
anything, so a text falls apart there into words that are merged on their own.

New words of a batch are merged together: their signs lie in one flat array, cut into segments where two signs
stand next to each other in no piece. Each round finds the least pair rank of every segment, merges all pairs
of that rank from the left, and closes up the array; segments without a pair leave it. Merging several pairs at
once differs from one at a time only if a merge makes a pair that ranks before the next of them; where
that happens, a segment merges its leftmost pair alone in this round. So ids are always those of the library.
Workers remember words they merged, bounded by number and bytes.

Null counts as the empty text: begin and end ids only. Rows do not depend on each other; repeated rows are encoded
alike, an empty table gives an empty result. Long texts are taken one at a time, in memory in proportion to their
length. Columns ``n_tokens ids decoded`` of the input are replaced, all others are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from doselake.llm.common import numbered
from doselake.llm.merging import Memory, Merges, found, spans, strings

MARK = "▁"
#: Words a task remembers at most, with so many letters and ids in all; signs of a batch of texts.
REMEMBERED, REMEMBERED_ROOM, BATCH = 250_000, 4_000_000, 1_000_000
NORMAL, BYTE, SILENT = 0, 1, 2
#: What a text falls into: marks with what follows them, or a line break with what follows it.
WORD = re.compile(r" +[^ \n]*|\n[^ \n]*")
#: Checks that a model leaves text as it is but for marks.
PROBE = "  Aﬁ\t½  é　Ａ \n "


@dataclass
class Pieces:
    """A vocabulary as arrays. Symbols are piece ids, then signs without a piece of their own, then code points."""

    letters: np.ndarray  # code points of the signs in pieces, sorted
    letter_symbols: np.ndarray
    merges: Merges
    touching: np.ndarray  # signs next to each other in some piece, left * 2^32 + right, sorted
    loose: np.ndarray  # code points of the symbols that are no pieces
    n_pieces: int
    surfaces: np.ndarray  # text of all pieces, one after the other
    surface_starts: np.ndarray
    kinds: np.ndarray
    byte_ids: np.ndarray
    begin: int
    end: int
    cut_marks: bool
    cut_breaks: bool

    @classmethod
    def load(cls, path: str) -> Pieces:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(PROBE) != MARK + PROBE.replace(" ", MARK):
            raise ValueError("only models that leave text as it is, with one mark in front, are supported")
        n = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(n)]
        kinds = np.array(
            [
                BYTE if model.is_byte(i) else SILENT if model.is_control(i) or model.is_unknown(i) else NORMAL
                for i in range(n)
            ],
            np.int8,
        )
        byte_ids = np.full(256, -1, np.int32)
        for i in np.flatnonzero(kinds == BYTE).tolist():
            byte_ids[int(names[i][3:5], 16)] = i
        if (byte_ids < 0).any():
            raise ValueError("only models with byte fallback are supported")
        normal = [i for i in range(n) if kinds[i] == NORMAL and not model.is_unused(i)]
        symbols = {names[i]: i for i in normal}
        loose = sorted({c for p in symbols for c in p} - symbols.keys())
        symbols |= {c: n + k for k, c in enumerate(loose)}
        _, order = np.unique([-model.get_score(i) for i in normal], return_inverse=True)
        pairs, touching = {}, set()
        for i, rank in zip(normal, order.tolist(), strict=True):
            piece = names[i]
            for k in range(1, len(piece)):
                touching.add((ord(piece[k - 1]) << 32) + ord(piece[k]))
                left, right = symbols.get(piece[:k]), symbols.get(piece[k:])
                if left is not None and right is not None:
                    pairs[(left << 32) + right] = i, rank
        letters = sorted((ord(s), i) for s, i in symbols.items() if len(s) == 1)
        surface = [
            bytes([int(name[3:5], 16)]) if kind == BYTE else b"" if kind == SILENT else name.replace(MARK, " ").encode()
            for name, kind in zip(names, kinds.tolist(), strict=True)
        ]
        return cls(
            np.array([c for c, _ in letters], np.int64),
            np.array([i for _, i in letters], np.int64),
            Merges.of(pairs),
            np.array(sorted(touching), np.int64),
            np.array([ord(c) for c in loose], np.int64),
            n,
            np.frombuffer(b"".join(surface), np.uint8),
            np.concatenate([[0], np.cumsum([len(s) for s in surface])]),
            kinds,
            byte_ids,
            model.bos_id(),
            model.eos_id(),
            not any(MARK in p.lstrip(MARK) for p in symbols),
            not any("\n" in p and len(p) > 1 for p in symbols),
        )

    def words(self, text: str) -> list[str]:
        """The parts of a text that are merged on their own, without the one mark in front of most."""
        if not text:
            return []
        if not (self.cut_marks and self.cut_breaks):
            return [text.replace(MARK, " ")]
        if MARK in text or "  " in text or " \n" in text or text[0] == " " or text[-1] == " ":
            parts = WORD.findall(" " + text.replace(MARK, " "))
            return [p[1:] if p[0] == " " else p for p in parts]
        return text.replace("\n", " \n").split(" ")

    def spelled(self, word: str) -> str:
        """A word with its marks."""
        if self.cut_marks and self.cut_breaks and word.startswith("\n"):
            return word
        return MARK + word.replace(" ", MARK)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each)."""
        n_words = len(words)
        if not n_words:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, n_words)
        at, there = found(self.letters, code)
        first_code = self.n_pieces + len(self.loose)
        symbol = np.where(there, self.letter_symbols[at], first_code + code)
        opens = np.zeros(len(code), bool)
        opens[np.cumsum(lengths) - lengths] = True
        opens[1:] |= ~found(self.touching, (code[:-1] << 32) + code[1:])[1]
        place = self.merges.rounds(symbol, opens)
        symbol = symbol[place]
        # pieces are ids; signs without one become their UTF-8 bytes
        word = np.repeat(np.arange(n_words), lengths)[place]
        odd = np.flatnonzero(symbol >= self.n_pieces)
        if not len(odd):
            return symbol.astype(np.int32), np.bincount(word, minlength=n_words)
        raw = [chr(c).encode() for c in code[place[odd]].tolist()]
        size = np.ones(len(symbol), np.int64)
        size[odd] = list(map(len, raw))
        out = np.repeat(symbol, size).astype(np.int32)
        starts = (np.cumsum(size) - size)[odd]
        out[spans(starts, size[odd])] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return out, np.bincount(np.repeat(word, size), minlength=n_words)

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
        """The text of each sequence of ids."""
        kinds = self.kinds[ids]
        size = np.diff(self.surface_starts)[ids]
        starts = self.surface_starts[ids].copy()
        # the mark in front of a text goes, if its first piece starts with one
        rows = np.repeat(np.arange(len(lengths)), lengths)
        loud = np.flatnonzero(kinds != SILENT)
        if len(loud):
            first = loud[np.concatenate([[True], rows[loud[1:]] != rows[loud[:-1]]])]
            first = first[(kinds[first] == NORMAL) & (self.surfaces[starts[first]] == ord(" "))]
            starts[first] += 1
            size[first] -= 1
        flat = self.surfaces[spans(starts, size)].tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(lengths)])].tolist()
        # a silent id ends a run of bytes, though it leaves no trace between them
        parted = (kinds[1:-1] == SILENT) & (kinds[:-2] == BYTE) & (kinds[2:] == BYTE)
        try:
            if parted.any():
                raise ValueError
            return [flat[a:b].decode() for a, b in zip(ends, ends[1:], strict=False)]
        except ValueError:
            bounds = np.concatenate([[0], np.cumsum(size)])
            row_ends = np.concatenate([[0], np.cumsum(lengths)]).tolist()
            return [
                "".join(self.mended(flat, kinds, bounds, a, b)) for a, b in zip(row_ends, row_ends[1:], strict=False)
            ]

    @staticmethod
    def mended(flat: bytes, kinds: np.ndarray, bounds: np.ndarray, start: int, end: int) -> Iterable[str]:
        """Pieces as text; of bytes that form no sign each becomes a replacement sign."""
        run = bytearray()
        for k in range(start, end):
            piece = flat[bounds[k] : bounds[k + 1]]
            if kinds[k] == BYTE:
                run += piece
                continue
            yield signs(bytes(run))
            run.clear()
            yield piece.decode()
        yield signs(bytes(run))


def signs(raw: bytes) -> str:
    out = []
    while raw:
        for n in range(min(4, len(raw)), 0, -1):
            try:
                sign = raw[:n].decode()
            except UnicodeDecodeError:
                continue
            if len(sign) == 1:
                break
        else:
            n, sign = 1, "�"
        out.append(sign)
        raw = raw[n:]
    return "".join(out)


class Encoder:
    """Encodes batches of texts, merging each word once."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.memory = Memory(REMEMBERED, REMEMBERED_ROOM)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        memory = self.memory
        if memory.full():
            memory.forget()
        words, counts = [], []
        for text in texts:
            parts = self.pieces.words(text)
            words += parts
            counts.append(len(parts))
        numbers = np.fromiter(map(memory.known.__getitem__, words), np.int64, len(words))
        if memory.known.new:
            new = [self.pieces.spelled(w) for w in memory.known.new]
            memory.add(*self.pieces.merge(new), sum(map(len, new)))
        flat, lengths = memory.gather(numbers, counts)
        lengths = lengths + 2
        out = np.empty(len(flat) + 2 * len(texts), np.int32)
        stops = np.cumsum(lengths)
        inner = np.ones(len(out), bool)
        inner[stops - 1] = inner[stops - lengths] = False
        out[inner] = flat
        out[stops - lengths], out[stops - 1] = self.pieces.begin, self.pieces.end
        return out, lengths


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids (little-endian 32-bit numbers) and the decoded text."""
    made = T.StructType().add("n_tokens", "long").add("ids", "binary").add("decoded", "string")
    names = [c for c in docs.columns if c.lower() not in ("n_tokens", "ids", "decoded")]
    schema = T.StructType([docs.schema[c] for c in names] + made.fields)
    kept, source = [docs.columns.index(c) for c in names], docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(path))

    def work(batches):
        pieces = shared.value
        encoder = Encoder(pieces)
        for batch in batches:
            texts, at = batch.column(source), 0
            while at < batch.num_rows:
                part, size, end = [], 0, at
                while end < batch.num_rows and (size < BATCH or end == at):
                    part.append(texts[end].as_py() or "")
                    size += len(part[-1])
                    end += 1
                ids, lengths = encoder.encode(part)
                columns = [
                    pa.array(lengths, pa.int64()),
                    strings(ids.astype("<i4"), lengths * 4, pa.binary()),
                    pa.array(pieces.decode(ids, lengths), pa.string()),
                ]
                piece = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([*(piece.column(k) for k in kept), *columns], names=schema.names)
                at = end

    return numbered(docs).mapInArrow(work, schema)
