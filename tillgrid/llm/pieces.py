"""Encoding and decoding with a merge-type SentencePiece vocabulary."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrid.llm.common import slices

SPACE = "▁"
#: No piece goes on over the start of a run of spaces or over a line break.
CHUNK = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
#: Chunks, and pairs of pieces, that a worker remembers, and characters of the longest chunk of them.
MOST_KEPT, LONGEST_KEPT = 400_000, 48


class _Kept(dict):
    """Results by chunk or by pair of pieces; forgets the older half when full."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, chunk):
        value = self.make(chunk)
        if len(chunk) <= LONGEST_KEPT:
            if len(self) >= MOST_KEPT:
                for old in list(islice(self, MOST_KEPT // 2)):
                    del self[old]
            self[chunk] = value
        return value


class PieceCoder:
    """Encodes as the library does for merge-type models, and decodes.

    A sequence of pieces is the encoding exactly if each piece, and each two
    neighbours, are what merging their characters again gives. So a text is
    covered from the left by the longest pieces that fit their predecessors;
    where none fits, the position is marked as failed and the piece before it is
    replaced by the next shorter one.
    """

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(library.get_piece_size())
        self.unknown = library.unk_id()
        self.bytes = {library.id_to_piece(i): i for i in ids if library.is_byte(i)}
        self.byte_of = {i: int(piece[3:5], 16) for piece, i in self.bytes.items()}
        special = {i for i in ids if library.is_control(i) or library.is_unknown(i)} | set(self.byte_of)
        self.piece_of = {i: library.id_to_piece(i) for i in ids if i not in special}
        self.id_of = {piece: i for i, piece in self.piece_of.items()}
        self.score = {piece: library.get_score(i) for piece, i in self.id_of.items()}
        if any(SPACE in piece.lstrip(SPACE) or "\n" in piece for piece in self.id_of):
            raise ValueError("pieces that go on over spaces or line breaks are not supported")
        # Bytes below 128 are characters of their own; the others need their neighbours.
        texts = {i: piece.replace(SPACE, " ") for i, piece in self.piece_of.items()}
        texts |= {i: chr(byte) for i, byte in self.byte_of.items() if byte < 128} | {self.unknown: " ⁇ "}
        self.text_of = [texts.get(i, "") for i in ids]
        self.part = np.array([self.byte_of.get(i, 0) > 127 for i in ids])
        self.known = {piece for piece in self.id_of if len(piece) == 1}
        self._index_pieces(len(ids))
        self.fits = _Kept(self._fit)
        self.kept = _Kept(lambda chunk: array("i", self.encode_chunk(chunk)).tobytes())

    def _index_pieces(self, size: int) -> None:
        """Tables by id of the pieces that merging their own characters gives.

        ``halves`` are the two pieces of the last merge, ``rank`` tells which of two
        merges comes first, and ``shorter`` is the longest piece that a piece begins with.
        """
        self.automaton = ahocorasick.Automaton()
        self.length, self.shorter, self.rank = [0] * size, [-1] * size, [0] * size
        self.halves: list[tuple[int, int] | None] = [None] * size
        by_score = sorted(self.id_of, key=lambda piece: -self.score[piece])
        pieces_of_score = Counter(self.score[piece] for piece in by_score if len(piece) > 1)
        self.tied = [False] * size
        for rank, piece in enumerate(by_score):
            self.rank[self.id_of[piece]] = rank
        made = {}
        for piece, own in self.id_of.items():
            halves = self.last_merge(piece) if len(piece) > 1 else None
            if len(piece) == 1 or halves:
                made[piece] = own
                self.length[own] = len(piece)
                self.tied[own] = len(piece) > 1 and pieces_of_score[self.score[piece]] > 1
                self.halves[own] = halves and (self.id_of[halves[0]], self.id_of[halves[1]])
                self.automaton.add_word(piece, own)
        for piece, own in made.items():
            self.shorter[own] = next((made[piece[:k]] for k in range(len(piece) - 1, 0, -1) if piece[:k] in made), -1)
        if len(self.automaton):
            self.automaton.make_automaton()

    def last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that become ``piece`` when its characters are merged; null if they never do."""
        parts = self.merged(piece, stop=2)
        return (parts[0], parts[1]) if len(parts) == 2 and parts[0] in self.id_of and parts[1] in self.id_of else None

    def merged(self, text: str, stop: int = 1) -> list[str]:
        """Pieces from merging: the best scored pair first, the leftmost of equals, until ``stop`` are left."""
        parts = list(text)
        score = self.score
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                own = score.get(parts[i] + parts[i + 1])
                if own is not None and (best is None or own > best):
                    best, at = own, i
            if best is None:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, pair: tuple[int, int]) -> bool:
        """Whether merging the characters of two pieces again gives the same two.

        Their merges are taken back, the latest first. Before each, the parts that
        meet at the border must not make a piece whose merge would have come first;
        of equal merges the one further left does. Pieces that share their score
        with others, such as runs of spaces, are merged from their characters instead.
        """
        left, right = pair
        rank, halves, id_of, piece_of = self.rank, self.halves, self.id_of, self.piece_of
        a, b = left, right
        # A merge at the border breaks the pair if it comes before ``limit``, or at it where that lies further right.
        limit, or_at = len(rank), False
        if self.tied[left] or self.tied[right]:
            return self.merged(piece_of[left] + piece_of[right]) == [piece_of[left], piece_of[right]]
        while True:
            joined = id_of.get(piece_of[a] + piece_of[b])
            if joined is not None and (rank[joined] < limit or or_at and rank[joined] == limit):
                return False
            of_a, of_b = halves[a], halves[b]
            if of_a is None and of_b is None:
                return True
            if of_b is None or of_a is not None and rank[a] > rank[b]:
                limit, or_at, a = rank[a], False, of_a[1]
            else:
                limit, or_at, b = rank[b], True, of_b[0]

    def cover(self, text: str) -> list[int]:
        """Pieces of a text of known characters: longest matches, and backtracking where two do not fit."""
        pieces = [piece for _, piece in self.automaton.iter_long(text)]
        fits = self.fits
        for count, pair in enumerate(pairwise(pieces), 1):
            if not fits[pair]:
                return self._backtrack(text, pieces[:count], pieces[count])
        return pieces

    def _backtrack(self, text: str, pieces: list[int], piece: int) -> list[int]:
        """The cover that starts like ``pieces``, unless what follows makes them give way; ``piece`` is the longest then."""
        length, shorter, fits = self.length, self.shorter, self.fits
        at, end = sum(length[piece] for piece in pieces), len(text)
        failed = bytearray(end + 1)
        while True:
            last = pieces[-1] if pieces else -1
            while piece >= 0 and (failed[at + length[piece]] or last >= 0 and not fits[last, piece]):
                piece = shorter[piece]
            if piece >= 0:
                pieces.append(piece)
                at += length[piece]
                if at == end:
                    return pieces
                piece = next(self.automaton.iter_long(text, at))[1]
            elif pieces:
                # No piece here fits the one before, which has to be shorter.
                failed[at] = 1
                piece = pieces.pop()
                at -= length[piece]
            else:
                raise ValueError(f"no encoding of {text!r}")

    def encode_chunk(self, chunk: str) -> list[int]:
        if self.known.issuperset(chunk):
            return self.cover(chunk)
        ids, start = [], 0
        for i, char in enumerate(chunk):
            if char not in self.known:
                ids += self.cover(chunk[start:i])
                ids += self.bytes_of(char)
                start = i + 1
        return ids + self.cover(chunk[start:])

    def bytes_of(self, char: str) -> list[int]:
        return [self.bytes[f"<0x{byte:02X}>"] for byte in char.encode("utf-8", "replace")] if self.bytes else [self.unknown]

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as 32-bit integers; a null text has none."""
        if not text:
            return b""
        chunks = CHUNK.findall(SPACE + text.replace(" ", SPACE))
        return b"".join(map(self.kept.__getitem__, chunks))

    def forget(self) -> None:
        """Drop what has been remembered of texts."""
        self.kept.clear()
        self.fits.clear()

    def decode_all(self, ids: np.ndarray) -> str:
        """Text of pieces in the middle of a text; bytes that are no UTF-8 become U+FFFD."""
        listed, text_of = ids.tolist(), self.text_of
        if not self.part[ids].any():
            return "".join(map(text_of.__getitem__, listed))
        parts, pending = [], bytearray()
        for i in listed:
            if self.part[i]:
                pending.append(self.byte_of[i])
                continue
            parts += [_as_text(bytes(pending)), text_of[i]]
            pending.clear()
        return "".join([*parts, _as_text(bytes(pending))])

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; the space put before a text when encoding is taken away."""
        text = self.decode_all(ids)
        return text[1:] if len(ids) and self.piece_of.get(int(ids[0]), "").startswith(SPACE) else text


def _as_text(data: bytes) -> str:
    """UTF-8, with one U+FFFD for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(data):
        for width in (1, 2, 3, 4):
            try:
                out.append(data[at: at + width].decode())
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def _coder(model: bytes) -> PieceCoder:
    return PieceCoder(model)


def _codes(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model)
        try:
            for batch in (part for whole in batches for part in slices(whole, 0, 1 << 20)):
                encoded = [coder.encode(text) for text in batch.column(0).to_pylist()]
                ends = np.cumsum([0, *[len(data) // 4 for data in encoded]])
                ids = pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(encoded), np.int32))
                )
                decoded = [coder.decode(np.frombuffer(data, np.int32)) for data in encoded]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], ids, pa.array(decoded, pa.string())],
                    names=[*batch.schema.names[1:], "ids", "decoded"],
                )
        finally:
            # The worker lives on, and the next stage needs the memory.
            coder.forget()
            pa.default_memory_pool().release_unused()

    return run


def with_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with ``ids``, the pieces of the whole text, and ``decoded``, their text.

    No begin or end ids, no sampling; a null text counts as empty and has no ids.
    The vocabulary is read here and goes to the tasks with the code, under a
    megabyte of any model of 32,000 pieces. Columns ``ids`` and ``decoded`` are
    replaced; an empty table stays empty.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    keep = [name for name in docs.columns if name not in ("ids", "decoded")]
    fields = [docs.schema[name] for name in keep]
    schema = T.StructType([
        *fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())
    ])
    return docs.select(F.col("text").alias("_encode"), *keep).mapInArrow(_codes(model), schema)
