"""Vector bin packing of tokenized examples into sequences.

A sequence has three capacities: tokens, segments (pieces of examples) and loss-bearing tokens.
Every task packs the examples it reads, block by block. A sequence is filled by the dot-product
heuristic: of all pieces that still fit in every dimension, the one whose demand has the largest
weighted dot product with what is left goes in, where a dimension weighs as much as the pieces of
the block ask of it on average. When nothing whole fits any more, the longest piece left is cut
and its head fills the gap. A sequence that reaches its segment or loss limit first, or the last
one of a task, is closed at a power of two of tokens, and what it holds beyond goes back; so no
sequence needs padding. What is less than a sequence at the end of a block goes on to the next.

Nothing is shuffled, and a task holds one batch of examples and less than a sequence more. The
numbers of sequences hold the number of the task, so they follow the partitioning of the input.

An example is a prompt, whose tokens bear no loss, a text and an end id. Defined results: a NULL
text or prompt is empty, so that a row without text is its end id alone. Rows without an id are
packed like any other; repeated rows are packed each. An empty table gives an empty result. Very
long texts are cut into as many pieces as they need. Equal dot products go to the longer piece,
then to the earlier row. Further columns are not carried along.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.registry import query, table

#: pieces of an example are numbered by tokens of this many bytes
WIDTH = 4
#: words whose ids a worker remembers, and as many older ones
MOST_WORDS = 1 << 19
LONGEST_WORD = 64
#: bytes of a text that are cut into words at a time, at ASCII white space
CHUNK, GAP = 1 << 20, re.compile(rb"[\x20\x09-\x0D]")
#: rows of a result that go to the JVM at a time, by bytes of ids
FLUSH = 1 << 22


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold; the loss limit counts loss-bearing tokens."""

    tokens: int = 4096
    segments: int = 1024
    loss: int = 4096

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("a sequence must hold a token, a segment and a loss-bearing token at least")


@dataclass(frozen=True)
class Piece:
    """Tokens [start, start + length) of one example, whose tokens bear loss from ``loss_from`` on."""

    example: object
    start: int
    length: int
    loss_from: int

    @property
    def loss(self) -> int:
        return max(0, self.start + self.length - max(self.start, self.loss_from))

    def cut(self, length: int) -> tuple[Piece, Piece]:
        head = Piece(self.example, self.start, length, self.loss_from)
        return head, Piece(self.example, self.start + length, self.length - length, self.loss_from)

    def fitting(self, tokens: int, loss: int) -> int:
        """The longest head within ``tokens`` tokens and ``loss`` loss-bearing ones."""
        return min(self.length, tokens, max(0, self.loss_from - self.start) + loss)


class Packer:
    """Packs blocks of pieces; ``pack`` yields whole sequences, each a list of pieces."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.kept: list[Piece] = []

    def pack(self, pieces: Iterable[Piece], last: bool = False) -> Iterator[list[Piece]]:
        """Sequences of the pieces and of what an earlier block left; the ``last`` block leaves nothing."""
        waiting, self.kept = self.kept, []
        for part in (q for p in pieces for q in self.bounded(p)):
            if part.length == self.limits.tokens:
                yield [part]
            else:
                waiting.append(part)
        pool = Pool(waiting)
        while pool.left:
            sequence = self.fill(pool)
            full = sum(p.length for p in sequence) == self.limits.tokens
            if not full and not pool.left and not last:
                self.kept = sequence
                return
            yield sequence if full else self.closed(sequence, pool)

    def bounded(self, piece: Piece) -> Iterator[Piece]:
        """The piece in parts that an empty sequence can hold."""
        while piece.length:
            part, piece = piece.cut(piece.fitting(self.limits.tokens, self.limits.loss))
            yield part

    def fill(self, pool: Pool) -> list[Piece]:
        tokens, segments, loss = self.limits.tokens, self.limits.segments, self.limits.loss
        weights = pool.demand() / np.array([tokens, segments, loss], float) ** 2
        sequence = []
        while tokens and segments and pool.left:
            piece = pool.take(tokens, segments, loss, weights)
            if piece is None:
                longest = pool.longest()
                head = longest.fitting(tokens, loss)
                if not head:
                    pool.put(longest)
                    break
                piece, tail = longest.cut(head)
                pool.put(tail)
            sequence.append(piece)
            tokens, segments, loss = tokens - piece.length, segments - 1, loss - piece.loss
        return sequence

    def closed(self, sequence: list[Piece], pool: Pool) -> list[Piece]:
        """The sequence up to the largest power of two of tokens; the rest goes back."""
        total = sum(p.length for p in sequence)
        beyond = total - (1 << (total.bit_length() - 1))
        while beyond:
            piece = sequence.pop()
            if piece.length > beyond:
                head, piece = piece.cut(piece.length - beyond)
                sequence.append(head)
            pool.put(piece)
            beyond -= piece.length
        return sequence


class Pool:
    """Pieces that wait for a place, as arrays; longer pieces come first."""

    def __init__(self, pieces: list[Piece]):
        self.pieces = sorted(pieces, key=lambda p: -p.length)
        self.lengths = np.array([p.length for p in self.pieces], np.int64)
        self.losses = np.array([p.loss for p in self.pieces], np.int64)
        self.left = len(self.pieces)

    def demand(self) -> np.ndarray:
        """What a waiting piece asks on average: tokens, segments, loss-bearing tokens."""
        return np.array([self.lengths.sum(), self.left, self.losses.sum()], float) / max(1, self.left)

    def take(self, tokens: int, segments: int, loss: int, weights: np.ndarray) -> Piece | None:
        """The piece that fits and has the largest weighted dot product with what is left."""
        fits = (self.lengths > 0) & (self.lengths <= tokens) & (self.losses <= loss)
        product = weights[0] * tokens * self.lengths + weights[1] * segments + weights[2] * loss * self.losses
        at = int(np.argmax(np.where(fits, product, -1.0))) if len(fits) else 0
        return self.out(at) if len(fits) and fits[at] else None

    def longest(self) -> Piece:
        return self.out(int(np.argmax(self.lengths)))

    def out(self, at: int) -> Piece:
        self.lengths[at] = self.losses[at] = 0
        self.left -= 1
        return self.pieces[at]

    def put(self, piece: Piece) -> None:
        """Back among the waiting, in the place that a piece left if there is one."""
        self.left += 1
        empty = np.flatnonzero(self.lengths == 0)
        if len(empty):
            at = int(empty[0])
            self.pieces[at], self.lengths[at], self.losses[at] = piece, piece.length, piece.loss
        else:
            self.pieces.append(piece)
            self.lengths, self.losses = np.append(self.lengths, piece.length), np.append(self.losses, piece.loss)


class WordIds(dict):
    """The ids of a word (a run without ASCII white space) as little-endian 32-bit numbers.

    White space is dropped by the tokenizer, and no step of it looks beyond one, so that the ids
    of a text are those of its words in a row. Letters and the punctuation after them are separate
    for the tokenizer, and letters count in lower case; so a word that is all letters goes to the
    merges of the tokenizer's model at once, after the tokenizer's own normalizer where it is not
    ASCII, and any other word goes through the whole tokenizer. When the table is full, words that
    were not asked for since the last time it was full are forgotten.
    """

    ENDS = b".,;:!?"
    #: letters below this are letters in every version of Unicode that a tokenizer may know
    OLD_LETTERS = "\u0530"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        self.older: dict[bytes, bytes] = {}
        self.letter_of_byte = byte_letters()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.found(word)
        if len(word) <= LONGEST_WORD:
            if len(self) >= MOST_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def found(self, word: bytes) -> bytes:
        stem = word.rstrip(self.ENDS)
        if len(stem) < len(word) and stem[-1:].isalnum():
            return self[stem] + self[word[len(stem) :]]
        if word.isalpha():
            return self[word.lower()] if not word.islower() else self.merged(word.decode())
        text = word.decode()
        if text.isalpha() and max(text) < self.OLD_LETTERS:
            normal = self.normalizer.normalize_str(text)
            if normal.isalpha() and max(normal) < self.OLD_LETTERS:
                return self.merged(normal.encode().decode("latin-1").translate(self.letter_of_byte))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def merged(self, letters: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def of(self, text: str | None) -> bytes:
        """The ids of a text, whose words are taken apart a part at a time."""
        data, parts, start = (text or "").encode(), [], 0
        while start < len(data):
            gap = GAP.search(data, start + CHUNK)
            end = gap.start() if gap else len(data)
            parts.append(b"".join(map(self.__getitem__, data[start:end].split())))
            start = end
        return b"".join(parts)


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the others in a row from U+0100 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


#: one table of words per tokenizer and Python worker; it holds nothing that a result depends on
_KNOWN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]


def pack(
    docs: DataFrame,
    tokenizer: str,
    limits: Limits = Limits(),
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
) -> DataFrame:
    """One row per piece: ``id_col``, start, length, n_loss, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit numbers; ``start`` counts the tokens of the example
    before the piece, ``offset`` those of the sequence. ``tokenizer`` is a path that every
    executor can read.
    """
    given = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        (F.col(prompt_col) if prompt_col else F.lit(None)).cast("string").alias("prompt"),
    )
    id_type = given.schema["id"].dataType.simpleString()
    end = struct.pack("<I", end_id)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer, known = Packer(limits), word_ids(tokenizer)
        first = TaskContext.get().partitionId() << 32
        made, rows, size = 0, [], 0

        def examples(batch: pd.DataFrame) -> Iterator[Piece]:
            for key, text, prompt in zip(batch["id"], batch["text"], batch["prompt"], strict=True):
                head = known.of(prompt)
                ids = head + known.of(text) + end
                yield Piece((None if pd.isna(key) else key, ids), 0, len(ids) // WIDTH, len(head) // WIDTH)

        def blocks() -> Iterator[list[Piece]]:
            for batch in batches:
                yield from packer.pack(examples(batch))
            yield from packer.pack([], last=True)

        for sequence in blocks():
            offset = 0
            for p in sequence:
                key, ids = p.example
                part = ids[WIDTH * p.start : WIDTH * (p.start + p.length)]
                rows.append((key, p.start, p.length, p.loss, part, len(ids) // WIDTH, first + made, offset))
                offset, size = offset + p.length, size + len(part)
            made += 1
            if size >= FLUSH:
                yield framed(rows)
                rows, size = [], 0
        yield framed(rows)

    columns = ["id", "start", "length", "n_loss", "ids", "doc_tokens", "sequence_id", "offset"]

    def framed(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=columns)
        return frame.astype({"id": object}) if id_type == "string" else frame.astype({"id": "Int64"} if id_type in ("bigint", "int") else {})

    schema = f"id {id_type}, start long, length long, n_loss long, ids binary, doc_tokens long, sequence_id long, offset long"
    return given.mapInPandas(packed, schema).withColumnRenamed("id", id_col)


def public_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query("op12_pack_sequences")
def op12_pack_sequences(spark, sf_dir):
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizer())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "n_loss"
    )
