"""SentencePiece (BPE) encoding by a merge-type prefix table, and decoding.

For every prefix of a text the table stores the one token that ends its encoding. A token
that an automaton finds to end at a place is that token if it covers the prefix alone, or if
it is compatible with the token stored where it begins: two tokens are compatible if the
merges of their joined string leave exactly these two. The ids are then recovered backwards
from the last prefix. A text is cut where no merge can reach across: between two characters
that are neighbours in no piece, so also before a space symbol that follows another character
(an unknown character becomes byte pieces). These places are found for a whole text at once, and
what lies between two of them, a run, is remembered. Pieces of space symbols only all have one score, so that their merges go by place
and not by type; a run of them is merged by place, once for each length.

The table needs a model whose merges are ordered by type: pieces of more than one character
with different scores, space symbols only at their start, no piece given by the user, byte
pieces, and a normaliser that leaves texts as they are. Other models are refused.

Defined results: a NULL text is empty; an empty text has the begin and end ids only and decodes
to an empty text. Repeated rows are encoded each. An empty table gives an empty result. Columns
of the input named like an added one are replaced, and those that start with an underscore are
left out.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import pairwise

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.registry import cleared, query, table

SPACE = "▁"
MOST_CACHED = 1 << 17
#: characters of a run that is worth remembering
SHORT = 64
#: characters of a text that are looked at together for places to cut
STRIP = 1 << 18


class Pieces:
    """The tables of a model, and what the texts so far have taught. It lives as long as a task."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.begin, self.end = library.bos_id(), library.eos_id()
        size = library.get_piece_size()
        names, scores = library.id_to_piece(list(range(size))), library.get_score(list(range(size)))
        special = [library.is_control(i) or library.is_unknown(i) or library.is_unused(i) for i in range(size)]
        self.bytes_of = [b""] * size
        self.byte_ids, self.ids, self.rank = [-1] * 256, {}, {}
        self.unknown = library.unk_id()
        for i, name in enumerate(names):
            if library.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(name[3:5], 16)])
            elif not special[i]:
                self.ids[name] = i
                self.rank[name] = -scores[i]
                self.bytes_of[i] = name.replace(SPACE, " ").encode()
        self._spaces_only = {len(n) for n in self.ids if not n.strip(SPACE)}
        self._check(library)
        self.names = names
        self.is_byte = [library.is_byte(i) for i in range(size)]
        self._automaton = ahocorasick.Automaton()
        self._build_edges()
        for name in self._time:
            self._automaton.add_word(name, (len(name), self.ids[name]))
        self._automaton.make_automaton()
        # of a piece, whether the pieces met so far may follow it
        self._compatible: list[dict[int, bool]] = [{} for _ in names]
        self._pairs_known = 0
        self._at_start = dict.fromkeys(range(size), True)
        self._build_neighbours()
        self._packed_id = [self._pack([i]) for i in range(size)]
        self._one_space = self._pack([self.ids[SPACE]])
        self.forget()

    def forget(self) -> None:
        """Drop what was learnt from texts; the tables of the model stay."""
        self._space_runs: dict[int, bytes] = {}
        # a full cache becomes the older one, from which what is met again comes back
        self._runs: dict[str, bytes] = {}
        self._older_runs: dict[str, bytes] = {}

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _check(self, library) -> None:
        merged = [n for n in self.ids if len(n) > 1 and n.strip(SPACE)]
        if len({self.rank[n] for n in merged}) < len(merged):
            raise ValueError("pieces share a score: merges are not ordered by type")
        if any(SPACE in n.lstrip(SPACE) or n.startswith(SPACE * 2) for n in merged):
            raise ValueError("a piece reaches across a space symbol")
        if SPACE not in self.ids or -1 in self.byte_ids:
            raise ValueError("the model has no space symbol or no byte pieces")
        if any(self.rank[SPACE * n] <= max(map(self.rank.get, merged), default=0) for n in self._spaces_only if n > 1):
            raise ValueError("space symbols merge before other pieces")
        probe = "  Aﬁ  éé "
        if library.decode(library.encode(probe)) != probe:
            raise ValueError("the model changes texts before encoding")

    def _build_neighbours(self) -> None:
        """Which characters are neighbours within some piece; between others no merge is possible.

        A character's code leads to its row and its column in a table; characters beyond the
        last known code, or in no pair, share the first ones, where all is apart.
        """
        pairs = {(ord(a), ord(b)) for name in self.ids for a, b in pairwise(name)}
        rows = {code: i for i, code in enumerate(sorted({a for a, _ in pairs}), 1)}
        columns = {code: i for i, code in enumerate(sorted({b for _, b in pairs}), 1)}
        self._beyond = max([*rows, *columns], default=0) + 1
        width = len(columns) + 1
        self._apart = np.ones((len(rows) + 1) * width, bool)
        self._row, self._column = np.zeros(self._beyond + 1, np.int64), np.zeros(self._beyond + 1, np.int64)
        for code, row in rows.items():
            self._row[code] = row * width
        for code, column in columns.items():
            self._column[code] = column
        for a, b in pairs:
            self._apart[self._row[a] + self._column[b]] = False

    def _build_edges(self) -> None:
        """The merges that make each piece, seen from its right and from its left edge.

        An edge is the list of (string at the edge, its rank, time when its other part is
        there); the time of a merge is the worst rank among itself and the merges before it.
        """
        # character: no merge, there from the start
        self._right = {n: [(n, 0.0, 0.0)] for n in self.ids if len(n) == 1}
        self._left, self._time = dict(self._right), dict.fromkeys(self._right, -1.0)
        for name in sorted((n for n in self.ids if len(n) > 1 and n.strip(SPACE)), key=len):
            parts = self._last_merge(name)
            if parts is None:
                continue  # no text is ever encoded to it
            a, b = parts
            rank = self.rank[name]
            self._time[name] = max(rank, self._time[a], self._time[b])
            self._right[name] = [*self._right[b], (name, rank, self._time[a])]
            self._left[name] = [*self._left[a], (name, rank, self._time[b])]

    def _last_merge(self, name: str) -> tuple[str, str] | None:
        """The two parts that are merged last when the string of a piece is encoded by itself."""
        parts = list(name)
        while len(parts) > 1:
            ranks = [self.rank.get(a + b) for a, b in pairwise(parts)]
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                return None
            if len(parts) == 2:
                return parts[0], parts[1]
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return None

    def _stays_apart(self, a: str, b: str) -> bool:
        """Whether no merge crosses the border while both strings grow to the pieces they are.

        Both edges at the border grow in the order of their merges; a crossing merge happens
        if its rank comes before the next growth on either side (on the left side, an equal
        rank is further left and comes first).
        """
        right, left = self._right[a], self._left[b]
        i, j, now = 0, 0, -1.0
        while True:
            cross = self.rank.get(right[i][0] + left[j][0])
            grow_a = grow_b = float("inf")
            if i + 1 < len(right):
                _, rank, other = right[i + 1]
                grow_a = max(rank, other) if other > now else rank
            if j + 1 < len(left):
                _, rank, other = left[j + 1]
                grow_b = max(rank, other) if other > now else rank
            if cross is not None and cross < grow_a and cross <= grow_b:
                return False
            if i + 1 == len(right) and j + 1 == len(left):
                return True
            if grow_a <= grow_b:
                i, now = i + 1, max(now, grow_a)
            else:
                j, now = j + 1, max(now, grow_b)

    def compatible(self, first: int, second: int) -> bool:
        """Whether the merges of the joined strings of two pieces leave exactly these two."""
        known = self._compatible[first].get(second)
        if known is None:
            known = self._stays_apart(self.names[first], self.names[second])
            if self._pairs_known >= 4 * MOST_CACHED:
                for followers in self._compatible:
                    followers.clear()
                self._pairs_known = 0
            self._compatible[first][second] = known
            self._pairs_known += 1
        return known

    def _known_run(self, text: str) -> bytes:
        """Ids of a text whose characters are all pieces, with a space symbol at its start only."""
        # by place: (size, token) of the one token that ends there, and what is known to follow it
        last, after = [(0, 0)] * len(text), [self._at_start] * (len(text) + 1)
        known, settled = self._compatible, -1
        for stop, found in self._automaton.iter(text):
            if stop == settled:
                continue  # at most one of the tokens that end here fits
            size, token = found
            start = stop + 1 - size
            fits = after[start].get(token)
            if not fits and (fits is not None or not self.compatible(last[start - 1][1], token)):
                continue
            settled, last[stop], after[stop + 1] = stop, found, known[token]
        parts, stop, packed = [], len(text) - 1, self._packed_id
        while stop >= 0:
            size, token = last[stop]
            parts.append(packed[token])
            stop -= size
        parts.reverse()
        return b"".join(parts)

    def _spaces(self, count: int) -> bytes:
        """Ids of a run of space symbols, merged by place.

        The leftmost part grows while some piece has its new length, by the part right of it
        as far as that one has grown when the left one cannot take a smaller one.
        """
        known = self._space_runs.get(count)
        if known is None:
            sizes = self._space_merges(count)
            known = self._pack([self.ids[SPACE * n] for n in sizes])
            if count <= SHORT:
                self._space_runs[count] = known
        return known

    def _space_merges(self, count: int) -> list[int]:
        done: list[int] = []
        left = count
        while left:
            done.append(1)
            left -= 1
            while True:
                if len(done) > 1 and done[-2] + done[-1] in self._spaces_only:
                    done[-2:] = [done[-2] + done[-1]]
                elif left and done[-1] + 1 in self._spaces_only:
                    done[-1] += 1
                    left -= 1
                else:
                    break
        return done

    def _after_spaces(self, text: str) -> bytes:
        """Ids of a run that begins with more than one space symbol, or is the only one."""
        body = text.lstrip(SPACE)
        spaces = len(text) - len(body)
        if not body:
            return self._spaces(spaces)
        ids = self._runs.get(SPACE + body) or self._run(SPACE + body)
        if ids[:4] == self._one_space:  # nothing took the last one: it is part of the spaces
            return self._spaces(spaces) + ids[4:]
        return self._spaces(spaces - 1) + ids

    def _run(self, text: str) -> bytes:
        """Ids of a text that no cut divides: one unknown character, or characters that are pieces."""
        known = self._older_runs.get(text)
        if known is None:
            if text[0] == SPACE and text[1:2] in ("", SPACE):
                known = self._after_spaces(text)
            elif len(text) == 1 and text not in self.ids:
                known = self._pack([self.byte_ids[b] for b in text.encode()])
            else:
                known = self._known_run(text)
        if len(text) <= SHORT:
            if len(self._runs) >= MOST_CACHED:
                self._older_runs, self._runs = self._runs, {}
            self._runs[text] = known
        return known

    def _cuts(self, text: str) -> list[int]:
        """The places of a text between characters that are neighbours in no piece."""
        cuts: list[int] = []
        for at in range(0, len(text) - 1, STRIP):
            codes = np.frombuffer(text[at : at + STRIP + 1].encode("utf-32-le"), "<u4")
            codes = np.minimum(codes, self._beyond)
            apart = self._apart[self._row[codes[:-1]] + self._column[codes[1:]]]
            cuts += (np.flatnonzero(apart) + (at + 1)).tolist()
        return cuts

    def encode(self, text: str) -> bytes:
        """The ids with begin and end as little-endian unsigned 32-bit numbers."""
        body = b""
        if text:
            text = SPACE + text.replace(" ", SPACE)
            run = self._run
            runs = [text[a:b] for a, b in pairwise([0, *self._cuts(text), len(text)])]
            body = b"".join([self._runs.get(r) or run(r) for r in runs])
        return self._pack([self.begin]) + body + self._pack([self.end])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD each, and the first space symbol goes."""
        ids = ids.tolist()
        text = b"".join(map(self.bytes_of.__getitem__, ids))
        try:
            out = text.decode()
        except UnicodeDecodeError:
            out = self._decode_broken(ids)
        first = next((i for i in ids if self.bytes_of[i]), self.begin)
        return out[1:] if self.names[first].startswith(SPACE) else out

    def _decode_broken(self, ids: list[int]) -> str:
        out, run = [], b""
        for i in [*ids, -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.bytes_of[i]
                continue
            while run:
                for size in range(1, min(4, len(run)) + 1):
                    try:
                        out.append(run[:size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�")
                run = run[size:]
            if i >= 0:
                out.append(self.bytes_of[i].decode())
        return "".join(out)


def read_model(path: str) -> bytes:
    """The model file, read by the driver and sent along with the tasks; refused beyond 64 MB."""
    with open(path, "rb") as file:
        model = file.read((64 << 20) + 1)
    if len(model) > 64 << 20:
        raise ValueError("the model is larger than 64 MB")
    return model


#: the tables of one model per Python worker, since building them takes a second or two
_KNOWN: dict[bytes, Pieces] = {}


@contextmanager
def tables_of(model: bytes) -> Iterator[Pieces]:
    """The worker's tables of a model for the time of a task, which leaves nothing learnt behind."""
    if model not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[model] = Pieces(model)
    known = _KNOWN[model]
    try:
        yield known
    finally:
        known.forget()


def encoded(text: Column, model: bytes) -> Column:
    """Ids of a text column, as binary: little-endian unsigned 32-bit numbers."""

    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with tables_of(model) as known:
            for texts in batches:
                yield pd.Series([known.encode(t or "") for t in texts], dtype=object)

    return of(text)


def decoded(ids: Column, model: bytes) -> Column:
    """Texts of a column as ``encoded`` makes it; NULL stays NULL."""

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with tables_of(model) as known:
            for packed in batches:
                yield pd.Series([None if p is None else known.decode(np.frombuffer(p, "<u4")) for p in packed], dtype=object)

    return of(ids)


def encoded_and_decoded(text: Column, model: bytes) -> Column:
    """(ids, decoded): both of the above in one pass, so that a task holds the tables once."""

    @F.pandas_udf("ids binary, decoded string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with tables_of(model) as known:
            for texts in batches:
                ids = [known.encode(t or "") for t in texts]
                back = [known.decode(np.frombuffer(p, "<u4")) for p in ids]
                yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(back, dtype=object)})

    return of(text)


def encode_documents(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ids (binary), the text decoded from them, and n_tokens."""
    docs = cleared(docs, "ids", "decoded", "n_tokens")
    found = docs.withColumn("_found", encoded_and_decoded(F.col(text_col), read_model(model_path)))
    found = found.select(*docs.columns, "_found.*")
    return found.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op6_sentencepiece")
def op6_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public_model()).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
