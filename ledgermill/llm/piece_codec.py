"""Piece ids of texts by vectorised merge rounds, and texts of piece ids, without the library that made the model.

All symbols of many words lie in flat arrays. A round looks up the rank of every pair of
neighbours, takes the least rank of each word and merges its pairs of that rank from the
left, in all words at once; the arrays are compacted and words without a pair leave. A
merge whose piece makes a pair of no greater rank with a neighbour ends its word's round,
since that pair is next in the order of single merges.
"""

from __future__ import annotations

import codecs
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import col, slices, text_bytes
from ledgermill.llm.word_table import WordTable

MEMORY = 600_000  # words whose ids a worker remembers
MEMORY_BYTES = 48 << 20  # bytes of such words
LONG = 512  # symbols beyond which a stretch is merged from a queue, one pair at a time
NONE = np.int64(1) << 40  # rank of a pair that is no piece

# The wire format's kinds of pieces, the mark for a space, what stands for an unknown piece.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
SPACE = "▁"
UNKNOWN_TEXT = " ⁇ "

# A byte that is no UTF-8 is one replacement character.
codecs.register_error("ledgermill_each_byte", lambda e: ("�", e.start + 1))
EACH_BYTE = "ledgermill_each_byte"


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of one message of the model file."""
    at = 0
    while at < len(data):
        tag, at = varint(data, at)
        if tag & 7 == 0:
            value, at = varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(tag & 7)
            if size is None:
                size, at = varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Lookup:
    """Values of sorted integer keys; ``missing`` for others."""

    def __init__(self, found: dict[int, int], missing: int):
        self.keys = np.array(sorted(found), np.int64)
        self.values = np.array([*(found[k] for k in sorted(found)), missing], np.int64)

    def __getitem__(self, wanted: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, wanted)
        hit = at < len(self.keys)
        hit[hit] = self.keys[at[hit]] == wanted[hit]
        return self.values[np.where(hit, at, len(self.keys))]


class PieceModel:
    """The pieces of one model and what follows from them for encoding and decoding.

    Only models whose every step is built here are taken: merges by score with bytes as
    a fallback, texts unchanged but for a space before them and marks for spaces.
    """

    def __init__(self, path: str):
        with open(path, "rb") as f:
            message = list(fields(f.read()))
        pieces = [dict(fields(v)) for k, v in message if k == 1]
        trainer = dict(fields(next(v for k, v in message if k == 2)))
        rules = dict(fields(next(v for k, v in message if k == 3)))
        kinds = [p.get(3, NORMAL) for p in pieces]
        built = trainer.get(3) == 2 and trainer.get(35) and not trainer.get(24) and not rules.get(2)
        built = built and rules.get(3, 1) == 1 and rules.get(4, 1) == 0 and rules.get(5, 1) == 1
        if not built or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE} or kinds.count(BYTE) != 256:
            raise ValueError(f"{path}: not a model of byte-fallback merges over unchanged text")
        names = [p[1].decode() for p in pieces]
        self.size = len(pieces)
        self.ids = {n: i for i, n in enumerate(names) if kinds[i] == NORMAL}
        self.byte_ids = np.array([names.index(f"<0x{b:02X}>") for b in range(256)], np.int64)
        self.begin, self.end = names.index("<s>"), names.index("</s>")
        scores = np.array([struct.unpack("<f", p.get(2, bytes(4)))[0] for p in pieces])
        self.rank = np.append(np.unique(-scores, return_inverse=True)[1], NONE)
        self._symbols()
        # What a piece adds to a text.
        self.control = np.array([k == CONTROL for k in kinds])
        self.leading = np.array([k == NORMAL and n.startswith(SPACE) for k, n in zip(kinds, names)])
        surface = {NORMAL: lambda n: n.replace(SPACE, " ").encode(), UNKNOWN: lambda n: UNKNOWN_TEXT.encode(), CONTROL: lambda n: b"",
                   BYTE: lambda n: bytes([int(n[3:5], 16)])}
        found = [surface[k](n) for k, n in zip(kinds, names)]
        self.bytes = np.frombuffer(b"".join(found), np.uint8)
        self.n_bytes = np.array([len(x) for x in found], np.int64)
        self.from_byte = np.cumsum(self.n_bytes) - self.n_bytes

    def _symbols(self) -> None:
        """Numbers of characters, pairs of symbols that are pieces, and where a text may be cut."""
        loose = sorted({c for n in self.ids for c in n} - set(self.ids))  # only ever inside pieces
        number = self.ids | {c: self.size + i for i, c in enumerate(loose)}
        self.radix = self.size + len(loose) + 1  # the last is any other character
        points = {ord(c): i for c, i in number.items() if len(c) == 1}
        points[ord(" ")] = points[ord(SPACE)]
        self.characters = Lookup(points, self.radix - 1)
        self.pairs = {
            number[n[:k]] * self.radix + number[n[k:]]: i
            for n, i in self.ids.items()
            for k in range(1, len(n))
            if n[:k] in number and n[k:] in number
        }
        self.pair = Lookup(self.pairs, -1)
        joins = {(a, b) for n in self.ids for a, b in zip(n, n[1:])}
        self.joins = Lookup({number[a] * self.radix + number[b]: 1 for a, b in joins}, 0)
        # A word begins at spaces, and at line breaks, where no piece holds one after something else.
        before = {b: any(y == b and x != b for x, y in joins) for b in (SPACE, "\n")}
        cuts = " " * (not before[SPACE]) + "\n" * (not before["\n"])
        cuts = cuts if " " in cuts else ""
        self.words = re.compile("|".join(f"{c}+[^{cuts}]*" for c in cuts).encode() if cuts else rb"(?s:.+)")

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.rank[self.pair[left * self.radix + right]]


class PieceEncoder:
    """Ids of texts; words that a worker has met before are looked up."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.table = WordTable(self.encode_words)
        self.held = 0

    def encode(self, texts: list[bytes], begin: bool = True, end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        if len(self.table) > MEMORY or self.held > MEMORY_BYTES:
            self.table.forget()
            self.held = 0
        mark = SPACE.encode()
        split = [self.model.words.findall(b" " + t.replace(mark, b" ")) if t else [] for t in texts]
        n = np.fromiter(map(len, split), np.int64, len(split))
        rows = np.concatenate([np.empty(0, np.int64), *map(self.table.rows, split)])
        self.table.settle()
        ids, sizes = self.table.tokens(rows)
        edge = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(n)])]
        around = [(self.model.begin, edge[:-1])] * begin + [(self.model.end, edge[1:])] * end
        if around:
            where = np.stack([at for _, at in around], axis=1).ravel()
            ids = np.insert(ids, where, np.tile([i for i, _ in around], len(texts)))
        return ids, np.diff(edge) + len(around)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each has."""
        model = self.model
        self.held += sum(map(len, words))
        texts = [w.decode("utf-8", EACH_BYTE) for w in words]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        made = self.merge(model.characters[points], ends)
        at = np.flatnonzero(made >= 0)
        found = made[at]
        # A character that is no piece is written as its bytes.
        strange = found >= model.size
        loose = [chr(p).encode() for p in points[at[strange]].tolist()]
        sizes = np.ones(len(found), np.int64)
        sizes[strange] = [len(x) for x in loose]
        ids = np.repeat(found, sizes)
        ids[np.repeat(strange, sizes)] = model.byte_ids[np.frombuffer(b"".join(loose), np.uint8)]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        per_word = np.diff(upto[np.searchsorted(at, ends)], prepend=0)
        return ids, per_word

    def merge(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The symbol at the first character of each final piece, -1 at the others."""
        first = np.zeros(len(symbols), bool)
        first[np.concatenate([[0], ends[:-1]])[np.diff(ends, prepend=0) > 0]] = True
        if np.diff(ends, prepend=0).max(initial=0) > LONG:  # no piece lies across two characters that stand together in none
            first[1:] |= self.model.joins[symbols[:-1] * self.model.radix + symbols[1:]] == 0
        starts = np.flatnonzero(first)
        sizes = np.diff(starts, append=len(symbols))
        made = np.full(len(symbols), -1, np.int64)
        for k in np.flatnonzero(sizes > LONG).tolist():
            self.by_queue(symbols, starts[k], starts[k] + sizes[k], made)
        short = np.repeat(sizes <= LONG, sizes)
        self.by_rounds(symbols[short], np.repeat(np.arange(len(starts)), sizes)[short], np.flatnonzero(short), made)
        return made

    def by_rounds(self, symbol: np.ndarray, word: np.ndarray, place: np.ndarray, made: np.ndarray) -> None:
        model = self.model
        while len(symbol):
            piece = np.full(len(symbol), -1, np.int64)
            inside = np.flatnonzero(word[1:] == word[:-1])
            piece[inside] = model.pair[symbol[inside] * model.radix + symbol[inside + 1]]
            rank = model.rank[piece]
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(starts, append=len(word)))
            done = least == NONE
            made[place[done]] = symbol[done]
            symbol, word, place, piece, rank, least = (x[~done] for x in (symbol, word, place, piece, rank, least))
            if not len(symbol):
                return
            at = np.flatnonzero(rank == least)
            # Of pairs that overlap, the leftmost and then every other one.
            fresh = np.diff(at, prepend=-2) > 1
            order = np.arange(len(at))
            at = at[(order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0]
            new = piece[at]
            left, right = symbol[np.maximum(at - 1, 0)], symbol[np.minimum(at + 2, len(symbol) - 1)]
            touching = np.flatnonzero(np.diff(at) == 2) + 1
            touching = touching[word[at[touching]] == word[at[touching - 1]]]
            left[touching] = new[touching - 1]
            lefts = np.where((at > 0) & (word[np.maximum(at - 1, 0)] == word[at]), model.rank_of(left, new), NONE)
            after = (at + 2 < len(symbol)) & (word[np.minimum(at + 2, len(symbol) - 1)] == word[at])
            rights = np.where(after, model.rank_of(new, right), NONE)
            ends = (np.minimum(lefts, rights) <= rank[at]).astype(np.int64)
            if ends.any():
                before = np.cumsum(ends) - ends
                own = np.diff(word[at], prepend=-1) != 0
                keep = before == np.maximum.accumulate(np.where(own, before, 0))
                at, new = at[keep], new[keep]
            symbol[at] = new
            stays = np.ones(len(symbol), bool)
            stays[at + 1] = False
            symbol, word, place = symbol[stays], word[stays], place[stays]

    def by_queue(self, symbols: np.ndarray, start: int, stop: int, made: np.ndarray) -> None:
        """One long stretch, pair by pair in the order of rank and place: as many steps as merges, whatever the length."""
        model, n = self.model, int(stop - start)
        pairs, radix, rank = model.pairs, model.radix, model.rank.tolist()
        held = symbols[start:stop]
        found = model.rank_of(held[:-1], held[1:])
        at = np.flatnonzero(found < NONE)
        waiting = np.sort(found[at] * n + at)
        symbol = array("q", held.tobytes())
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        fresh: list[int] = []

        def offer(i: int, j: int) -> None:
            piece = pairs.get(symbol[i] * radix + symbol[j])
            if piece is not None:
                heappush(fresh, rank[piece] * n + i)

        def take(key: int) -> None:
            i = key % n
            j = after[i]
            if symbol[i] < 0 or j >= n:
                return
            piece = pairs.get(symbol[i] * radix + symbol[j])
            if piece is None or rank[piece] != key // n:
                return  # one of the two has been merged since
            symbol[i], symbol[j] = piece, -1
            k = after[i] = after[j]
            if before[i] >= 0:
                offer(before[i], i)
            if k < n:
                before[k] = i
                offer(i, k)

        for block in range(0, len(waiting), 1 << 16):
            for key in waiting[block : block + (1 << 16)].tolist():
                while fresh and fresh[0] < key:
                    take(heappop(fresh))
                take(key)
        while fresh:
            take(heappop(fresh))
        made[start:stop] = np.frombuffer(symbol, np.int64)


def decode(model: PieceModel, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """UTF-8 text of every run of ``sizes`` ids. The space that encoding put first goes; ids out of range are an error."""
    if len(ids) and (ids.min() < 0 or ids.max() >= model.size):
        raise ValueError("piece id out of range")
    start, size = model.from_byte[ids], model.n_bytes[ids]
    # The first piece of each text that is no control piece.
    spoken = np.append(np.flatnonzero(~model.control[ids]), len(ids))
    begins = np.cumsum(sizes) - sizes
    first = spoken[np.searchsorted(spoken, begins)]
    first = first[first < begins + sizes]
    first = first[model.leading[ids[first]]]
    start[first] += 1
    size[first] -= 1
    upto = np.cumsum(size)
    at = np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(start - (upto - size), size)
    data = model.bytes[at].tobytes()
    edge = np.concatenate([[0], upto])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
    # Bytes make no character across a control piece.
    byte = np.isin(ids, model.byte_ids)
    split = upto[1:][model.control[ids[1:]] & byte[:-1]]
    texts = []
    for a, b in zip(edge, edge[1:]):
        inner = split[np.searchsorted(split, a, "right") : np.searchsorted(split, b)].tolist() if len(split) else []
        texts.append("".join(data[i:j].decode("utf-8", EACH_BYTE) for i, j in zip([a, *inner], [*inner, b])).encode())
    return texts


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(piece_model(path))


def packed(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    edge = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64) * 4
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(edge), pa.py_buffer(ids.astype("<u4").tobytes())]
    ).cast(pa.binary())


def unpacked(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The reverse of ``packed``; null is no ids."""
    held = [v or b"" for v in values.to_pylist()]
    sizes = np.fromiter((len(v) // 4 for v in held), np.int64, len(held))
    return np.frombuffer(b"".join(held), "<u4").astype(np.int64), sizes


def encode_pieces(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", begin: bool = True, end: bool = True) -> DataFrame:
    """(key, ids) of every row: piece ids of the whole text as packed little-endian unsigned 32-bit integers.

    A null text counts as empty: only the begin and end ids. The key may be null, repeat
    or have any type; every row gives one row. Other columns are neither read nor
    returned. A text of any length is encoded as a whole, in memory in proportion to it;
    spaces in a row, and characters that are no piece, are kept. An empty table gives no
    rows. ``path`` names the model on every machine.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        for batch in slices(batches, "text"):
            ids, sizes = encoder.encode(text_bytes(batch.column("text")), begin, end)
            yield pa.RecordBatch.from_arrays([batch.column("key"), packed(ids, sizes)], ["key", "ids"])

    slim = docs.select(col(key).alias("key"), col(text).alias("text"))
    schema = slim.select("key", F.lit(b"").alias("ids")).schema
    return slim.mapInArrow(run, schema).toDF(key, "ids")


def decode_pieces(encoded: DataFrame, path: str, *, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, decoded) of every row of packed ids, as ``encode_pieces`` writes them.

    Null ids give an empty text, as does an empty list; control ids add nothing, bytes
    that are no UTF-8 one replacement character each. An id that the model does not have
    is an error. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in slices(batches, "ids"):
            texts = decode(model, *unpacked(batch.column("ids")))
            held = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("ids"), held], ["key", "ids", "decoded"])

    slim = encoded.select(col(key).alias("key"), col(ids).alias("ids"))
    schema = slim.select("key", "ids", F.lit("").alias("decoded")).schema
    return slim.mapInArrow(run, schema).toDF(key, ids, "decoded")


def round_trip(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", begin: bool = True, end: bool = True) -> DataFrame:
    """(key, ids, decoded) of every row: ``decode_pieces`` of ``encode_pieces``, by one worker a task.

    The ids are decoded where they were made, from the same packed form, instead of going
    to a second worker. Defined as those two are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        for batch in slices(batches, "text"):
            held = packed(*encoder.encode(text_bytes(batch.column("text")), begin, end))
            texts = pa.array(decode(encoder.model, *unpacked(held)), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("key"), held, texts], ["key", "ids", "decoded"])

    slim = docs.select(col(key).alias("key"), col(text).alias("text"))
    schema = slim.select("key", F.lit(b"").alias("ids"), F.lit("").alias("decoded")).schema
    return slim.mapInArrow(run, schema).toDF(key, "ids", "decoded")
