"""Token ids in Arrow files of equal-length sequences, read in place without copying.

A part is two Arrow IPC files. The first holds the part's token stream cut into rows:
``ids``, a fixed-size list of unsigned integers, and ``mask``, a fixed-size list of
booleans that is false for the filling of the last row. Every record batch but the last
has the same number of rows, so any row is found by division. The second lists the
part's documents with where each starts in the stream. Files are not compressed: a row
of a mapped file is a view of it.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgermill.llm.common import col, slices, text_bytes
from ledgermill.llm.word_table import WordTable
from ledgermill.session import scratch_path

MARK = "\x01"  # stands between words that are encoded together
TOGETHER = 256  # words encoded at once
PLAIN = "\u0130"  # letters before it stay letters in lower case
MEMORY = 900_000  # words whose ids a worker remembers
MANIFEST = "part int, file string, documents long, tokens long, start long"


class WordEncoder:
    """Ids of texts, word by word with a memory, for tokenizers that drop white space.

    Such a tokenizer never looks across white space, so a text's ids are its words' ids
    one after another. New words are encoded many at a time. Words of letters are one
    piece each and end with an id that closes a piece; others stand with a mark between
    them that has an id of its own, and words that hold the mark go alone. Where upper and
    lower case ASCII give the same ids, texts are lower-cased first, for fewer words.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = id_type(self.tokenizer)
        mark = self.ids(MARK)
        self.mark = mark[0] if len(mark) == 1 and self.ids(f"a {MARK} b") == self.ids("a") + mark + self.ids("b") else None
        letters = "abcdefghijklmnopqrstuvwxyz"
        self.folds = all(self.ids(x) == self.ids(x.upper()) for x in (letters, *letters))
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.closes[i] = bool(suffix) and token.endswith(suffix)
        self.table = WordTable(self.encode_words)

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [w.decode() for w in words]
        closing = bool(self.closes.any())
        plain = [closing and t.isalpha() and max(t) < PLAIN for t in texts]
        kinds = np.array([2 if self.mark is None or MARK in t else 0 if p else 1 for t, p in zip(texts, plain)])
        flat, sizes = [], np.zeros(len(words), np.int64)
        order = np.argsort(kinds, kind="stable")
        for kind in range(3):
            rows = np.flatnonzero(kinds == kind)
            step = 1 if kind == 2 else TOGETHER
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                joined = (f" {MARK} " if kind == 1 else " ").join([texts[i] for i in part])
                found = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
                if kind == 0:
                    sizes[part] = np.diff(np.flatnonzero(self.closes[found]) + 1, prepend=0)
                elif kind == 1:
                    between = np.flatnonzero(found == self.mark)
                    sizes[part] = np.diff(between, prepend=-1, append=len(found)) - 1
                    found = np.delete(found, between)
                else:
                    sizes[part] = len(found)
                flat.append(found)
        # From the order of kinds back to that of the words.
        data = np.concatenate([np.empty(0, np.int64), *flat])
        starts = np.empty(len(words), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        at = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        return data[at], sizes

    def fold(self, text: bytes) -> bytes:
        """Lower case, unless that would make a special token of something else."""
        low = text.lower()
        return text if any(s in low for s in self.special) else low

    def encode(self, texts: list[bytes], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with the end after each, and how many each has."""
        if len(self.table) > MEMORY:
            self.table.forget()
        _, _, ids, lengths = self.table.sequences([self.fold(t) for t in texts] if self.folds else texts, end)
        return ids.astype(self.kind), lengths


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@lru_cache(maxsize=2)
def whole_encoder(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def id_type(tokenizer: Tokenizer) -> np.dtype:
    return np.dtype("<u2") if tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")


def encode_texts(texts: list[bytes], path: str, by_word: bool, end: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, the end after each, in as few bytes as hold them; and how many each has."""
    if by_word:
        return encoder(path).encode(texts, end)
    tokenizer = whole_encoder(path)
    last = [] if end is None else [end]
    found = [e.ids + last for e in tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter((i for x in found for i in x), id_type(tokenizer), int(sizes.sum())), sizes


# What Spark calls stores that the Arrow library knows by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def store_uri(folder: str) -> str:
    """A folder as the Arrow library names it."""
    scheme, colon, rest = folder.partition(":")
    return SCHEMES.get(scheme.lower(), scheme) + colon + rest if colon and "/" not in scheme else folder


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, from any machine that has it; ``hdfs`` needs its native library there."""
    uri = store_uri(folder)
    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), uri)


def sequence_schema(kind: np.dtype, length: int) -> pa.Schema:
    ids = pa.list_(pa.from_numpy_dtype(kind), length)
    return pa.schema([pa.field("ids", ids, False), pa.field("mask", pa.list_(pa.bool_(), length), False)])


class SequenceWriter:
    """Packs a stream of ids into record batches of ``rows`` sequences of ``length``."""

    def __init__(self, sink: pa.NativeFile, kind: np.dtype, length: int, rows: int):
        self.schema = sequence_schema(kind, length)
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.kind, self.length, self.rows = kind, length, rows
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += len(ids)
        whole = self.rows * self.length
        if self.size >= whole:
            data = np.concatenate(self.held)
            end = len(data) // whole * whole
            for at in range(0, end, whole):
                self.batch(data[at : at + whole], whole)
            self.held, self.size = [data[end:]], len(data) - end

    def batch(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        ids = np.concatenate([np.empty(0, self.kind), *self.held])
        if len(ids):
            filled = np.zeros(-(-len(ids) // self.length) * self.length, self.kind)
            filled[: len(ids)] = ids
            self.batch(filled, len(ids))
        self.writer.close()


class SequenceFile:
    """One part's sequences: a mapped local file, or one read batch by batch from elsewhere."""

    def __init__(self, path: str):
        system, place = filesystem(path)
        local = isinstance(system, fs.LocalFileSystem)
        self.reader = pa.ipc.open_file(pa.memory_map(place) if local else system.open_input_file(place))
        self.rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 0
        self.length = self.reader.schema.field("ids").type.list_size

    def __len__(self) -> int:
        n = self.reader.num_record_batches
        return (n - 1) * self.rows + self.reader.get_batch(n - 1).num_rows if n else 0

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view of the file) and mask of sequence ``i``."""
        batch = self.reader.get_batch(i // self.rows)
        at = i % self.rows
        flat = batch.column("ids").flatten().to_numpy()
        return flat[at * self.length : (at + 1) * self.length], batch.column("mask")[at].values

    def stream(self) -> Iterator[np.ndarray]:
        """The real ids in order, a batch at a time."""
        for i in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(i)
            ids = batch.column("ids").flatten().to_numpy()
            if i == self.reader.num_record_batches - 1:
                ids = ids[: batch.column("mask").flatten().true_count]
            yield ids


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    by_word: bool = False,
    end_id: int | None = None,
    length: int = 512,
    rows: int = 256,
) -> DataFrame:
    """Encode ``docs`` into files below ``folder``, in ascending order of ``key``, and return their manifest.

    ``tokenizer`` is the path of a tokenizers file; ``by_word`` may be set for one that
    drops white space. Null texts are empty; ``end_id`` is appended to every document.
    Keys are integers; null ones come first, equal ones in the order of their texts.
    Repeated rows are written as often as they come. A text of any length is one document,
    its ids in as many sequences as they fill. An empty table gives no files. Parts
    are ranges of keys: part, file, documents, tokens and start, the ids in all parts
    before it. A task that is run again writes files of another name, and only those of
    the task that Spark accepts are listed. The manifest is stored in the folder too.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = slices(batches, "text")
        first = next(batches, None)
        if first is None:
            return
        system, place = filesystem(folder)
        system.create_dir(place, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{uuid4().hex}"
        documents, tokens, writer, index = 0, 0, None, None
        with system.open_output_stream(f"{place}/{name}.arrow") as ids_out, system.open_output_stream(f"{place}/{name}.docs.arrow") as docs_out:
            for batch in (x for xs in ([first], batches) for x in xs):
                ids, sizes = encode_texts(text_bytes(batch.column("text")), tokenizer, by_word, end_id)
                writer = writer or SequenceWriter(ids_out, ids.dtype, length, rows)
                writer.add(ids)
                starts = tokens + np.cumsum(sizes) - sizes
                listed = pa.RecordBatch.from_arrays([batch.column("key"), pa.array(starts), pa.array(sizes)], ["key", "start", "tokens"])
                index = index or pa.ipc.new_file(docs_out, listed.schema)
                index.write_batch(listed)
                documents += batch.num_rows
                tokens += int(sizes.sum())
            writer.close()
            index.close()
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "file": [name], "documents": [documents], "tokens": [tokens]}
        )

    slim = docs.select(col(key).cast("long").alias("key"), col(text).alias("text"))
    ranged = slim.repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first(), "text")
    written = ranged.mapInArrow(write, "part int, file string, documents long, tokens long")
    staged = f"{folder}/written"
    written.write.parquet(staged)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = docs.sparkSession.read.parquet(staged).withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    manifest.write.parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def document_digests(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, read back from the files.

    ``start`` counts the ids of all documents before it; the checksum is that of the ids
    as little-endian 32-bit integers. A task reads a part, batch by batch.
    """
    manifest = read_manifest(spark, folder)
    parts = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                system, place = filesystem(folder)
                stream = SequenceFile(f"{folder}/{name}.arrow").stream()
                held = np.empty(0, "<u4")
                with system.open_input_file(f"{place}/{name}.docs.arrow") as source:
                    index = pa.ipc.open_file(source)
                    for i in range(index.num_record_batches):
                        listed = index.get_batch(i)
                        sums = []
                        for n in listed.column("tokens").to_pylist():
                            pieces = [held]
                            have = len(held)
                            while have < n:
                                pieces.append(next(stream).astype("<u4"))
                                have += len(pieces[-1])
                            held = np.concatenate(pieces) if len(pieces) > 1 else held
                            sums.append(zlib.crc32(held[:n].tobytes()))
                            held = held[n:]
                        at = pa.array(listed.column("start").to_numpy() + start)
                        yield pa.RecordBatch.from_arrays(
                            [listed.column("key"), at, listed.column("tokens"), pa.array(sums, pa.int64())],
                            ["key", "start", "n_tokens", "ids_crc32"],
                        )

    spread = manifest.select("part", "file", "start").repartitionByRange(parts, "part")
    found = spread.mapInArrow(read, "key long, start long, n_tokens long, ids_crc32 long")
    return found.withColumnRenamed("key", key)


def token_folder(spark: SparkSession) -> str:
    """A fresh folder for files, shared by the driver and all executors."""
    return scratch_path(spark, "tokens")
