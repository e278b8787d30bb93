"""Token ids in seekable Zstandard files.

A file is a row of independent frames of ``FRAME_IDS`` ids each (the last may be
shorter), then a skippable frame with the seek table: compressed size,
decompressed size and checksum of each frame. A reader of one document fetches
the table and only the frames that hold the document. Which ids belong to which
document is in the index, a Parquet table written along with the files.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from biomeframe.llm.common import shipped
from biomeframe.session import scratch_path, stored

FRAME_IDS = 1 << 16
LEVEL = 3
#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

#: A worker keeps the ids of distinct words up to about this size, plus those of one batch; results do not depend on it.
KNOWN_BYTES = 48 << 20
_ENTRY_BYTES = 150
_DOCS = 256
_WORD_DOCS = 3072
_LINE_WORDS = 1_000
#: Stops behind a letter and before white space are a token piece of their own anyway.
_STOPS = r"([a-z\x{e0}-\x{f6}\x{f8}-\x{ff}])([.,;:!?]+)([ \n]|$)"
#: Words that are one piece to the tokenizer: Latin letters, or stops.
_ONE_PIECE = r"^([a-z\x{e0}-\x{f6}\x{f8}-\x{ff}]+|[.,;:!?]+)$"
_WORD_END = "</w>"


class _Encoder:
    """A tokenizer of one Python worker.

    With ``by_word``, texts are cut at ASCII white space and each distinct word of
    a batch is encoded once. That equals encoding the text where the tokenizer
    drops white space and case, takes letters and other signs apart, and never
    looks across white space. So A-Z become a-z first and stops are cut off their
    words, which leaves fewer distinct ones; not where the text may hold the name
    of a special token, which has its case. Words of one piece are encoded many
    to a line: the token that ends a piece ends the word.
    """

    def __init__(self, path: str, by_word: bool):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        self.by_word = by_word
        self.known: dict[str, int] = {}  # distinct words of earlier batches, by their place in the next two
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.known_bytes = np.zeros(0, np.uint32), 0
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, k in self.tokenizer.get_vocab().items():
            self.ends[k] = token.endswith(_WORD_END)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        sizes, flat = [], array("I")
        for at in range(0, len(texts), 16):  # the library's results are large objects
            for found in self.tokenizer.encode_batch_fast(texts[at : at + 16], add_special_tokens=False):
                ids = found.ids
                sizes.append(len(ids))
                flat.extend(ids)
        ids = np.frombuffer(flat, dtype=np.uint32) if flat else np.zeros(0, np.uint32)
        return ids, np.array(sizes, dtype=np.int64)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words, where those of each begin, and how many they are.

        Words that the worker's table has are looked up, others encoded and added
        until it holds KNOWN_BYTES.
        """
        names = words.to_pylist()
        place = np.fromiter((self.known.get(w, -1) for w in names), np.int64, len(names))
        new = np.flatnonzero(place < 0)
        ids, begin, size = self._new_words(words.take(pa.array(new)))
        old = place >= 0
        begins, sizes = np.empty(len(names), np.int64), np.empty(len(names), np.int64)
        begins[old], sizes[old] = self.begin[place[old]], self.size[place[old]]
        begins[new], sizes[new] = begin + len(self.ids), size
        out = np.concatenate((self.ids, ids))
        if self.known_bytes < KNOWN_BYTES:
            self.known.update(zip([names[k] for k in new.tolist()], range(len(self.begin), len(self.begin) + len(new))))
            self.begin, self.size = np.concatenate((self.begin, begin + len(self.ids))), np.concatenate((self.size, size))
            self.ids = out
            self.known_bytes += sum(len(names[k]) for k in new.tolist()) + _ENTRY_BYTES * len(new)
        return out, begins, sizes

    def _new_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``_words`` by the tokenizer."""
        plain = pc.match_substring_regex(words, _ONE_PIECE).to_numpy(zero_copy_only=False)
        some, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        names = words.take(pa.array(some)).to_pylist()
        lines = [" ".join(names[at : at + _LINE_WORDS]) for at in range(0, len(names), _LINE_WORDS)]
        line_ids, _ = self._encode(lines)
        bounds = np.concatenate(([0], np.flatnonzero(self.ends[line_ids]) + 1))
        if len(bounds) != len(some) + 1:  # a vocabulary without word ends
            some, rest, line_ids, bounds = some[:0], np.arange(len(words)), line_ids[:0], bounds[:1]
        rest_ids, rest_sizes = self._encode(words.take(pa.array(rest)).to_pylist())
        begin, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        begin[some], size[some] = bounds[:-1], np.diff(bounds)
        begin[rest], size[rest] = len(line_ids) + np.cumsum(rest_sizes) - rest_sizes, rest_sizes
        return np.concatenate((line_ids, rest_ids)), begin, size

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For some texts at a time: how many, their ids in a row, and how many each has."""
        if not self.by_word:
            for at in range(0, len(texts), _DOCS):
                some = texts.slice(at, _DOCS)
                yield len(some), *self._encode(some.to_pylist())
            return
        for at in range(0, len(texts), _WORD_DOCS):
            yield from self._encode_words(texts.slice(at, _WORD_DOCS))

    def _encode_words(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), _STOPS, r"\1 \2\3")
        split = pc.ascii_split_whitespace(texts)
        upto = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))))
        coded = split.flatten().dictionary_encode()
        del split
        codes = coded.indices.to_numpy(zero_copy_only=False)
        ids, begins, sizes = self._words(coded.dictionary)
        del coded
        for at in range(0, len(texts), _DOCS):
            to = min(at + _DOCS, len(texts))
            some = codes[upto[at] : upto[to]]
            begin, size = begins[some], sizes[some]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            flat = ids[np.arange(total) + np.repeat(begin - (ends - size), size)]
            before = np.concatenate(([0], ends))
            yield to - at, flat, np.diff(before[upto[at : to + 1] - upto[at]])


def _uri(path: str) -> str:
    """A folder that Spark names by one of Hadoop's schemes, as Arrow names it."""
    return re.sub(r"^dbfs:/+", "file:///dbfs/", re.sub(r"^s3[an]://", "s3://", path))


def _files(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(_uri(path))


@cache
def _encoder(path: str, by_word: bool) -> _Encoder:
    """One for all tasks of a worker; called by name, so that the worker keeps it."""
    return _Encoder(path, by_word)


class _Writer:
    """Frames of one file, written as they fill."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.rest = np.zeros(0, dtype=f"<u{width}")
        self.table: list[tuple[int, int, int]] = []

    def add(self, ids: np.ndarray) -> None:
        ids = np.concatenate((self.rest, ids.astype(self.rest.dtype)))
        whole = len(ids) // FRAME_IDS * FRAME_IDS
        for at in range(0, whole, FRAME_IDS):
            self._frame(ids[at : at + FRAME_IDS])
        self.rest = ids[whole:]

    def _frame(self, ids: np.ndarray) -> None:
        raw = ids.tobytes()
        data = self.pack.compress(raw)
        self.out.write(data)
        check = xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF
        self.table.append((len(data), len(raw), check))

    def close(self) -> None:
        if len(self.rest):
            self._frame(self.rest)
        body = b"".join(struct.pack("<III", *row) for row in self.table)
        foot = struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body) + len(foot)) + body + foot)


class TokenFile:
    """Reader of one file: ``ids(first, n)`` decompresses only the frames needed."""

    def __init__(self, source, width: int):
        self.source, self.width = source, width
        size = source.size()
        count, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        body = self._read(size - 9 - 12 * count, 12 * count)
        self.table = np.frombuffer(body, dtype="<u4").reshape(-1, 3)
        self.starts = np.concatenate(([0], np.cumsum(self.table[:, 0], dtype=np.int64)))
        self.unpack = zstandard.ZstdDecompressor()
        self.last: tuple[int, np.ndarray] = (-1, np.zeros(0))

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def frame(self, k: int) -> np.ndarray:
        if self.last[0] != k:
            data = self._read(int(self.starts[k]), int(self.table[k, 0]))
            raw = self.unpack.decompress(data, max_output_size=int(self.table[k, 1]))
            if len(raw) != self.table[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[k, 2]:
                raise ValueError(f"frame {k} does not match its checksum")
            self.last = (k, np.frombuffer(raw, dtype=f"<u{self.width}"))
        return self.last[1]

    def ids(self, first: int, n: int) -> np.ndarray:
        parts = []
        while n > 0:
            k, skip = divmod(first, FRAME_IDS)
            part = self.frame(k)[skip : skip + n]
            if not len(part):
                raise ValueError("the file ends before the document does")
            parts.append(part)
            first, n = first + len(part), n - len(part)
        return np.concatenate(parts) if parts else np.zeros(0, dtype=f"<u{self.width}")


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    end_id: int,
    by_word: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode every row of ``docs``, write its ids in doc_id order, return the index.

    The index has a row for each row of ``docs``: doc_id, file_no (in order),
    file (its name under ``path``), first (ids of the file before the document),
    n_tokens, width (bytes of an id). ``end_id`` follows each document. A null
    text counts as empty. A null doc_id comes first; rows of one doc_id are
    ordered by a hash of their text, so they may span files. Extra columns are
    ignored. ``by_word`` is for tokenizers that drop white space (see _Encoder).

    Files are named after the task attempt and only those of finished tasks are
    in the index: a lost executor leaves at most unused files.
    """
    shipped(docs.sparkSession)
    width = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("h"), body.alias("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    schema = StructType([
        docs.select(F.col(doc_id).alias("doc_id")).schema[0],
        StructField("file_no", IntegerType()), StructField("file", StringType()),
        StructField("first", LongType()), StructField("n_tokens", LongType()),
        StructField("width", IntegerType()),
    ])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.zst"
        encoder = _encoder(tokenizer, by_word)
        out = writer = None
        first = 0
        for batch in batches:
            if writer is None:
                system, root = _files(path)
                system.create_dir(root)
                out = system.open_output_stream(f"{root}/{name}", compression=None)
                writer = _Writer(out, width)
            at = 0
            pa.default_memory_pool().release_unused()
            for rows, flat, sizes in encoder.encode(batch.column(2)):
                writer.add(np.insert(flat, np.cumsum(sizes), end_id))
                n = sizes + 1
                starts = first + np.cumsum(n) - n
                first += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, rows), pa.array([task.partitionId()] * rows, pa.int32()),
                     pa.array([name] * rows), pa.array(starts), pa.array(n),
                     pa.array([width] * rows, pa.int32())],
                    names=schema.names,
                )
                at += rows
        if writer is not None:
            writer.close()
            out.close()

    # Whole texts: an Arrow batch of the usual number of rows takes much memory on both sides.
    conf, limit = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(limit)
    conf.set(limit, str(_WORD_DOCS))
    try:
        return stored(rows.mapInArrow(write, schema), "token-index")
    finally:
        conf.set(limit, before)


def read_token_files(index: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each row of an index, from the files.

    start is the number of ids of all documents before it over all files; the
    running sum is over one row for each file.
    """
    shipped(index.sparkSession)
    files = index.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    schema = StructType([
        index.schema["doc_id"], StructField("file_no", IntegerType()),
        StructField("first", LongType()), StructField("n_tokens", LongType()),
        StructField("ids_crc32", LongType()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _files(path)
        name, file = None, None
        for batch in batches:
            sums = []
            for row in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5))):
                if row[0] != name:
                    name = row[0]
                    file = TokenFile(system.open_input_file(f"{root}/{name}"), row[3])
                sums.append(zlib.crc32(file.ids(row[1], row[2]).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), batch.column(4),
                 pa.array(sums, pa.int64())],
                names=schema.names,
            )

    found = index.mapInArrow(read, schema)
    return found.join(F.broadcast(files), "file_no").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenised(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """``docs`` written to new token files in the shared folder and read back."""
    path = scratch_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, path, tokenizer, **options), path)
