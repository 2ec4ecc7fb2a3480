"""Token files: one independent zstandard frame per document, a trailing seek table, checksums.

A file is a sequence of zstandard frames, so any zstandard reader can read it whole:

* per document a frame of its ids (little-endian, 2 bytes each if the vocabulary has at most
  65,536 ids, else 4), with the frame's own content checksum, followed by an empty skippable
  frame (``SEPARATOR``; counted with the document's frame);
* a skippable frame with the document keys (a byte 0/1 for "has a key", then int64 each) and
  the id width;
* the seek table of the zstandard seekable format: per frame its compressed size, its
  decompressed size and the low 32 bits of the XXH64 of its content; then number of frames,
  descriptor, magic number; an empty skippable frame ends the file.

Texts are range-partitioned by document key, encoded and compressed in key order and written
by Spark's text writer, whose line separator is the empty skippable frame. So any store that
Spark knows will do, and a lost or repeated task leaves one committed copy.

Null text is an empty one: its only id is the end id. Null keys come first. Rows that share a
key (or are equal) each have their own frame. An empty table writes no frame.
"""

from __future__ import annotations

import io
import math
import struct
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import shared_dir
from .common import small_batches, written
from .tokens import VOCABULARY, Encoder

SEPARATOR = "P*M\x18\x00\x00\x00\x00"       # magic 0x184D2A50, size 0
KEYS_MAGIC, TABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A51, 0x184D2A5E, 0x8F92EAB1
CHECKED = 0x80                              # descriptor: the table has checksums
FILE_TEXT_BYTES = 32 << 20                  # text that goes into one file, about
LEVEL = 3


def frame(content: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(content)


def trailer(keys: list[int | None], width: int, entries: list[tuple[int, int, int]]) -> bytes:
    """Key frame and seek table; ``entries``: compressed size, decompressed size, checksum."""
    own = (bytes([width]) + bytes(k is not None for k in keys)
           + np.array([k or 0 for k in keys], "<i8").tobytes())
    table = (np.array(entries, "<u4").tobytes() if entries else b"") + struct.pack("<IBI", len(entries), CHECKED, SEEKABLE_MAGIC)
    return struct.pack("<II", KEYS_MAGIC, len(own)) + own + struct.pack("<II", TABLE_MAGIC, len(table)) + table


class TokenFile:
    """Random access to a token file through any object with ``seek`` and ``read``: opening it
    reads its end, ``ids(i)`` reads and decompresses one document's frame and checks it."""

    def __init__(self, file) -> None:
        self.file = file
        end = file.seek(0, io.SEEK_END) - len(SEPARATOR)
        n, descriptor, magic = struct.unpack("<IBI", self._read(end - 9, 9))
        if magic != SEEKABLE_MAGIC or descriptor != CHECKED:
            raise ValueError("not a token file")
        self.table = np.frombuffer(self._read(end - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        size = 1 + 9 * n
        own = self._read(end - 9 - 12 * n - 8 - size, size)
        self.dtype = np.dtype(f"<u{own[0]}")
        keys = np.frombuffer(own[1 + n:], "<i8").tolist()
        self.keys = [k if has else None for k, has in zip(keys, own[1:1 + n], strict=True)]
        self.at = np.concatenate(([0], np.cumsum(self.table[:, 0], dtype=np.int64)))
        self.n_ids = self.table[:, 1].astype(np.int64) // self.dtype.itemsize

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def __len__(self) -> int:
        return len(self.table)

    def ids(self, i: int) -> np.ndarray:
        size, raw, check = (int(x) for x in self.table[i])
        content = zstandard.ZstdDecompressor().decompress(
            self._read(int(self.at[i]), size - len(SEPARATOR)), max_output_size=raw)
        if len(content) != raw or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check:
            raise ValueError(f"checksum of document {i}")
        return np.frombuffer(content, self.dtype).astype(np.uint32)


def write(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", vocabulary: str = VOCABULARY,
          file_text_bytes: int = FILE_TEXT_BYTES) -> None:
    """Encode every whole text and write the ids in ascending ``key`` order, file by file. Texts are
    range-partitioned and sorted before they are encoded, so that nothing is encoded twice."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    files = max(1, math.ceil(size / file_text_bytes))
    order = ["key", "tie"]                      # rows of one key: by a hash of their text
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    placed = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).select("key", "text")
    small_batches(docs.sparkSession)

    def lines(batches):
        encoder = Encoder.shared(vocabulary)
        width = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        keys, entries = [], []
        for b in batches:
            frames = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                content = encoder.ids(t).astype(f"<u{width}").tobytes()
                frames.append(frame(content))
                keys.append(k)
                entries.append((len(frames[-1]) + len(SEPARATOR), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["value"])
        if entries:
            yield pa.RecordBatch.from_arrays([pa.array([trailer(keys, width, entries)], pa.binary())], names=["value"])

    (placed.mapInArrow(lines, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", SEPARATOR).text(path))


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """From the files: key, start (ids of all documents before), n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), file and frame number. Each file is one task's row."""
    small_batches(spark)

    def frames(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                file = TokenFile(pa.BufferReader(content.as_buffer()))
                n = len(file)
                crc = [zlib.crc32(file.ids(i).astype("<u4").tobytes()) for i in range(n)]
                starts = np.cumsum(file.n_ids) - file.n_ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(range(n), pa.int64()), pa.array(file.keys, pa.int64()),
                     pa.array(starts), pa.array(file.n_ids), pa.array(crc, pa.int64())],
                    names=["file", "frame", key, "inside", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    rows = written(files.mapInArrow(frames, f"file string, frame long, {key} long, inside long, n_tokens long, ids_crc32 long"),
                   "token_rows")
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))      # one row per file
    number = F.regexp_extract("file", "part-([0-9]+)", 1).cast("long")    # files are numbered in key order
    before = Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return rows.join(starts, "file").select(key, (F.col("first") + F.col("inside")).alias("start"),
                                            "n_tokens", "ids_crc32", "file", "frame")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` to token files in the shared folder and read them back."""
    spark = docs.sparkSession
    path = shared_dir(spark, "llm", "token_files", unique=True)
    write(docs, path, **options)
    return read(spark, path, options.get("key", "doc_id"))
