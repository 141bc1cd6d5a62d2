"""Token files of independent zstandard frames with a trailing seek table.

A file holds the ids of whole documents, ascending by document id, as little-endian unsigned 32-bit integers:

* data frames of about `frame_ids` ids (a longer document is a frame of its own), each with zstandard's own check sum;
* one frame with the documents of the file (an Arrow stream of id and n_tokens);
* a skippable frame, which zstandard's readers pass over: for each frame its compressed size, its size and the crc32
  of its content, then the number of frames, the ids of the same partition before this file, the partition, the
  file's number in it, and a mark that ends the file.

So a reader finds a document with the last bytes, the frame of documents and one data frame. Files are written by
Spark's own writer, one row per file, so they appear with its commit and in any file system it knows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from typing import Any
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.llm.tokens import encoder, tokenizer_description
from accrue.llm.words import blocks
from accrue.sources.shared import CLEAN_UP

FRAME_IDS = 1 << 16
FILE_BYTES = 4 << 20
PARTITION_BYTES = 32 << 20
SKIPPABLE = 0x184D2A5E
MARK = b"token seek table\n"  # the writer adds its last byte
_ENTRY, _FOOTER, _HEADER = struct.Struct("<QQI"), struct.Struct("<IQII"), struct.Struct("<II")


class _File:
    """A file in the making."""

    def __init__(self, part: int, number: int, before: int, frame_ids: int, kind: pa.DataType):
        self.part, self.number, self.before, self.frame_ids, self.kind = part, number, before, frame_ids, kind
        self.frames: list[bytes] = []
        self.table: list[tuple[int, int, int]] = []
        self.open: list[bytes] = []
        self.held = self.size = self.total = 0
        self.ids: list[pa.Array] = []
        self.counts: list[np.ndarray] = []

    def _frame(self, content: bytes) -> None:
        packed = zstandard.ZstdCompressor(level=3, write_checksum=True).compress(content)
        self.frames.append(packed)
        self.table.append((len(packed), len(content), crc32(content)))
        self.size += len(packed)

    def add(self, raw: bytes) -> None:
        """One document's ids."""
        if self.held and (self.held + len(raw)) > 4 * self.frame_ids:
            self.close_frame()
        self.open.append(raw)
        self.held += len(raw)
        self.total += len(raw) // 4

    def close_frame(self) -> None:
        if self.open:
            self._frame(b"".join(self.open))
            self.open, self.held = [], 0

    def body(self) -> bytes:
        """All bytes but the last one, which the writer adds."""
        self.close_frame()
        counts = pa.array(np.concatenate(self.counts) if self.counts else [], pa.int64())
        ids = pa.concat_arrays(self.ids) if self.ids else pa.array([], self.kind)
        batch = pa.RecordBatch.from_arrays([ids, counts], names=["id", "n_tokens"])
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, batch.schema) as writer:
            writer.write_batch(batch)
        self._frame(out.getvalue().to_pybytes())
        table = b"".join(_ENTRY.pack(*e) for e in self.table) + _FOOTER.pack(len(self.table), self.before, self.part, self.number) + MARK
        return b"".join(self.frames) + _HEADER.pack(SKIPPABLE, len(table)) + table[:-1]


class TokenFile:
    """A file's bytes, read by its seek table."""

    def __init__(self, content: bytes | memoryview):
        self.content = memoryview(content)
        if bytes(self.content[-len(MARK) :]) != MARK:
            raise ValueError("no token file: the mark at its end is missing")
        at = len(content) - len(MARK) - _FOOTER.size
        n, self.before, self.part, self.number = _FOOTER.unpack(self.content[at : at + _FOOTER.size])
        table = self.content[at - n * _ENTRY.size : at]
        self.table = [_ENTRY.unpack_from(table, i * _ENTRY.size) for i in range(n)]
        self.begin = np.concatenate(([0], np.cumsum([e[0] for e in self.table]))).tolist()

    @property
    def n_ids(self) -> int:
        return sum(size for _, size, _ in self.table[:-1]) // 4

    def frame(self, k: int) -> bytes:
        _, size, check = self.table[k]
        content = zstandard.ZstdDecompressor().decompress(self.content[self.begin[k] : self.begin[k + 1]], max_output_size=size)
        if len(content) != size or crc32(content) != check:
            raise ValueError(f"frame {k} is damaged")
        return content

    def documents(self) -> tuple[pa.Array, np.ndarray]:
        with pa.ipc.open_stream(self.frame(len(self.table) - 1)) as reader:
            table = reader.read_all()
        return table["id"].combine_chunks(), table["n_tokens"].to_numpy()

    def read(self, places: Iterable[int] | None = None) -> Iterator[tuple[int, memoryview]]:
        """(place in the file, ids as bytes) of the documents at `places`, or of all; only their frames are decompressed."""
        _, counts = self.documents()
        end = np.cumsum(counts) * 4
        frame_end = np.cumsum([size for _, size, _ in self.table[:-1]])
        open_, content, first = -1, memoryview(b""), 0
        for place in range(len(counts)) if places is None else sorted(places):
            stop = int(end[place])
            k = int(np.searchsorted(frame_end, stop, "left"))
            if k != open_:
                open_, content, first = k, memoryview(self.frame(k)), int(frame_end[k - 1]) if k else 0
            yield place, content[stop - 4 * int(counts[place]) - first : stop - first]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text: str = "text", frame_ids: int = FRAME_IDS, file_bytes: int = FILE_BYTES, partition_bytes: int = PARTITION_BYTES) -> None:
    """Write the ids of every row's text, with the end id 0 behind each, in ascending order of id (null first).

    A null text is empty. Rows of one id stand next to each other in order of their texts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    description = tokenizer_description(spark, tokenizer)
    ordered = rows.repartitionByRange(max(1, -(-size // partition_bytes)), "id").sortWithinPartitions("id", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before, file = TaskContext.get().partitionId(), 0, 0, None
        for held in batches:
            for batch in blocks(held, "text"):
                ids, total = encoder(description).encode(batch.column(1))
                raw = memoryview(ids.astype("<u4").tobytes())
                end = np.cumsum(total)
                begun = 0
                for row in range(len(batch)):
                    if file is None:
                        file, begun = _File(part, number, before, frame_ids, batch.column(0).type), row
                    file.add(bytes(raw[4 * (int(end[row]) - int(total[row])) : 4 * int(end[row])]))
                    if file.size >= file_bytes:
                        file.ids.append(batch.column(0).slice(begun, row + 1 - begun))
                        file.counts.append(total[begun : row + 1])
                        yield pa.RecordBatch.from_arrays([pa.array([file.body()], pa.large_binary()).cast(pa.binary())], names=["body"])
                        number, before, file = number + 1, before + file.total, None
                if file is not None:
                    file.ids.append(batch.column(0).slice(begun, len(batch) - begun))
                    file.counts.append(total[begun:])
        if file is not None:
            yield pa.RecordBatch.from_arrays([pa.array([file.body()], pa.binary())], names=["body"])

    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        ordered.mapInArrow(pack, "body binary").select(F.col("body").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)
    finally:
        spark.conf.set(CLEAN_UP, before)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).where("length > 0").select("content")


def read_token_files(spark: SparkSession, path: str, kind: T.DataType, ids: list[Any] | None = None, with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of all documents of the files, or of those asked for.

    start counts the ids of all documents before it. `ids` is a short list; only the frames of these documents are decompressed.
    """

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = [TokenFile(c.as_buffer()) for c in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([f.part for f in files], pa.int64()), pa.array([f.n_ids for f in files], pa.int64())], names=["part", "n"])

    # one row for each partition of the writer
    parts = sorted((r.part, r.n) for r in _files(spark, path).mapInArrow(totals, "part long, n long").groupBy("part").agg(F.sum("n").alias("n")).collect())
    base = dict(zip([p for p, _ in parts], np.concatenate(([0], np.cumsum([n for _, n in parts])))[:-1].tolist(), strict=True))
    shared = spark.sparkContext.broadcast(base)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                file = TokenFile(content.as_buffer())
                names, counts = file.documents()
                places = np.arange(len(counts)) if ids is None else np.flatnonzero([x in ids for x in names.to_pylist()])
                start = np.cumsum(counts) - counts + file.before + shared.value[file.part]
                found = [(crc32(x), np.frombuffer(x, "<u4").astype(np.int64) if with_ids else None) for _, x in file.read(places.tolist())]
                columns = [names.take(pa.array(places, pa.int64())), pa.array(start[places], pa.int64()), pa.array(counts[places], pa.int64()), pa.array([check for check, _ in found], pa.int64())]
                if with_ids:
                    columns.append(pa.array([x for _, x in found], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    fields = [T.StructField("id", kind), *(T.StructField(n, T.LongType()) for n in ("start", "n_tokens", "ids_crc32"))]
    return _files(spark, path).mapInArrow(documents, T.StructType(fields + [T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids))
