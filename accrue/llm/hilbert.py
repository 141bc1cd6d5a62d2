"""Packing of documents along a space-filling curve.

Each text becomes token ids and a short hashed vector: a token's id is hashed to one of `BUCKETS` signed directions, and the
mean over a document's tokens is projected to `DIMS` dimensions. Both are linear, so a table gives each id its projected
direction. The projections, standardised over all documents, are the coordinates of a point in a cube, and the place of the
point on the Hilbert curve through the cube is the document's key. Documents are range-sorted by key, so that those of like
vocabulary lie side by side and copies next to each other, and each range is packed by one pass along the curve: a sequence
is filled to its last place and the document at its end goes on in the next. What is left at the end of a range is laid out
in sequences of falling powers of two, which need no padding either.

Equal keys are told apart by the row, so that copies, however many, are spread over ranges.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrue.llm.tokens import Encoder, tokenizer_description
from accrue.llm.words import blocks, mixed, ragged, text_bytes
from accrue.sources.shared import written

SIZE, END = 4096, 2
BUCKETS, DIMS, BITS = 64, 4, 15
RANGE_IDS, LEAST_IDS, LEAST_WAYS = 1 << 25, 1 << 21, 64
#: Normalisers and the pre-tokenizer after which white space only separates: no id depends on what is beyond it.
_SEPARATES = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
#: Fixed value of the public vocabulary's format: what its tokens are cut from; none of it matches white space.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_AXES = [f"x{d}" for d in range(DIMS)]


class WordEncoder(Encoder):
    """Ids of texts, `end` behind each; stretches between white space are encoded once where the tokenizer allows it."""

    def __init__(self, description: str, end: int = END):
        super().__init__(description)
        told = json.loads(description)
        first = (told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not any(c.isspace() for c in t["content"]) for t in told.get("added_tokens", []))
        splits = first[0].get("type") == "Split" and first[0].get("behavior") == "Removed" and first[0].get("invert") and first[0]["pattern"].get("Regex") == _WORD_PATTERN
        if (told.get("normalizer") or {}).get("normalizers") == _SEPARATES and plain and splits and len(first) == 2 and first[1].get("type") == "ByteLevel" and not first[1]["use_regex"]:
            self.cut = True
        self.end = end
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, total = super().encode(column)
        ids[np.cumsum(total) - 1] = self.end
        return ids, total


_KNOWN: dict[int, WordEncoder] = {}


def _encoder(description: Broadcast, end: int) -> WordEncoder:
    key = hash((description.value, end))
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = WordEncoder(description.value, end)
    return _KNOWN[key]


def directions(n: int, buckets: int = BUCKETS, dims: int = DIMS) -> np.ndarray:
    """The projected direction of each of n token ids: that of its bucket, with the sign of its hash."""
    hashes = mixed(np.arange(1, n + 1, dtype=np.uint64))
    sign = 1.0 - 2.0 * (hashes >> np.uint64(63)).astype(np.float64)
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    return sign[:, None] * np.random.default_rng(13).normal(size=(buckets, dims))[bucket]


def tokens_and_points(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """(id, n, ids, x0, ...): the ids of each row's text and the end as little-endian numbers, and its projected vector.

    A null text is empty. Texts without a token have the vector 0; the end has no part in a vector.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    description = tokenizer_description(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(description, end)
        table = directions(own.tokenizer.get_vocab_size())
        for held in batches:
            for batch in blocks(held, "text"):
                ids, total = own.encode(batch.column(1))
                at = np.concatenate(([0], np.cumsum(total)))
                ids[at[1:] - 1] = 0
                sums = np.stack([np.add.reduceat(table[ids, d], at[:-1]) for d in range(DIMS)], axis=1) - table[0]
                ids[at[1:] - 1] = end
                points = np.round(sums / np.maximum(total - 1, 1)[:, None], 6)
                raw = pa.Array.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer((at * own.kind.itemsize).tobytes()), pa.py_buffer(ids.astype(own.kind).tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), raw.cast(pa.binary()), *(pa.array(points[:, d]) for d in range(DIMS))], names=["id", "n", "ids", *_AXES])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n long, ids binary, " + ", ".join(f"{x} double" for x in _AXES))


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (a row each) with `bits` bits per dimension.

    From the highest bit down, the cell's half in each dimension turns or exchanges the lower bits, as the curve does
    within its quadrants; the Gray code of the halves, read across the dimensions, is the place.
    """
    x = [cells[:, d].astype(np.int64) for d in range(cells.shape[1])]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(len(x)):
            upper = (x[d] >> bit & 1).astype(bool)
            swap = np.where(upper, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] = x[d] ^ swap
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(len(x)):
            key = key << 1 | (x[d] ^ turn) >> bit & 1
    return key


def curve_keys(points: DataFrame) -> DataFrame:
    """`points` with `key`, the place on the curve; each axis is measured over all rows and cut evenly by the normal curve."""
    row = points.agg(*[f(x) for x in _AXES for f in (F.avg, F.stddev_pop)]).first()
    middle, spread = np.array([v or 0.0 for v in row[::2]]), np.array([v or 1.0 for v in row[1::2]])

    @F.pandas_udf("long")
    def key(*axes: pd.Series) -> pd.Series:
        z = (np.stack([a.to_numpy() for a in axes], axis=1) - middle) / spread
        share = 1 / (1 + np.exp(-1.702 * np.clip(z, -20, 20)))  # within a hundredth of the normal curve
        return pd.Series(hilbert_key(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS))

    return points.withColumn("key", key(*_AXES))


def falling_powers(n: int) -> list[int]:
    """n as a sum of powers of two, the largest first."""
    return [1 << bit for bit in range(n.bit_length() - 1, -1, -1) if n >> bit & 1]


class _Line:
    """Pieces of documents laid one behind the other: of each its row's id, start, length, document's tokens, and raw ids."""

    def __init__(self, ids: pa.Array, start: np.ndarray, length: np.ndarray, total: np.ndarray, raw: np.ndarray):
        self.ids, self.start, self.length, self.total, self.raw = ids, start, length, total, raw

    def cut(self, edges: np.ndarray, begin: int) -> tuple[_Line, np.ndarray, np.ndarray]:
        """Pieces cut at `edges`, ascending places of a line whose first piece lies at `begin`; of each the last edge before it, and its distance."""
        ends = begin + np.cumsum(self.length)
        begins = ends - self.length
        first = np.searchsorted(edges, begins, "right") - 1
        count = np.searchsorted(edges, ends, "left") - first
        of, edge = np.repeat(np.arange(len(begins)), count), ragged(first, count)
        low = np.maximum(begins[of], edges[edge])
        high = np.minimum(ends[of], np.append(edges, np.iinfo(np.int64).max)[edge + 1])
        line = _Line(self.ids.take(pa.array(of)), self.start[of] + low - begins[of], high - low, self.total[of], self.raw)
        return line, edge, low - edges[edge]

    def split(self, n: int) -> tuple[_Line, _Line]:
        """The first n pieces, and the others."""
        at = int(self.length[:n].sum())
        return _Line(self.ids[:n], self.start[:n], self.length[:n], self.total[:n], self.raw[:at]), _Line(self.ids[n:], self.start[n:], self.length[n:], self.total[n:], self.raw[at:])

    def joined(self, other: _Line) -> _Line:
        both = [np.concatenate((getattr(self, c), getattr(other, c))) for c in ("start", "length", "total", "raw")]
        return _Line(pa.concat_arrays([self.ids, other.ids]), *both)

    def batch(self, sequence: np.ndarray, offset: np.ndarray) -> pa.RecordBatch:
        raw, ends = memoryview(self.raw.astype("<u4").tobytes()), np.cumsum(self.length).tolist()
        sums = [crc32(raw[4 * (end - n) : 4 * end]) for end, n in zip(ends, self.length.tolist(), strict=True)]
        columns = [self.ids, *(pa.array(c, pa.int64()) for c in (self.start, self.length, sums, self.total, sequence, offset))]
        return pa.RecordBatch.from_arrays(columns, names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def pack_along_curve(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", size: int = SIZE, end: int = END, range_ids: int = RANGE_IDS, least_ids: int = LEAST_IDS) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece, in sequences of at most `size` ids.

    Every row has its ids and the end in one piece or more. A sequence holds `size` ids, or a power of two of them. Rows
    that repeat, or share an id or have none, are packed one by one; an empty table has no pieces.
    """
    held = written(tokens_and_points(docs, tokenizer, id_col, text, end), "ids")
    total = held.agg(F.sum("n")).first()[0] or 0
    ways = max(1, -(-total // range_ids), min(LEAST_WAYS, -(-total // least_ids)))
    rows = curve_keys(held.withColumn("row", F.monotonically_increasing_id())).select("key", "row", "id", "n", "ids")
    kind = held.schema["id"].dataType.simpleString()
    wide = tokenizer_width(tokenizer)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, at, open_line = TaskContext.get().partitionId() << 40, 0, None
        for batch in batches:
            if not len(batch):
                continue
            n = batch.column(1).to_numpy()
            line = _Line(batch.column(0), np.zeros(len(n), np.int64), n, n, text_bytes(batch.column(2))[0].view(wide))
            first = at // size
            line, edge, offset = line.cut(np.arange(first, (at + int(n.sum())) // size + 1) * size, at)
            before, at = at, at + int(n.sum())
            if at // size == first:
                open_line = line if open_line is None else open_line.joined(line)
                continue
            if open_line is not None:
                yield open_line.batch(np.full(len(open_line.length), base + first), before - first * size - np.cumsum(open_line.length[::-1])[::-1])
            full = int(np.searchsorted(edge, at // size - first))
            done, rest = line.split(full)
            yield done.batch(base + first + edge[:full], offset[:full])
            open_line = rest if len(rest.length) else None
        if open_line is not None:
            powers = np.array(falling_powers(int(open_line.length.sum())))
            line, edge, offset = open_line.cut(np.cumsum(powers) - powers, 0)
            yield line.batch(base + at // size + edge, offset)

    ranges = rows.repartitionByRange(ways, "key", "row").sortWithinPartitions("key", "row").select("id", "n", "ids")
    return ranges.mapInArrow(lay, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def tokenizer_width(tokenizer: str) -> np.dtype:
    with open(tokenizer, encoding="utf-8") as file:
        return WordEncoder(file.read()).kind
