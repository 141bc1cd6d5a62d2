"""Words of whole texts as flat numpy arrays, straight from Arrow buffers.

A task sees its rows in Arrow batches. `blocks` cuts a batch into runs of rows of a
bounded number of text bytes (a longer text is a block of its own), and `Words`
finds the words of all texts of a block at once, without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words are separated by ASCII white space: [^\x20\x09-\x0D]+
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
#: Words are digits, lower-case letters and all beyond ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, one text behind the other, and where each begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, at - at[0]


def blocks(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most `limit` text bytes, or one row."""
    _, at = text_bytes(batch.column(batch.schema.get_field_index(text)))
    row = 0
    while row < len(batch):
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def seeded(seed: int) -> tuple[np.ndarray, int]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1), int(rng.integers(1 << 40, 1 << 63)) | 1


class Words:
    """The words of a column of texts.

    starts, ends: byte positions in `data`; doc: the row of each word; first: the index of each row's first word, with
    the number of words at the end.
    """

    def __init__(self, column: pa.Array, members: np.ndarray = SPACED, lower: bool = False):
        data, at = text_bytes(column)
        self.data, self.at = LOWER[data] if lower else data, at
        inside = members[self.data]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edges = at[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        begins[edges] = inside[edges]
        stops[edges - 1] = inside[edges - 1]
        self.inside = inside
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, at)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(at) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int = 1) -> np.ndarray:
        """A 64-bit hash of each word; equal words have equal hashes in every block and task."""
        if not len(self):
            return np.zeros(0, np.uint64)
        table, base = seeded(seed)
        lengths = self.ends - self.starts
        begin = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
        value = table[self.data[self.inside]] * powers(base, int(lengths.max()))[place]
        return mixed(np.add.reduceat(value, begin) + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def rolling(hashes: np.ndarray, size: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """The hash of each run of `size` consecutive values (by their first), by doubling the length of the runs."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, have, run, length = None, 0, hashes, 1
    while True:
        if size & length:
            if out is None:
                out = run
            else:
                keep = len(run) - have
                out = out[:keep] * np.uint64(pow(base, length, 1 << 64)) + run[have : have + keep]
            have += length
        if have == size:
            return mixed(out[:n])
        run = run[: len(run) - length] * np.uint64(pow(base, length, 1 << 64)) + run[length:]
        length *= 2


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each run of `size` consecutive values."""
    length = 1
    while length * 2 <= size:
        values = np.minimum(values[: len(values) - length], values[length:])
        length *= 2
    return values if length == size else np.minimum(values[: len(values) - (size - length)], values[size - length :])


def whole(doc: np.ndarray, size: int) -> np.ndarray:
    """Which runs of `size` consecutive words, by their first word, lie in one row."""
    n = max(0, len(doc) - size + 1)
    return doc[:n] == doc[size - 1 : size - 1 + n] if n else np.zeros(0, bool)


def counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, with their counts or sums of weights; by sorting, which is faster here than hashing."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    if weights is None:
        values = np.sort(values)
    else:
        order = np.argsort(values, kind="stable")
        values, weights = values[order], weights[order]
    begin = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    counts = np.diff(np.append(begin, len(values))) if weights is None else np.add.reduceat(weights, begin)
    return values[begin], counts


def ragged(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices begin[i], begin[i] + 1, ... of all runs, one run behind the other."""
    out = np.arange(int(lengths.sum()))
    return out + np.repeat(begin - (np.cumsum(lengths) - lengths), lengths)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def string_array(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """Texts from their bytes and where each begins."""
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.string())


def joined(words: Words, kept: np.ndarray) -> pa.Array:
    """Of each row its kept words, joined by one space."""
    doc, lengths = words.doc[kept], (words.ends - words.starts)[kept]
    spaced = np.zeros(len(doc), dtype=np.int64)
    spaced[:-1] = doc[1:] == doc[:-1]
    after = np.cumsum(lengths + spaced)
    out = np.full(int(after[-1]) if len(after) else 0, 32, dtype=np.uint8)
    letters = np.ones(len(out), dtype=bool)
    letters[after[spaced == 1] - 1] = False
    held = words.data[words.inside]
    out[letters] = held if kept.all() else held[np.repeat(kept, words.ends - words.starts)]
    at = np.concatenate(([0], after))[np.searchsorted(doc, np.arange(len(words.counts) + 1))]
    return string_array(out, at)
