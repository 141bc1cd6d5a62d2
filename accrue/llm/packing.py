"""Best-fit packing of documents into sequences, certified by lower bounds.

Documents become pieces of at most `size` ids. Pieces are dealt into groups of about `group_rows`; each group is packed
by best-fit decreasing and bounded from below by dual-feasible functions over its lengths: identity, the threshold
functions (large items count whole, small ones nothing) and the rounding functions u(k). A group that needs no more
bins than its bound is certified and stays. Groups with gaps exchange their pieces (dealt anew by another hash) and are
packed again; a new deal is kept if it needs fewer bins. Groups are of a bounded size at any size of the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.llm.tokens import encoder, tokenizer_description
from accrue.llm.words import blocks, list_array
from accrue.sources.shared import written

SIZE = 2048
GROUP_ROWS = 1 << 16
ROUNDS = 3
ROUNDING = 64


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): the ids of each text and the end id 0, cut into pieces.

    Texts of more than `size` ids are cut into pieces of `size`; the first piece is the shorter one. A null text is empty,
    so every row has a piece. The check sum is over the ids as little-endian unsigned 32-bit integers.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    description = tokenizer_description(docs.sparkSession, tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in batches:
            for batch in blocks(held, "text"):
                ids, total = encoder(description).encode(batch.column(1))
                n = -(-total // size)
                doc = np.repeat(np.arange(len(total)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                head = total - (n - 1) * size
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * size)
                length = np.where(piece == 0, head[doc], size)
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(length).tolist()
                sums = [crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends, length.tolist(), strict=True)]
                columns = [batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(sums, pa.int64())]
                if with_ids:
                    columns.append(list_array(ids.astype(np.int32), length, pa.int32()))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(cut, schema)


def best_fit(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, given longest first: the fullest bin that has room, else a new one."""
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r: some bin has room r
    bins, offsets, n = [], [], 0
    for length in lengths:
        fitting = rooms >> length
        if fitting and length:
            room = length + (fitting & -fitting).bit_length() - 1
            place = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, place = size, n
            n += 1
        bins.append(place)
        offsets.append(size - room)
        left = room - length
        if left:
            by_room[left].append(place)
            rooms |= 1 << left
    return bins, offsets


def least_bins(lengths: np.ndarray, size: int) -> int:
    """The largest of the dual-feasible bounds on the number of bins."""
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=size + 1)
    length = np.arange(size + 1)
    total = np.concatenate(([0], np.cumsum(counts * length)))
    number = np.concatenate(([0], np.cumsum(counts)))
    low = np.arange(size // 2 + 1)  # below it nothing, above size - low a whole bin
    middle = total[size - low + 1] - total[low]
    large = number[size + 1] - number[size - low + 1]
    best = int((large + -(-middle // size)).max())
    for k in range(1, ROUNDING + 1):
        scaled = (k + 1) * length
        value = np.where(scaled % size == 0, k * length, scaled // size * size)
        best = max(best, int(-(-int((counts * value).sum()) // (k * size))))
    return best


def pack(rows: DataFrame, size: int = SIZE, group_rows: int = GROUP_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to `rows` of (id, piece, length, ...), and the bins and the bound of the piece's group.

    Lengths are from 1 to `size`. Pieces of a group are placed longest first, ties by id and piece.
    """
    # a number of its own for each piece: pieces of one id, or without any, are dealt as evenly as others
    rows = written(rows.withColumn("_number", F.monotonically_increasing_id()), "pieces")
    n_groups = max(1, -(-rows.count() // group_rows))
    fields = [*rows.schema.fields, T.StructField("group", T.LongType()), T.StructField("bin", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("bins", T.LongType()), T.StructField("bound", T.LongType())]

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("id", "ascending"), ("piece", "ascending")])
        lengths = group["length"].to_numpy()
        bins, offsets = best_fit(lengths.tolist(), size)
        added = {"bin": bins, "offset": offsets, "bins": [max(bins) + 1] * len(bins), "bound": [least_bins(lengths, size)] * len(bins)}
        for name, values in added.items():
            group = group.append_column(name, pa.array(values, pa.int64()))
        return group

    def deal(of: DataFrame, salt: int, n: int, first: int) -> DataFrame:
        group = F.pmod(F.xxhash64("_number", F.lit(salt)), F.lit(n)) + first
        return written(of.withColumn("group", group.cast("long")).groupBy("group").applyInArrow(packed, T.StructType(fields)), "packed")

    def gaps(of: DataFrame) -> tuple[int, int]:
        one = of.where("bins > bound").groupBy("group").agg(F.first("bins").alias("bins"))
        return one.agg(F.count("*"), F.coalesce(F.sum("bins"), F.lit(0))).first()

    closed, now, first = None, deal(rows, 0, n_groups, 0), n_groups
    for salt in range(1, rounds + 1):
        n, bins = gaps(now)
        if n < 2:
            break
        sure = now.where("bins <= bound")
        again = deal(now.where("bins > bound").select(*rows.columns), salt, n, first)
        first += n
        if again.groupBy("group").agg(F.first("bins").alias("bins")).agg(F.sum("bins")).first()[0] >= bins:
            break
        closed, now = sure if closed is None else closed.union(sure), again
    out = now if closed is None else closed.union(now)
    return out.withColumn("sequence_id", F.shiftleft("group", 32) + F.col("bin")).drop("group", "bin", "_number")
