"""Quality classifier on random-indexing word vectors.

Words are runs of letters, runs of digits and single marks; `again` in place of a word that repeats the one before.
Random indexing: each word has a fixed sparse vector of a few +1 and -1, by the bits of its 64-bit hash; its context
vector is the sum of those of its neighbours up to two places away, over all texts of the corpus. Tasks add up their
own texts, the sums are shuffled by hash. Every distinct word has a vector of its own: those of the `COMMON` most
frequent are broadcast, all others are joined by hash. A document is the mean of its words' unit vectors. A two-layer network, fitted in
numpy on at most `fit_rows` labelled rows, gives the probability; its temperature is fitted on a fifth of those rows
that the network doesn't see. `fit_rows` bounds the fit only, vectors and scores cover all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.llm.frequent import most_frequent
from accrue.llm.words import Words, blocks, list_array, mixed, ragged, text_bytes
from accrue.sources.shared import written

DIMS, MARKS, REACH = 32, 4, 2
COMMON = 1 << 19
_WIDTHS = DIMS // 2, DIMS, 8 * DIMS
_MAX_HELD = 1 << 19  # rows of sums in a task before they are merged; half as many distinct words before they are passed on
FIT_ROWS = 20_000
HIDDEN = 32
_PART = 1 << 15
_KINDS = np.full(256, 3, np.uint8)  # 0 space, 1 letter, 2 digit, 3 mark
_KINDS[:33] = 0
_KINDS[48:58] = 2
_KINDS[65:91] = _KINDS[97:123] = _KINDS[128:] = 1
_KINDS[10] = 3


def _index_vectors(keys: np.ndarray) -> np.ndarray:
    """The fixed vectors of words: `MARKS` different places and their signs, by the bits of the hash."""
    bits = mixed(keys.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros((len(keys), DIMS), np.int8)
    row, order = np.arange(len(keys)), np.broadcast_to(np.arange(DIMS, dtype=np.int8), (len(keys), DIMS)).copy()
    for k in range(MARKS):
        at = k + (bits >> np.uint64(12 * k) & np.uint64(0x3FF)).astype(np.int64) % (DIMS - k)
        place = order[row, at]
        order[row, at] = order[:, k]
        out[row, place] = np.where(bits >> np.uint64(12 * k + 11) & np.uint64(1), 1, -1)
    return out


class _Tokens(Words):
    """Runs of one kind of character, marks alone."""

    def __init__(self, column: pa.Array):
        super().__init__(column, np.ones(256, bool))
        kind = _KINDS[self.data]
        begins = kind == 3
        if len(kind):
            begins[0] = kind[0] != 0
            begins[1:] |= (kind[1:] != 0) & ((kind[1:] != kind[:-1]))
            edges = self.at[:-1]
            edges = edges[edges < len(kind)]
            begins[edges] = kind[edges] != 0
        self.inside = kind != 0
        self.starts = np.flatnonzero(begins)
        lengths = np.add.reduceat(self.inside.astype(np.int64), self.starts) if len(self.starts) else np.zeros(0, np.int64)
        self.ends = self.starts + lengths
        self.first = np.searchsorted(self.starts, self.at)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.at) - 1), self.counts)

    def keys(self) -> np.ndarray:
        hashes = self.hashes(5)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (self.doc[1:] == self.doc[:-1])
        return np.where(again, np.uint64(0), hashes).view(np.int64)


class Vectors(np.ndarray):
    """Unit context vectors of the most frequent words, one row a word; `keys` are their hashes in order.

    `rest` holds the sums of all other words as a table (key, sums), or None where there are no others; it reads `table`,
    which is that of `written` with all words.
    """

    keys: np.ndarray
    rest: DataFrame | None
    table: DataFrame


def _packed(sums: np.ndarray) -> pa.Array:
    """Sums as bytes: half a byte for each where all of a row are below 8, one where they are below 128, else eight."""
    most = np.abs(sums).max(axis=1, initial=0)
    wide = np.where(most < 8, 0, np.where(most < 128, 1, 2))
    lengths = np.array(_WIDTHS)[wide]
    at = np.concatenate(([0], np.cumsum(lengths)))
    data = np.empty(int(at[-1]), np.uint8)
    half = (sums[wide == 0] + 8).astype(np.uint8)
    for k, held in enumerate((half[:, ::2] | half[:, 1::2] << 4, sums[wide == 1].astype(np.int8), np.ascontiguousarray(sums[wide == 2], np.int64))):
        data[ragged(at[:-1][wide == k], lengths[wide == k])] = held.view(np.uint8).ravel()
    return pa.Array.from_buffers(pa.large_binary(), len(sums), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _unpacked(column: pa.Array) -> np.ndarray:
    data, at = text_bytes(column)
    lengths, out = np.diff(at), np.empty((len(at) - 1, DIMS), np.int64)
    half, small, large = (data[ragged(at[:-1][lengths == w], lengths[lengths == w])].reshape(-1, w) for w in _WIDTHS)
    out[lengths == _WIDTHS[0], ::2], out[lengths == _WIDTHS[0], 1::2] = (half & 15).astype(np.int64) - 8, (half >> 4).astype(np.int64) - 8
    out[lengths == _WIDTHS[1]] = small.view(np.int8)
    out[lengths == _WIDTHS[2]] = large.view(np.int64)
    return out


def _units(sums: np.ndarray) -> np.ndarray:
    norm = np.sqrt((sums.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return (sums / np.where(norm == 0, 1, norm)).astype(np.float32)


def _grouped(keys: np.ndarray, n: np.ndarray, sums: np.ndarray, kind: type = np.int64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    if not len(begin):
        return keys, n, sums.astype(kind)
    return keys[begin], np.add.reduceat(n[order], begin), np.add.reduceat(sums[order], begin, axis=0, dtype=kind)


def _sum_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, waiting = [], 0

    def out() -> pa.RecordBatch:
        # the sums of one task's texts fit four bytes
        keys, n, sums = _grouped(*(np.concatenate(x) for x in zip(*held, strict=True)), np.int32)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n, pa.int64()), _packed(sums)], names=["key", "n", "sums"])

    for whole in batches:
        for batch in blocks(whole, "text"):
            tokens = _Tokens(batch.column(0))
            keys = tokens.keys()
            if not len(keys):
                continue
            words, which = np.unique(keys, return_inverse=True)
            index = _index_vectors(words)[which]
            near = np.zeros((len(keys), DIMS), np.int8)
            for apart in range(1, REACH + 1):
                same = (tokens.doc[apart:] == tokens.doc[:-apart]).astype(np.int8)[:, None]
                near[:-apart] += index[apart:] * same
                near[apart:] += index[:-apart] * same
            order = np.argsort(which, kind="stable")
            n = np.bincount(which, minlength=len(words))
            held.append((words, n, np.add.reduceat(near[order], np.cumsum(n) - n, axis=0, dtype=np.int32)))
            waiting += len(words)
            if waiting > _MAX_HELD:
                merged = _grouped(*(np.concatenate(x) for x in zip(*held, strict=True)), np.int32)
                held, waiting = [merged], len(merged[0])
                if waiting > _MAX_HELD // 2:
                    yield out()
                    held, waiting = [], 0
    if held:
        yield out()


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one key, which follow each other, as one row."""
    last: tuple[np.ndarray, np.ndarray, np.ndarray] = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, DIMS), np.int64)

    def out(keys: np.ndarray, n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64()), _packed(sums)], names=["key", "n", "sums"])

    for batch in batches:
        now = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _unpacked(batch.column(2))
        keys, n, sums = _grouped(*(np.concatenate(x) for x in zip(last, now, strict=True)))
        last = keys[-1:], n[-1:], sums[-1:]
        yield out(keys[:-1], n[:-1], sums[:-1])
    yield out(*last)


def word_vectors(docs: DataFrame, text: str = "text", common: int = COMMON) -> Vectors:
    """Context vectors of all words of all rows of `docs`, one a word: the `common` most frequent here, the others as a table."""
    parts = docs.select(F.col(text).alias("text")).mapInArrow(_sum_neighbours, "key long, n long, sums binary")
    table = written(parts.repartition("key").sortWithinPartitions("key").mapInArrow(_add_up, "key long, n long, sums binary"), "vectors")
    best = most_frequent(table, common).toArrow().sort_by("key")
    units = [_units(_unpacked(part["sums"])) for part in best.combine_chunks().to_batches(_PART)]
    out = np.concatenate(units or [np.zeros((0, DIMS), np.float32)]).reshape(-1, DIMS).view(Vectors)
    out.keys, out.rest, out.table = best["key"].to_numpy(), None, table
    if table.count() > best.num_rows:
        n = best["n"].to_numpy()
        lowest, edge = (int(n.min()), int(out.keys[n == n.min()].max())) if len(n) else (np.iinfo(np.int64).max, 0)
        out.rest = table.where((F.col("n") < lowest) | ((F.col("n") == lowest) & (F.col("key") > edge))).select("key", "sums")
    return out


def pooled(rows: DataFrame, text: str, vectors: Vectors, carry: list[str]) -> DataFrame:
    """(carried, n, total): of each row the columns `carry`, the number of words and the sum of their unit vectors as bytes."""
    rest, joins = vectors.rest, vectors.rest is not None
    shared = rows.sparkSession.sparkContext.broadcast((vectors.keys, np.asarray(vectors)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, units = shared.value
        row = TaskContext.get().partitionId() << 36
        for whole in batches:
            for batch in blocks(whole, "text"):
                tokens = _Tokens(batch.column(1))
                keys = tokens.keys()
                at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
                common = known[at] == keys if len(known) else np.zeros(len(keys), bool)
                total = _sums_of(units[at[common]], tokens.doc[common], len(batch))
                rare_doc, rare_key = tokens.doc[~common], keys[~common]
                columns = [pa.array(np.arange(row, row + len(batch))), batch.column(0), pa.array(tokens.counts, pa.int64()), _bytes(total)]
                if joins:
                    columns.append(list_array(rare_key, np.bincount(rare_doc, minlength=len(batch)), pa.int64()))
                row += len(batch)
                yield pa.RecordBatch.from_arrays(columns, names=["row", "carried", "n", "total", "rare"][: len(columns)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = np.zeros(0, np.int64), np.zeros((0, DIMS))
        for batch in batches:
            own, units = np.concatenate((last, batch.column(0).to_numpy())), np.concatenate((held, _units(_unpacked(batch.column(1)))))
            begin = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
            sums = np.add.reduceat(units, begin, axis=0) if len(begin) else units
            last, held = own[begin][-1:], sums[-1:]
            yield pa.RecordBatch.from_arrays([pa.array(own[begin][:-1]), _bytes(sums[:-1])], names=["row", "more"])
        yield pa.RecordBatch.from_arrays([pa.array(last, pa.int64()), _bytes(held)], names=["row", "more"])

    own = rows.select(F.struct(*carry).alias("carried"), F.col(text).alias("text"))
    fields = [T.StructField("row", T.LongType()), own.schema["carried"], T.StructField("n", T.LongType()), T.StructField("total", T.BinaryType())]
    if not joins:
        return own.mapInArrow(measure, T.StructType(fields)).select("carried", "n", "total", F.lit(None).cast("binary").alias("more"))
    parts = written(own.mapInArrow(measure, T.StructType([*fields, T.StructField("rare", T.ArrayType(T.LongType()))])), "pooled")
    found = parts.select("row", F.explode("rare").alias("key")).join(rest, "key").repartition("row").sortWithinPartitions("row", "key")
    more = found.select("row", "sums").mapInArrow(add, "row long, more binary")
    return parts.join(more, "row", "left").select("carried", "n", "total", "more")


def _sums_of(units: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, DIMS))
    if len(doc):
        begin = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        out[doc[begin]] = np.add.reduceat(units, begin, axis=0, dtype=np.float64)
    return out


def _bytes(values: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(np.arange(len(values) + 1, dtype=np.int32) * 4 * DIMS), pa.py_buffer(np.ascontiguousarray(values, np.float32))])


def _means(batch: pa.RecordBatch) -> np.ndarray:
    """Of each row of `pooled` the mean of its words' vectors; nothing has the zero vector."""
    total = text_bytes(batch.column(2))[0].view(np.float32).reshape(-1, DIMS).astype(np.float64)
    more, at = text_bytes(batch.column(3))
    total[np.diff(at) > 0] += more.view(np.float32).reshape(-1, DIMS)
    return total / np.maximum(batch.column(1).to_numpy(), 1)[:, None]


class Network:
    """One hidden layer and one output, fitted with mini-batches and momentum scaled per weight."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.scale, self.temperature = np.zeros(DIMS), np.ones(DIMS), 1.0
        self.parts = [rng.normal(0, DIMS**-0.5, (DIMS, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]

    def logit(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.parts
        return np.einsum("nh,h->n", np.maximum(np.einsum("nd,dh->nh", (x - self.mean) / self.scale, w) + b, 0), v) + c[0]  # a row by itself, in a batch of any size

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -500, 500)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 40, size: int = 128, rate: float = 0.004, seed: int = 4) -> Network:
        rng = np.random.default_rng(seed)
        if not len(x):
            return self
        apart = rng.random(len(x)) < 0.2
        if len(x) < 10:
            apart[:] = False
        known, target, check, truth = x[~apart], y[~apart], x[apart], y[apart]
        self.mean, self.scale = known.mean(axis=0), known.std(axis=0) + 1e-6
        z = (known - self.mean) / self.scale
        first, second, step = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts], 0
        for _ in range(epochs):
            order = rng.permutation(len(z))
            for at in range(0, len(z), size):
                rows = order[at : at + size]
                w, b, v, c = self.parts
                inner = z[rows] @ w + b
                active = np.maximum(inner, 0)
                error = (1 / (1 + np.exp(-np.clip(active @ v + c[0], -500, 500))) - target[rows]) / len(rows)
                back = np.outer(error, v) * (inner > 0)
                slopes = [z[rows].T @ back + 1e-5 * w, back.sum(axis=0), active.T @ error + 1e-5 * v, np.array([error.sum()])]
                step += 1
                for p, g, m, s in zip(self.parts, slopes, first, second, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        if len(check):
            logit = self.logit(check)
            scales = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
            loss = [np.mean(np.logaddexp(0, logit / t) - truth * logit / t) for t in scales]
            self.temperature = float(scales[int(np.argmin(loss))])
        return self


def picked_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """(id, y): the labels of rows of `docs` to learn from."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("double").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    known = known.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    return known.orderBy(F.xxhash64("id"), "id", "y").limit(fit_rows)


def fit_quality(docs: DataFrame, labels: DataFrame, vectors: Vectors, id_col: str = "doc_id", text: str = "text", label: str = "quality", fit_rows: int = FIT_ROWS) -> Network:
    """The network fitted on labelled rows of `docs`: all of them up to `fit_rows`, else those of the smallest hashed ids.

    Rows without id or label teach nothing; a null text counts as an empty one; an id labelled twice counts twice.
    """
    picked = picked_labels(docs, labels, id_col, label, fit_rows)
    own = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(picked.select("id").distinct()), "id")  # at most fit_rows ids
    return fit_pooled(pooled(own, "text", vectors, ["id"]), picked)


def fit_pooled(rows: DataFrame, known: DataFrame) -> Network:
    """The network fitted on the rows of `pooled` by their carried id and the labels (id, y), of a bounded number."""
    texts = rows.join(F.broadcast(known), F.col("carried.id") == F.col("id")).select(F.struct("id", "y").alias("carried"), "n", "total", "more")

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = _means(batch)
            yield pa.RecordBatch.from_arrays([*batch.column(0).flatten(), pa.FixedSizeListArray.from_arrays(pa.array(held.ravel()), DIMS).cast(pa.list_(pa.float64()))], names=["id", "y", "x"])

    kind = known.schema["id"].dataType.simpleString()
    rows = texts.mapInArrow(mean, f"id {kind}, y double, x array<double>").toArrow().sort_by([("id", "ascending"), ("y", "ascending")])
    x = np.array(rows["x"].to_pylist(), dtype=np.float64).reshape(-1, DIMS)
    return Network().fit(x, rows["y"].to_numpy().astype(np.float64))


def score_quality(docs: DataFrame, vectors: Vectors, network: Network, text: str = "text") -> DataFrame:
    """Adds `score`, the probability of label 1, to every row; empty and null texts get that of the zero vector."""
    names = [c for c in docs.columns if c.lower() != "score"]
    return score_pooled(pooled(docs, text, vectors, names), network)


def score_pooled(rows: DataFrame, network: Network) -> DataFrame:
    """The carried columns of rows of `pooled`, and their `score`."""
    shared = rows.sparkSession.sparkContext.broadcast(network)
    fields = rows.schema["carried"].dataType.fields
    names = [f.name for f in fields]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.column(0).flatten(), pa.array(shared.value.probability(_means(batch)), pa.float64())], names=[*names, "score"])

    return rows.mapInArrow(score, T.StructType([*fields, T.StructField("score", T.DoubleType())]))
