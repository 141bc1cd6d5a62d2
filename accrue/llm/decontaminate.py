"""Benchmark decontamination with one FM-index per shard of documents.

Words are compared in lower case (A-Z), split at everything that is no digit, letter or non-ASCII character. A phrase
is a run of `size` consecutive words of a benchmark item, or all words of a shorter one. A task cuts its documents into
shards, builds the index of each, searches all phrases backwards, locates the occurrences and merges their spans.

Words that no phrase has cannot be part of an occurrence: they become one separator, and runs of other words shorter
than the shortest phrase stay out of the index. Documents are read once and not shuffled. Phrases are broadcast in
blocks of benchmark items of at most `block_bytes` text together (or one item); each block is a pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrue.llm.fmindex import FMIndex
from accrue.llm.words import ALPHANUMERIC, Words, blocks, ragged

PHRASE = 10
SHARD_SYMBOLS, SHARD_ROWS = 1 << 19, 1 << 15
BLOCK_BYTES = 16 << 20
_SCHEMA = "n_words long, spans array<struct<first:long,end:long>>, items array<string>"


@dataclass
class Phrases:
    """All phrases of a block of items: symbols from 2, rows padded with 0, and the items of each phrase."""

    vocabulary: np.ndarray
    rows: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray  # items, phrase by phrase
    owner_first: np.ndarray
    items: list[str]

    @classmethod
    def of(cls, items: list[str], texts: list[str], size: int) -> Phrases:
        words = Words(pa.array(texts, pa.large_string()), ALPHANUMERIC, lower=True)
        hashes = words.hashes()
        vocabulary = np.sort(np.array(sorted(set(hashes.tolist())), dtype=np.uint64))
        symbols = (np.searchsorted(vocabulary, hashes) + 2).tolist()
        owners: dict[tuple[int, ...], set[int]] = {}
        for item in range(len(items)):
            own = symbols[words.first[item] : words.first[item + 1]]
            for at in range(max(1, len(own) - size + 1) if own else 0):
                owners.setdefault(tuple(own[at : at + size]), set()).add(item)
        phrases = sorted(owners)
        rows = np.zeros((len(phrases), size), dtype=np.int64)
        for i, phrase in enumerate(phrases):
            rows[i, : len(phrase)] = phrase
        held = [sorted(owners[p]) for p in phrases]
        first = np.concatenate(([0], np.cumsum([len(h) for h in held]))).astype(np.int64)
        return cls(vocabulary, rows, np.array([len(p) for p in phrases], dtype=np.int64), np.array([i for h in held for i in h], dtype=np.int64), first, items)


class _Shard:
    """Documents with their words, and the symbols of the runs that could hold a phrase."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.rows: list[pa.RecordBatch] = []
        self.counts: list[np.ndarray] = []
        self.symbols: list[np.ndarray] = []
        self.places: list[np.ndarray] = []  # the word of each symbol, counted through the shard; -1 for separators
        self.n_words = self.n_symbols = self.n_rows = 0

    def add(self, batch: pa.RecordBatch, texts: pa.Array) -> None:
        words = Words(texts, ALPHANUMERIC, lower=True)
        known = self.phrases.vocabulary
        shortest = int(self.phrases.lengths.min(initial=PHRASE)) if len(known) else 0
        if len(known) and len(words):
            hashes = words.hashes()
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = np.flatnonzero(known[at] == hashes)
            if len(hit):
                cut = np.flatnonzero((np.diff(hit) != 1) | (np.diff(words.doc[hit]) != 0)) + 1
                begin = np.concatenate(([0], cut))
                length = np.diff(np.append(begin, len(hit)))
                begin, length = begin[length >= shortest], length[length >= shortest]
                keep = hit[ragged(begin, length)]
                after = np.cumsum(length)
                self.symbols.append(np.insert(at[keep] + 2, after, 1))
                self.places.append(np.insert(keep + self.n_words, after, -1))
                self.n_symbols += len(self.symbols[-1])
        self.rows.append(batch)
        self.counts.append(words.counts)
        self.n_words += len(words)
        self.n_rows += len(batch)

    def result(self) -> tuple[np.ndarray, list[list[dict[str, int]]], list[list[str]]]:
        counts = np.concatenate(self.counts)
        first = np.concatenate(([0], np.cumsum(counts)))
        spans: list[list[dict[str, int]]] = [[] for _ in counts]
        items: list[list[str]] = [[] for _ in counts]
        if self.n_symbols and len(self.phrases.rows):
            phrase, at = FMIndex(np.concatenate(self.symbols)).find(self.phrases.rows, self.phrases.lengths)
            start = np.concatenate(self.places)[at]
            end = start + self.phrases.lengths[phrase]
            doc = np.searchsorted(first, start, "right") - 1
            owned = np.diff(self.phrases.owner_first)[phrase]
            pairs = np.repeat(doc, owned) * len(self.phrases.items) + self.phrases.owners[ragged(self.phrases.owner_first[phrase], owned)]
            for pair in np.sort(np.array(sorted(set(pairs.tolist())), dtype=np.int64)).tolist():
                items[pair // len(self.phrases.items)].append(self.phrases.items[pair % len(self.phrases.items)])
            order = np.lexsort((end, start))
            start, end, doc = start[order], np.maximum.accumulate(end[order]), doc[order]
            if len(start):
                new = np.concatenate(([True], (start[1:] > end[:-1]) | (doc[1:] != doc[:-1])))
                last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)
                for d, a, b in zip(doc[new].tolist(), start[new].tolist(), end[last].tolist(), strict=True):
                    spans[d].append({"first": a - int(first[d]), "end": b - int(first[d])})
        return counts, spans, [sorted(set(x)) for x in items]


def _pass(docs: DataFrame, names: list[str], text: str, phrases: Phrases) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    kept = [f for f in docs.schema.fields if f.name in names]

    def out(shard: _Shard) -> Iterator[pa.RecordBatch]:
        counts, spans, items = shard.result()
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        row = 0
        for batch in shard.rows:
            to = row + len(batch)
            added = [pa.array(counts[row:to], pa.int64()), pa.array(spans[row:to], kind), pa.array(items[row:to], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "n_words", "spans", "items"])
            row = to

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(shared.value)
        for whole in batches:
            for batch in blocks(whole, text):
                shard.add(batch.select([f.name for f in kept]), batch.column(batch.schema.get_field_index(text)))
                if shard.n_symbols >= SHARD_SYMBOLS or shard.n_rows >= SHARD_ROWS:
                    yield from out(shard)
                    shard = _Shard(shared.value)
        if shard.rows:
            yield from out(shard)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), _SCHEMA])
    return docs.mapInArrow(search, schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = PHRASE, block_bytes: int = BLOCK_BYTES, carry: Sequence[str] = ()
) -> DataFrame:
    """Per row of `docs`: its id, n_words, the merged spans of words inside occurrences, and the items that occur.

    Null and empty texts have no words. Items without id, text or words have no phrases; rows of one item id are one item.
    Rows of `docs` that repeat are all returned. Item ids come as strings, in order. `carried` is a struct of the columns
    named by `carry`.
    """
    bench = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("words")).where("item IS NOT NULL AND words IS NOT NULL")
    total = bench.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n_blocks = -(-total // block_bytes) or 1
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), *[F.struct(*carry).alias("carried")] * bool(carry))
    own = ["id", *["carried"] * bool(carry)]
    names = [F.col("id").alias(id_col), "n_words", "spans", "items", *own[1:]]
    if n_blocks == 1:
        held = bench.collect()  # at most block_bytes
        return _pass(rows, own, "text", Phrases.of([r.item for r in held], [r.words for r in held], size)).select(*names)
    told = [F.coalesce("text", F.lit("")), *[F.to_json(c) for c in own[1:]]]
    rows = rows.withColumn("key", F.sha2(F.concat_ws("\n", *told), 256))
    parts = None
    for block in range(n_blocks):
        held = bench.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).collect()
        part = _pass(rows, [*own, "key"], "text", Phrases.of([r.item for r in held], [r.words for r in held], size))
        parts = part if parts is None else parts.union(part)
    merged = parts.groupBy("id", "key", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.count("*").alias("n"),
        *[F.first(c).alias(c) for c in own[1:]],
    )
    joined = F.expr("""aggregate(all, CAST(array() AS array<struct<first:bigint,end:bigint>>), (acc, x) -> CASE
        WHEN size(acc) > 0 AND x.first <= element_at(acc, -1).end
        THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('first', element_at(acc, -1).first, 'end', greatest(element_at(acc, -1).end, x.end))))
        ELSE concat(acc, array(x)) END)""")
    copies = F.explode(F.array_repeat(F.lit(1), (F.col("n") / n_blocks).cast("int")))
    return merged.select("id", "n_words", joined.alias("spans"), "items", *own[1:], copies.alias("copy")).select(*names)
