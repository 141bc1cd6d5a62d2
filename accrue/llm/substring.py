"""Exact removal of repeated windows of words, behind a count-min prefilter.

A window is `size` consecutive words. A word goes when a window over it also begins in a document of a smaller id.

Of each window only its anchor enters the sketch: the smallest hash among its runs of `size // 2 + 1` words. Equal
windows have equal anchors, so the count of documents of an anchor is never below that of its windows, and
neighbouring windows mostly share theirs: about one anchor for `size // 4` words. The sketch has two rows of cells.
Tasks count the cells of their own documents (partial aggregation), the merged counts overestimate. Only anchors
with a count of two or more in both rows are kept; no repeated window is lost. The sketch is stored sparsely, as rows
of (cell, count): it is as large as its occupied cells, is shuffled by cell and is never broadcast.

The second pass takes the windows of the kept anchors, as runs of consecutive windows of one anchor, and groups them
exactly by anchor and 64-bit hash, first whole runs and then, where an anchor has different runs, their windows.
A hot window costs one row per task before the shuffle, and joins back to its occurrences, which Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.llm.words import Words, blocks, counted, joined, list_array, rolling, sliding_min, whole
from accrue.sources.shared import discard, written

WINDOW = 50
CELLS_PER_ANCHOR = 64
HOT_HELD, MAX_HOT = 1000, 100_000


def _anchors(hashes: np.ndarray, size: int) -> np.ndarray:
    """The anchor of each window, by its first word."""
    run = size // 2 + 1
    if len(hashes) < size:
        return np.zeros(0, np.int64)
    return sliding_min(rolling(hashes, run), size - run + 1).view(np.int64)


def _profiles(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for held in batches:
        for batch in blocks(held, "text"):
            words = Words(batch.column(1))
            anchors = _anchors(words.hashes(), size)
            inner = whole(words.doc, size)
            anchors, doc = anchors[inner], words.doc[: len(inner)][inner]
            order = np.lexsort((anchors, doc))
            anchors, doc = anchors[order], doc[order]
            new = np.ones(len(doc), bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])
            n = np.bincount(doc[new], minlength=len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), list_array(anchors[new], n, pa.int64())], names=["id", "anchors"])


def _runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for held in batches:
        for batch in blocks(held, "text"):
            words = Words(batch.column(1))
            anchors, inner = _anchors(words.hashes(), size), whole(words.doc, size)
            # a wanted anchor of another row of the block costs a run more, never a wrong result
            known = counted(batch.column(2).flatten().to_numpy())[0]
            at = np.minimum(np.searchsorted(known, anchors), max(0, len(known) - 1))
            hit = np.flatnonzero((known[at] == anchors) & inner) if len(known) else np.zeros(0, np.int64)
            new = np.ones(len(hit), bool)
            new[1:] = (np.diff(hit) != 1) | (np.diff(anchors[hit]) != 0) | (np.diff(words.doc[hit]) != 0)
            begin = hit[new]
            length = np.diff(np.append(np.flatnonzero(new), len(hit)))
            doc = words.doc[begin]
            held_windows = rolling(words.hashes(2), size)[hit].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), batch.column(3).take(pa.array(doc)), pa.array(begin - words.first[doc], pa.int64()), pa.array(anchors[begin], pa.int64()), list_array(held_windows, length, pa.int64())],
                names=["id", "row", "place", "anchor", "windows"],
            )


def _cell(anchor: str, row: int, width: int) -> Column:
    return F.pmod(F.xxhash64(F.col(anchor), F.lit(row)), F.lit(width)) + F.lit(row * width)


def repeated_windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(id, row, runs): of each document the runs (place, n) of windows that also begin in one of a smaller id.

    `docs` has the columns id and text. Rows without id or text are left out. `row` is a hash of the text (`row_hash`): an
    id may have several, each with its own runs.
    """
    docs = docs.where("id IS NOT NULL AND text IS NOT NULL")
    kind = docs.schema["id"].dataType.simpleString()
    profiles = written(docs.mapInArrow(lambda it: _profiles(it, size), f"id {kind}, anchors array<long>"), "anchors")
    total = profiles.agg(F.sum(F.size("anchors"))).first()[0] or 0
    width = 1 << (CELLS_PER_ANCHOR * max(total, 1)).bit_length()
    anchors = profiles.select("id", F.explode("anchors").alias("anchor"))
    cells = anchors.select(F.explode(F.array(_cell("anchor", 0, width), _cell("anchor", 1, width))).alias("cell"))
    sketch = written(cells.groupBy("cell").agg(F.count("*").alias("n")).where("n >= 2"), "sketch")
    for row in (0, 1):
        own = sketch.where(F.col("cell") >= width) if row else sketch.where(F.col("cell") < width)
        anchors = anchors.withColumn("cell", _cell("anchor", row, width)).join(own, "cell", "left_semi").drop("cell")
    wanted = anchors.groupBy("id").agg(F.collect_set("anchor").alias("anchors"))
    found = docs.join(wanted, "id").select("id", "text", "anchors", row_hash("text").alias("row"))
    runs = found.mapInArrow(lambda it: _runs(it, size), f"id {kind}, row long, place long, anchor long, windows array<long>")
    runs = written(runs.select("id", "row", "place", "anchor", F.xxhash64("windows").alias("run"), F.size("windows").alias("n"), "windows"), "runs")
    discard(profiles, sketch)

    # Equal runs are one: beyond the smallest id that has a run, all its windows are repeated.
    # The few runs that very many documents hold meet their holders without a shuffle of those.
    same = written(runs.groupBy("anchor", "run").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("held")), "same")
    repeated = same.where("least < most")
    hot = F.col("held") >= max(HOT_HELD, runs.count() // MAX_HOT)
    held = runs.select("id", "row", "place", "anchor", "run", "n")
    few = F.broadcast(repeated.where(hot).select("anchor", "run", "least"))  # at most MAX_HOT rows
    later = held.join(few, ["anchor", "run"]).unionByName(held.join(few, ["anchor", "run"], "left_anti").join(repeated.where(~hot).select("anchor", "run", "least"), ["anchor", "run"]))
    later = later.where("id > least").select("id", "row", "place", "n")
    # Different runs of one anchor may share windows; those are compared one by one, for the first holder of each run.
    several = same.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    firsts = runs.join(same.join(several, "anchor", "left_semi").select("anchor", "run", F.col("least").alias("id")), ["anchor", "run", "id"])
    firsts = firsts.select("id", "row", "anchor", "place", F.posexplode("windows").alias("at", "window")).select("id", "row", "anchor", "window", (F.col("place") + F.col("at")).alias("place"))
    shared = firsts.groupBy("anchor", "window").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    partly = firsts.join(shared.select("anchor", "window", "least"), ["anchor", "window"]).where("id > least")
    partly = partly.select("id", "row", "place", F.lit(1).alias("n"))
    found = later.union(partly).groupBy("id", "row").agg(F.collect_list(F.struct("place", F.col("n").cast("long").alias("n"))).alias("runs"))
    found = written(found, "repeats")
    discard(runs, same)
    return found


def row_hash(text: str) -> Column:
    """By which rows of one id are told apart."""
    return F.xxhash64(F.col(text))


def _cut(batches: Iterator[pa.RecordBatch], size: int, text_at: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for held in batches:
        for batch in blocks(held, names[text_at]):
            words = Words(batch.column(text_at))
            runs = batch.column(len(names))
            lengths = runs.value_lengths().fill_null(0).to_numpy().astype(np.int64)
            flat = runs.flatten()
            place, n = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            doc = np.repeat(np.arange(len(batch)), lengths)
            step = np.zeros(len(words) + 1, dtype=np.int64)
            at = words.first[doc] + place
            np.add.at(step, at, 1)
            np.add.at(step, at + n + size - 1, -1)
            kept = np.cumsum(step)[:-1] == 0
            removed = np.bincount(words.doc[~kept], minlength=len(batch))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), joined(words, kept)],
                names=[*names, "n_words", "n_removed", "kept"],
            )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = WINDOW, carry: Sequence[str] = ()) -> DataFrame:
    """(id, text, n_words, n_removed, kept[, carried]): every row with its number of words, how many go, and the kept words joined by one space.

    Windows are judged on the input. A null text has no words and stays null, its `kept` is empty. Rows without an id
    keep all words and take none from others. Rows of equal ids take nothing from each other, and each is cut by itself.
    `carried` is a struct of the columns named by `carry`.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), *[F.struct(*carry).alias("carried")] * bool(carry))
    names = rows.columns
    found = repeated_windows(rows.select("id", "text"), size)
    out = rows.withColumn("row", row_hash("text")).join(found, ["id", "row"], "left").select(*names, "runs")
    schema = T.StructType([*rows.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return out.mapInArrow(lambda it: _cut(it, size, 1, names), schema).withColumnRenamed("id", id_col)
