"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams (1 to 3 characters over lower-cased
letters; every run of other characters is one word boundary), most frequent first. The
distance of a document from a language is the out-of-place sum: over the n-grams of the
document's profile, how far each is from its rank in the language's profile, and the
profile size for those that are not in it. The nearest language is predicted.

Language profiles are counted over all labelled rows: tasks count their own rows, Spark
sums the counts, and `size` n-grams per language are kept. Documents are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.llm.words import blocks, counted, text_bytes

PROFILE = 400
MAX_LANGUAGES = 2000  # the collected profiles have a proven bound of so many times PROFILE rows
_EDGE = 1


@cache
def _letters() -> np.ndarray:
    """For each code point of the basic plane the lower-case letter's code plus one, and _EDGE for what is no letter."""
    out = np.full(0x10000, _EDGE, dtype=np.int64)
    for code in range(0x10000):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            out[code] = (ord(lower) if len(lower) == 1 else code) + 1
    return out


def _symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and word boundaries of all texts, where each text begins, and its number of letters."""
    data, at = text_bytes(column)
    raw = data.tobytes()
    try:
        codes = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
        begin = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[at]
    except UnicodeDecodeError:
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        begin = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    table = _letters()
    low = codes < 0x10000
    symbols = table[np.where(low, codes, 0)]
    for code in set(codes[~low].tolist()):
        if chr(code).isalpha():
            symbols[codes == code] = code + 1
    letters = np.concatenate(([0], np.cumsum(symbols != _EDGE)))
    found = letters[begin[1:]] - letters[begin[:-1]]
    # one boundary before each text, and one for each run of other characters
    symbols = np.insert(symbols, begin[:-1], _EDGE)
    begin = begin + np.arange(len(begin))
    keep = np.ones(len(symbols), dtype=bool)
    keep[1:] = (symbols[1:] != _EDGE) | (symbols[:-1] != _EDGE)
    keep[begin[:-1]] = True
    begin = np.concatenate(([0], np.cumsum(keep)))[begin]
    return symbols[keep], begin, found


def _grams(symbols: np.ndarray) -> np.ndarray:
    """The n-grams of one text, which begins with a boundary, as numbers."""
    symbols = np.append(symbols, _EDGE) if symbols[-1] != _EDGE else symbols
    two = symbols[:-1] << 21 | symbols[1:]
    return np.concatenate((symbols[symbols != _EDGE], two, two[:-1] << 21 | symbols[2:]))


def _count(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in blocks(whole, "text"):
            symbols, begin, _ = _symbols(batch.column(0))
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for lang in sorted(set(langs.tolist())):
                rows = np.flatnonzero(langs == lang)
                grams, n = counted(np.concatenate([_grams(symbols[begin[i] : begin[i + 1]]) for i in rows]))
                yield pa.record_batch([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(n, pa.int64())], schema=schema)


def fit_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """Per language its `size` most frequent n-grams, most frequent first, ties by the n-gram's number.

    Rows without language or text teach nothing.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    counts = rows.mapInArrow(lambda it: _count(it, schema), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("place", place).where(F.col("place") <= size).limit(MAX_LANGUAGES * size + 1).collect()
    if len(best) > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; profiles of so many do not fit a broadcast")
    profiles: dict[str, list[int]] = {}
    for row in sorted(best, key=lambda r: (r.lang, r.place)):
        profiles.setdefault(row.lang, []).append(row.gram)
    return profiles


class Ranks:
    """All language profiles as one table: rank of each known n-gram in each language."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.size, self.langs = size, sorted(profiles)
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), dtype=np.int64)
        self.place = np.full((len(self.langs), len(self.grams) + 1), size, dtype=np.int32)
        for i, lang in enumerate(self.langs):
            self.place[i, np.searchsorted(self.grams, profiles[lang])] = np.arange(len(profiles[lang]))

    def nearest(self, column: pa.Array) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """Of each text the nearest language, 1 minus the share of the largest possible distance, and the number of letters."""
        symbols, begin, letters = _symbols(column)
        profiles, docs = [], np.flatnonzero(letters)
        for i in docs:
            grams, n = counted(_grams(symbols[begin[i] : begin[i + 1]]))
            profiles.append(grams[np.argsort(-n, kind="stable")[: self.size]])
        langs: list[str | None] = [None] * len(letters)
        score = np.zeros(len(letters))
        if not len(docs) or not self.langs:
            return langs, score, letters
        lengths = np.array([len(p) for p in profiles])
        flat = np.concatenate(profiles)
        at = np.searchsorted(self.grams, flat)
        at = np.where((at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == flat), at, len(self.grams))
        start = np.cumsum(lengths) - lengths
        rank = np.arange(len(flat)) - np.repeat(start, lengths)
        missing = at == len(self.grams)
        total = np.empty((len(self.langs), len(docs)))
        for k in range(len(self.langs)):
            place = self.place[k][at]
            apart = np.where(missing | (place == self.size), self.size, np.abs(place - rank))
            total[k] = np.add.reduceat(apart, start)
        best = total.argmin(axis=0)
        for i, doc in enumerate(docs):
            langs[doc] = self.langs[best[i]]
        score[docs] = np.clip(1 - total[best, np.arange(len(docs))] / (lengths * self.size), 0, 1)
        return langs, score, letters


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", size: int = PROFILE, lettered: bool = False) -> DataFrame:
    """Adds `lang_pred` (`und` for null and for texts without a letter) and `score`, from 0 to 1, to every row.

    All other columns stay as they are; of their own columns called `lang_pred` or `score` the new ones take the place.
    Ties go to the language first in order. Without any profile every row is `und`, and `und` may be a label too; with
    `lettered`, a column of that name tells whether the text has a letter, whatever is predicted.
    """
    spark, ranks = docs.sparkSession, Ranks(profiles, size)
    shared = spark.sparkContext.broadcast(ranks)
    more = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), *([T.StructField("lettered", T.BooleanType())] if lettered else [])]
    new = [f.name for f in more]
    names = [c for c in docs.columns if c.lower() not in new]
    text_at = names.index(text)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, text):
                langs, score, letters = shared.value.nearest(batch.column(text_at))
                added = [pa.array(["und" if x is None else x for x in langs], pa.string()), pa.array(score, pa.float64()), pa.array(letters > 0)][: len(new)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*names, *new])

    rows = docs.select(*names)
    return rows.mapInArrow(predict, T.StructType([*rows.schema.fields, *more]))
