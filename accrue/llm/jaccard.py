"""Similarity join of documents by the Jaccard similarity of their word n-grams, with adaptive multi-match prefixes.

All n-grams have one global order, frequent ones last. Of two sets that are similar enough, the first
|x| - ceil(t|x|) + l n-grams of each share at least l, for every l up to the least possible overlap (the l-prefix). Each
document chooses its own l from 1 to `longest` by the estimated cost of its candidates: a longer prefix meets longer
lists, but l shared n-grams drop more candidates before they are verified. Two documents with l and l' must share min(l, l').

1. Tasks count n-grams of their own documents and pass on those that are frequent there; the sums order the n-grams
   (a bounded table of the most frequent ones is broadcast; it affects cost, never the result).
2. Documents of equal sets are one class; its smallest id stands for it from here on.
3. Prefix n-grams that one class alone has are dropped; the lists of the others meet in a self-join. A pair comes out
   at its min(l, l')-th shared n-gram (in long lists now and then again behind it), and only if its sizes, the places of that n-gram and a 256-bit parity sketch
   of both sets (whose differing bits never exceed the differing n-grams) still allow the similarity.
4. Two rounds: first each class meets the leaders of its lists and is compared with the closest; then the lists are
   joined but for pairs of classes that are connected by now, so that the links of a large group of near copies are
   not all expanded. Pairs that a 1024-bit sketch still allows, and then one of at least four bits for each n-gram, are
   verified on whole sets. Texts, sketches and sets are sieved by a broadcast bitmap of the ids of the pairs before they
   are joined, so that those of documents without a pair are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrue.llm.components import components
from accrue.llm.frequent import most_frequent
from accrue.llm.words import Words, blocks, counted, list_array, mixed, rolling
from accrue.sources.shared import discard, written

SHINGLE, PERCENT = 5, 80
LONGEST = 4
FREQUENT_IN_TASK = 8
MAX_FREQUENT = 1 << 17
REMEMBERED = 16  # n-grams an entry knows before its own; a pair may come out again behind them
MAX_COUNTED = 1 << 21  # distinct n-grams a task counts at a time; beyond it those seen once are dropped
SKETCH_BITS = 1024
FINE_BITS = 4  # of the sketch of a whole set, for each n-gram
SIEVE_BITS = 24  # of the hash of an id; the bitmap broadcast has at most 2^SIEVE_BITS bits
VERIFY_COST = 0.05  # of comparing one n-gram of a candidate, against one entry of a list
_TOP = np.uint64(1 << 63)
_APART = "(" + " + ".join(f"bit_count(x.b{k} ^ y.b{k})" for k in range(1, 5)) + ")"


def _grams(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The n-grams of each text of a column, as hashes below 2^63, their rows, and the number of rows."""
    words = Words(column, lower=True)
    hashes = words.hashes()
    grams, doc = [], []
    for n in range(1, size + 1):
        runs = rolling(hashes, n)
        own = words.doc[: len(runs)]
        first, last = np.arange(len(runs)), words.first[own + 1] if len(own) else own
        # whole texts of fewer words are one n-gram
        fits = first + n <= last if n == size else (first == words.first[own]) & (first + n == last)
        grams.append(mixed(runs[fits] + np.uint64(n)) >> np.uint64(1))
        doc.append(own[fits])
    return np.concatenate(grams), np.concatenate(doc), len(words.counts)


class _Sets:
    """The distinct n-grams of each text of a column, in order of text and hash."""

    def __init__(self, column: pa.Array, size: int):
        key, at, self.rows = _grams(column, size)
        order = np.lexsort((key, at))
        key, at = key[order], at[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1])
        self.key, self.doc = key[new], at[new]
        self.sizes = np.bincount(self.doc, minlength=self.rows)


def _frequent(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for held in batches:
        for batch in blocks(held, "text"):
            more, n = counted(_grams(batch.column(0), size)[0])
            keys, counts = counted(np.concatenate((keys, more)), np.concatenate((counts, n)))
            if len(keys) > MAX_COUNTED:
                keys, counts = keys[counts > 1], counts[counts > 1]
    often = counts >= FREQUENT_IN_TASK
    yield pa.RecordBatch.from_arrays([pa.array(keys[often].view(np.int64)), pa.array(counts[often], pa.int64())], names=["gram", "n"])


def _ordered(sets: _Sets, frequent: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-grams as numbers in the global order: those that aren't frequent by hash, then the frequent ones by count."""
    key = sets.key
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)
        key = np.where(frequent[at] == key, _TOP | place[at], key)
    order = np.lexsort((key, sets.doc))
    return key[order], sets.doc[order]


def _prefixes(batches: Iterator[pa.RecordBatch], size: int, percent: int, longest: int, frequent: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for held in batches:
        for batch in blocks(held, "text"):
            sets = _Sets(batch.column(1), size)
            key, doc = _ordered(sets, *frequent)
            n = sets.sizes
            begin = np.cumsum(n) - n
            prefix = np.minimum(n, n - -(-percent * n // 100) + longest)
            inside = np.arange(len(key)) - begin[doc] < prefix[doc]
            signs = []
            full = np.flatnonzero(n)
            for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
                sign = np.zeros(len(batch), np.uint64)
                if len(full):
                    sign[full] = np.add.reduceat(mixed(key ^ np.uint64(salt)), begin[full])
                signs.append(pa.array(sign.view(np.int64)))
            cells = sets.doc * SKETCH_BITS + (mixed(sets.key) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)).astype(np.int64)
            sketch = np.packbits((np.bincount(cells, minlength=SKETCH_BITS * len(batch)) & 1).astype(np.uint8)).view(np.int64)
            bits = np.bincount(doc * 256 + (mixed(key) >> np.uint64(56)).astype(np.int64), minlength=256 * len(batch)) & 1
            bits = np.packbits(bits.astype(np.uint8).reshape(-1, 256), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), *signs, *(pa.array(np.ascontiguousarray(bits[:, k])) for k in range(4)), list_array(sketch, np.full(len(batch), SKETCH_BITS // 64), pa.int64()), list_array(key[inside].view(np.int64), prefix, pa.int64())],
                names=["id", "n", "s1", "s2", "b1", "b2", "b3", "b4", "sketch", "prefix"],
            )


def _shingles(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for held in batches:
        for batch in blocks(held, "text"):
            sets = _Sets(batch.column(1), size)
            fine, longs = _fine(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets.sizes, pa.int64()), list_array(fine, longs, pa.int64()), list_array(sets.key.view(np.int64), sets.sizes, pa.int64())], names=["id", "n", "sketch", "grams"]
            )


def _fine(sets: _Sets) -> tuple[np.ndarray, np.ndarray]:
    """A parity sketch of each set in a power of two of 64-bit numbers, and how many; by the lowest bits, so that a longer one folds to a shorter."""
    longs = 1 << np.ceil(np.log2(np.maximum(1, -(-FINE_BITS * sets.sizes // 64)))).astype(np.int64)
    begin = 64 * (np.cumsum(longs) - longs)
    cells = begin[sets.doc] + (sets.key & (64 * longs - 1).astype(np.uint64)[sets.doc]).astype(np.int64)
    odd = np.bincount(cells, minlength=64 * int(longs.sum())) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64), longs


def _entries(batches: Iterator[pa.RecordBatch], percent: int, longest: int) -> Iterator[pa.RecordBatch]:
    """The list entries of each row with its l: that of the least estimated cost, which is the entries of the lists met,
    and the n-grams compared for the candidates (entries / l)."""
    for batch in batches:
        at = {name: i for i, name in enumerate(batch.schema.names)}
        n = batch.column(at["n"]).to_numpy()
        live = batch.column(at["live"])
        row = np.repeat(np.arange(len(batch)), live.value_lengths().to_numpy())
        place, gram, lists = (live.flatten().field(k).to_numpy() for k in range(3))
        least = -(-percent * n // 100)
        costs = []
        for l in range(1, longest + 1):
            entries = np.bincount(row, weights=lists * (place < (n - least + l)[row]), minlength=len(batch))
            costs.append(np.where(l > least, np.inf, entries * (1 + n * VERIFY_COST / l)))
        best = 1 + np.argmin(np.stack(costs), axis=0)
        inside = place < (n - least + best)[row]
        row = row[inside]
        take = pa.array(row)
        kept = [batch.column(at[c]).take(take) for c in ("id", "s1", "n", "b1", "b2", "b3", "b4")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(best[row], pa.int64()), pa.array(place[inside], pa.int32()), pa.array(gram[inside], pa.int64())], names=["id", "s1", "n", "b1", "b2", "b3", "b4", "l", "place", "gram"]
        )


def _may(percent: int) -> str:
    """Whether sizes and small sketches of the entries x and y allow the similarity."""
    return f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) AND {_APART} <= x.n + y.n - 2 * {_need('x.n', 'y.n', percent)}"


def _listed(heads: DataFrame, percent: int, longest: int) -> DataFrame:
    """Of each class the list entries that meet another class of a fitting size and sketch, as `all` in the order of their places.

    `heads`, a table of `written`, has one row per class and is discarded.
    """
    kind = heads.schema["id"].dataType.simpleString()
    node = ["id", "s1"]  # rows of one id may have several sets
    posted = heads.select(*node, F.posexplode("prefix").alias("place", "gram"))
    lists = posted.groupBy("gram").agg(F.count("*").alias("lists")).where("lists > 1")
    live = posted.join(lists, "gram").groupBy(*node).agg(F.collect_list(F.struct("place", "gram", "lists")).alias("live"))
    docs = heads.drop("prefix", "sketch").join(live, node)
    schema = f"id {kind}, s1 long, n long, b1 long, b2 long, b3 long, b4 long, l long, place int, gram long"
    all_entries = written(docs.mapInArrow(lambda it: _entries(it, percent, longest), schema), "entries")
    discard(heads)
    x, y = all_entries.alias("x"), all_entries.alias("y")
    entries = written(x.join(y, F.expr(f"x.gram = y.gram AND x.id != y.id AND {_may(percent)}"), "left_semi"), "entries")
    discard(all_entries)
    grams = entries.groupBy(*node).agg(F.array_sort(F.collect_list(F.struct("place", "gram"))).alias("all"))
    own = [*node, "n", "l", "b1", "b2", "b3", "b4"]
    kept = written(entries.select(*own).distinct().join(grams, node).select(*own, "all"), "entries")
    discard(entries)
    return kept


def _posted(kept: DataFrame) -> DataFrame:
    """The list entries of `_listed` as rows, each with the n-grams before its own."""
    rows = kept.withColumn("grams", F.col("all.gram")).select("*", F.posexplode("all").alias("k", "at"))
    before = F.slice("grams", F.lit(1), F.least(F.col("k"), F.lit(REMEMBERED)))
    return rows.select(*kept.drop("all").columns, "at.place", "at.gram", before.alias("before"), (F.col("k") <= REMEMBERED).alias("all_before"))


def _stars(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b): for each class the leader of a list whose sketch is closest to its own; leaders are chosen by two hashes."""
    entries = entries.select("id", "n", "b1", "b2", "b3", "b4", F.explode("all.gram").alias("gram"))
    leaders = [F.min(F.struct(F.xxhash64("id", F.lit(salt)).alias("h"), "id", "n", "b1", "b2", "b3", "b4")) for salt in (1, 2)]
    leaders = entries.groupBy("gram").agg(*(y.alias(f"y{k}") for k, y in enumerate(leaders))).select(F.col("gram").alias("of"), "y0", "y1")
    met = entries.alias("x").join(leaders, F.expr("x.gram = of"))
    fits = [F.when(F.expr(f"x.id != y.id AND {_may(percent)}".replace("y.", f"y{k}.")), F.struct(F.expr(_APART.replace("y.", f"y{k}.")).alias("apart"), F.col(f"y{k}.id").alias("b"))) for k in (0, 1)]
    best = met.groupBy(F.col("x.id").alias("a")).agg(*(F.min(y).alias(f"best{k}") for k, y in enumerate(fits)))
    found = best.select("a", F.explode(F.array("best0.b", "best1.b")).alias("b")).where("b IS NOT NULL")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _candidates(entries: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of classes that may be similar enough and are not connected yet."""
    held = entries.join(labels.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    held = _posted(held)
    pairs = held.alias("x").join(
        held.alias("y"),
        F.expr(
            f"""x.gram = y.gram AND x.component != y.component AND (x.n < y.n OR (x.n = y.n AND x.id < y.id)) AND {_may(percent)}
            AND least(x.l, y.l) + least(x.n - x.place, y.n - y.place) - 1 >= {_need("x.n", "y.n", percent)}
            AND size(array_intersect(x.before, y.before)) <= least(x.l, y.l) - 1
            AND (size(array_intersect(x.before, y.before)) = least(x.l, y.l) - 1 OR NOT x.all_before OR NOT y.all_before)"""
        ),
    )
    return pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def _need(x: str, y: str, percent: int) -> str:
    """The least overlap of two similar sets of these sizes."""
    return f"(({percent} * ({x} + {y}) + {99 + percent}) div {100 + percent})"


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()


def _sieved(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is in `ids`, and some others: by a bitmap of hashes, which is bounded however many ids there are."""
    place = F.shiftrightunsigned(F.xxhash64("id"), 64 - SIEVE_BITS)
    bit = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    bits = ids.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("long")).agg(F.bit_or(bit).alias("bits"))
    found = rows.withColumn("place", place).withColumn("long", F.shiftright("place", 6)).join(F.broadcast(bits), "long")
    return found.where(F.col("bits").bitwiseAND(bit) != 0).select(*rows.columns)


def _possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs whose larger parity sketches still allow the similarity; sketches are far smaller than sets.

    Two of different lengths, which are powers of two, are compared in the shorter length.
    """
    sketches = _sieved(sketches.select("id", "n", "sketch"), _ends(pairs))
    met = pairs.join(sketches.withColumnsRenamed({"id": "a", "sketch": "xa", "n": "na"}), "a").join(sketches.withColumnsRenamed({"id": "b", "sketch": "xb", "n": "nb"}), "b")
    shorter = "least(size(xa), size(xb))"
    folded = "IF(size({x}) = %s, {x}, transform(sequence(0, %s - 1), j -> aggregate(sequence(j, size({x}) - 1, %s), 0L, (s, i) -> s ^ {x}[i])))" % (shorter, shorter, shorter)
    apart = f"aggregate(zip_with({folded.format(x='xa')}, {folded.format(x='xb')}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
    return met.where(f"{apart} <= na + nb - 2 * {_need('na', 'nb', percent)}").select("a", "b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    sets = _sieved(sets.select("id", "grams"), _ends(pairs))
    left, right = sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), sets.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", F.size("ga").alias("na"), F.size("gb").alias("nb"), F.size(F.array_intersect("ga", "gb")).alias("both"))
    return met.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT, longest: int = LONGEST) -> DataFrame:
    """(id, n_shingles, component_id): per row of `docs` the size of its set and the smallest id reachable by links.

    Words are compared in lower case (A-Z). Two documents link when 100 * intersection >= percent * union of their sets of
    distinct `size`-word runs; a text of fewer words is one run, null and texts without words are empty sets and link with
    nothing. Rows without an id link with nothing, their component is null. Rows of one id are one node, each with its own set.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    often = rows.select("text").mapInArrow(lambda it: _frequent(it, size), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    often = written(often, "frequent")
    best = most_frequent(often, MAX_FREQUENT, "gram").toArrow()
    discard(often)
    grams, n = best["gram"].to_numpy().view(np.uint64), best["n"].to_numpy()
    place = np.empty(len(grams), np.uint64)
    place[np.lexsort((grams, n))] = np.arange(len(grams), dtype=np.uint64)
    order = np.argsort(grams)
    shared = spark.sparkContext.broadcast((grams[order], place[order]))

    schema = f"id {kind}, n long, s1 long, s2 long, b1 long, b2 long, b3 long, b4 long, sketch array<long>, prefix array<long>"
    profiles = written(rows.mapInArrow(lambda it: _prefixes(it, size, percent, longest, shared.value), schema), "prefixes")
    classes = profiles.where("n > 0 AND id IS NOT NULL").groupBy("s1", "s2", "n").agg(F.min("id").alias("class"))
    # one row per class; a class that an id has twice counts once
    heads = profiles.join(classes.select("s1", "s2", "n", F.col("class").alias("id")), ["s1", "s2", "n", "id"])
    heads = written(heads.dropDuplicates(["id", "s1", "s2", "n"]).drop("s2"), "heads")
    keys = written(profiles.select("id", "n", "s1", "s2"), "keys")
    discard(profiles)
    classes = keys.where("n > 0 AND id IS NOT NULL").groupBy("s1", "s2", "n").agg(F.min("id").alias("class"))
    # an id that has rows of several sets is one node: it links the classes of its rows
    differ = keys.where("id IS NOT NULL").groupBy("id").agg(F.min(F.xxhash64("n", "s1", "s2")).alias("low"), F.max(F.xxhash64("n", "s1", "s2")).alias("high"))
    several = keys.join(differ.where("low != high").select("id"), "id", "left_semi").where("n > 0")
    own = written(several.join(classes, ["s1", "s2", "n"]).where("id != class").select(F.least("id", "class").alias("a"), F.greatest("id", "class").alias("b")).distinct(), "own")
    sketches = written(heads.select("id", "n", "sketch"), "sketches")
    entries = _listed(heads, percent, longest)

    def links(pairs: DataFrame) -> DataFrame:
        met = written(pairs, "pairs")
        pairs = written(_possible(met, sketches, percent), "candidates")
        ids = _ends(pairs)
        held = _sieved(rows, ids)
        if ids.count() > 1 << SIEVE_BITS - 3:  # the bitmap is getting full
            held = held.join(ids, "id", "left_semi")
        sets = held.mapInArrow(lambda it: _shingles(it, size), f"id {kind}, n long, sketch array<long>, grams array<long>")
        sets = written(sets, "sets")
        fine = written(_possible(pairs, sets, percent), "candidates")
        found = written(_verified(fine, sets, percent), "verified")
        discard(met, pairs, fine, sets)
        return found

    first = links(_stars(entries, percent)).union(own)
    found = components(first.union(links(_candidates(entries, components(first), percent))))
    discard(entries, sketches)

    out = keys.join(classes, ["s1", "s2", "n"], "left")
    out = out.withColumn("node", F.coalesce("class", "id")).join(found, "node", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "node"))
    groups = written(out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id")), "groups")
    discard(keys, own)
    return groups
