"""Scoring texts with a log-bilinear language model.

Symbols are the `HEAD` most frequent words, three classes for all other words (by their last character: full stop,
comma, other) and the end of a text. The model predicts a symbol from the two before it: the context is the sum of
their vectors, each through the matrix of its place, and a symbol's score is the product of its own vector with the
context, plus a bias. It is fitted in numpy by noise-contrastive estimation: tasks pass over the contexts of their own
training texts, starting from the same parameters, and Spark averages the parameters by number of tokens.

Normalisation is exact and needs one matrix product for all contexts: the score is a sum over the two places, so the
sum over symbols of exp(score) is exp(first + bias) @ exp(second).T.

Every word of `LEAST` training occurrences has a vector of its own, up to `OWN` words. Outside the head it is a leaf
of its class's binary tree, in which each inner node divides its probability by a logistic function of the context, so
that normalisation stays exact. The node's vector is the linear discriminant between the mean contexts below its two
children, drawn to their common mean where they are rare; Spark adds up the contexts of each word. As context of the
trees a word stands with its own vector, which a linear map takes from its mean context; the map is fitted on the head
words. Rarer and unseen words of a class share its leaf 0, with (c + 1) / (N' + V' + 1) of it each over the training
words there, so that one place is left for words never seen.

Word counts cover all training texts and stay in Spark. Those of the `COMMON` most frequent words are broadcast, all
others are joined by their hash; so what the driver holds and broadcasts does not grow with the corpus.

The words of a text are found and looked up once (`encoded`): the passes that fit and score read their places among
the common words, four bytes a token, from a written table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrue.llm.frequent import most_frequent
from accrue.llm.words import BLOCK_BYTES, Words, blocks, counted, list_array, text_bytes
from accrue.sources.shared import discard, written

HEAD = 1024
COMMON = 1 << 19  # words whose counts are broadcast
LEAST, OWN = 10, 1 << 17  # training occurrences of a word with its own vector, and how many such words at most
DRAWN = 30  # occurrences that the common mean counts for
DIMS = 24
ROUNDS = 2
BATCH, NOISE = 2048, 64
STEPS = 60  # of a pass, however many contexts it has
END_KEY = 0
_STOP, _COMMA, _OTHER, _END, _BEGIN = range(5)  # after the head words
_MAX_COUNTED = 1 << 20


class _Tokens:
    """Hash and class of each word of a column of texts, with an end behind each text."""

    def __init__(self, column: pa.Array):
        words = Words(column, lower=True)
        n = words.counts + 1
        self.counts = n
        self.doc = np.repeat(np.arange(len(n)), n)
        self.last = np.cumsum(n) - 1
        self.key = np.full(int(n.sum()), END_KEY, np.int64)
        self.kind = np.full(len(self.key), _END, np.int64)
        word = np.ones(len(self.key), bool)
        word[self.last] = False
        self.key[word] = words.hashes().view(np.int64)
        final = words.data[words.ends - 1]
        self.kind[word] = np.where(final == 46, _STOP, np.where(final == 44, _COMMA, _OTHER))


class _Codes:
    """The tokens of a column of `encoded` texts: the place of each word among the common ones, or -1 less its class."""

    def __init__(self, column: pa.Array):
        data, at = text_bytes(column)
        self.code = data.view("<i4").astype(np.int64)
        n = np.diff(at) // 4
        self.counts = n
        self.doc = np.repeat(np.arange(len(n)), n)
        self.last = np.cumsum(n) - 1


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The blocks of `blocks` for rows of `encoded`: sums of contexts are added up text block by text block."""
    at = np.append(0, np.cumsum(batch.column(batch.schema.get_field_index("size")).to_numpy()))
    row = 0
    while row < len(batch):
        end = max(row + 1, int(np.searchsorted(at, at[row] + BLOCK_BYTES, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts, pa.int64())], names=["key", "n"])

    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for held in batches:
        for batch in blocks(held, "text"):
            tokens = _Tokens(batch.column(0))
            more, n = counted(tokens.key & ~3 | tokens.kind)
            keys, counts = counted(np.concatenate((keys, more)), np.concatenate((counts, n)))
            if len(keys) > _MAX_COUNTED:
                yield out(keys, counts)
                keys, counts = keys[:0], counts[:0]
    yield out(keys, counts)


@dataclass
class Vocabulary:
    """Counts of the training texts: of the common words by hash, and in total."""

    keys: np.ndarray  # of the common words, ascending; the two lowest bits are the class
    counts: np.ndarray
    symbols: np.ndarray  # of the common words: the head words' own, else their class
    head: int
    tokens: int
    distinct: int
    class_tokens: np.ndarray  # of each class, outside the head
    class_words: np.ndarray
    ends: int  # training texts

    @property
    def size(self) -> int:
        return self.head + 5

    def places(self, tokens: _Tokens) -> np.ndarray:
        """The place of each word among the common ones; for other words and the end -1 less their class."""
        if not len(self.keys):
            return -1 - tokens.kind
        key = tokens.key & ~3 | tokens.kind
        distinct, _ = counted(key)  # far fewer than words, and in order: a block's words are sought among these
        at = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
        at = np.where((self.keys[at] == distinct) & (distinct & 3 != _END), at, -1 - (distinct & 3))
        return at[np.searchsorted(distinct, key)]

    @cached_property
    def by_code(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbol, count and class by code: behind the common words stand the end and the classes, which codes below zero count from the back."""
        behind = np.array([_END, _OTHER, _COMMA, _STOP])
        return np.append(self.symbols, self.head + behind), np.append(self.counts, [self.ends, -1, -1, -1]), np.append(self.keys & 3, behind)

    def look_up(self, tokens: _Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, symbol and count of each token; the count is -1 where the word is not common."""
        code = self.places(tokens)
        symbols, counts, _ = self.by_code
        return tokens.key & ~3 | tokens.kind, symbols[code], counts[code]

    def unigrams(self) -> np.ndarray:
        """Smoothed shares of the symbols; the begin of a text is never predicted."""
        n = np.zeros(self.size)
        np.add.at(n, self.symbols, self.counts)
        n[self.head : self.head + 4] = [*self.class_tokens, self.ends]
        n[:-1] += 1
        return n / n.sum()


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, n): how often each word occurs in the texts, as hashes whose two lowest bits are the class; key 3 is the end."""
    rows = docs.select(F.col(text).alias("text"))
    return written(rows.mapInArrow(_count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "counts")


def vocabulary(counts: DataFrame, head: int = HEAD, common: int = COMMON) -> Vocabulary:
    best = most_frequent(counts, common).toArrow().sort_by([("n", "descending"), ("key", "ascending")])
    keys, n = best["key"].to_numpy(), best["n"].to_numpy()
    kind = keys & 3
    words = np.flatnonzero(kind != _END)[:head]
    symbols = np.empty(len(keys), np.int64)
    symbols[:] = len(words) + kind
    symbols[words] = np.arange(len(words))
    totals = {r.kind: (r.n, r.v) for r in counts.groupBy(F.col("key").bitwiseAND(3).alias("kind")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    class_tokens, class_words = np.zeros(3), np.zeros(3)
    for k in range(3):
        held = words[kind[words] == k]
        total, distinct = totals.get(k, (0, 0))
        class_tokens[k], class_words[k] = total - n[held].sum(), distinct - len(held)
    order = np.argsort(keys)
    return Vocabulary(keys[order], n[order], symbols[order], len(words), sum(t for t, _ in totals.values()), sum(v for _, v in totals.values()), class_tokens, class_words, totals.get(_END, (0, 0))[0])


class LogBilinear:
    """Vectors and biases of the symbols, and a matrix for each of the two places before."""

    def __init__(self, shares: np.ndarray, dims: int = DIMS, seed: int = 9):
        rng = np.random.default_rng(seed)
        n = len(shares)
        self.shares = shares
        self.tails: Tails | None = None
        self.parts = [rng.normal(0, 0.1, (n, dims)), *(np.eye(dims) + rng.normal(0, 0.02, (dims, dims)) for _ in range(2)), np.log(np.maximum(shares, 1e-12))]

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    @flat.setter
    def flat(self, values: np.ndarray) -> None:
        at = 0
        for p in self.parts:
            p[...] = values[at : at + p.size].reshape(p.shape)
            at += p.size

    def fit(self, one: np.ndarray, two: np.ndarray, target: np.ndarray, weight: np.ndarray, seed: int, rate: float = 0.01) -> None:
        """`STEPS` steps of noise-contrastive estimation, which pass over all contexts (again, where they are few).

        So the number of steps does not depend on how the texts are dealt to tasks, only the size of the batches does. A
        batch shares its noise symbols, drawn by their shares.
        """
        rng = np.random.default_rng(seed)
        n, dims = self.parts[0].shape
        order = rng.permutation(len(target))
        log_noise = np.log(NOISE * np.maximum(self.shares, 1e-12))
        below = np.cumsum(self.shares[:-1])
        first, second = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts]

        def gathered(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
            return np.stack([np.bincount(at, weights=rows[:, d], minlength=n) for d in range(dims)], axis=1)

        size = min(len(order), max(BATCH, -(-len(order) // STEPS)))
        for step in range(1, STEPS + 1):
            rows = order[np.arange((step - 1) * size, step * size) % len(order)]
            a, b, w = one[rows], two[rows], target[rows]
            share = weight[rows] / weight[rows].sum()
            noise = np.minimum(np.searchsorted(below, rng.random(NOISE) * below[-1], "right"), n - 2)
            vectors, near, far, bias = self.parts
            context = vectors[a] @ near + vectors[b] @ far
            real = (context * vectors[w]).sum(axis=1) + bias[w] - log_noise[w]
            fake = context @ vectors[noise].T + bias[noise] - log_noise[noise]
            up = (1 / (1 + np.exp(-np.clip(real, -50, 50))) - 1) * share
            down = 1 / (1 + np.exp(-np.clip(fake, -50, 50))) * share[:, None]
            back = up[:, None] * vectors[w] + down @ vectors[noise]
            at_noise = down.T @ context
            slope = gathered(w, up[:, None] * context) + gathered(a, back @ near.T) + gathered(b, back @ far.T)
            np.add.at(slope, noise, at_noise)
            bias_slope = np.bincount(w, weights=up, minlength=n)
            np.add.at(bias_slope, noise, down.sum(axis=0))
            slopes = [slope, vectors[a].T @ back, vectors[b].T @ back, bias_slope]
            for p, g, m, s in zip(self.parts, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores by the symbol before (bias included) and by the one before that, with log sums over symbols taken off by `log_total`."""
        vectors, near, far, bias = self.parts
        return (vectors @ near) @ vectors[:-1].T + bias[:-1], (vectors @ far) @ vectors[:-1].T

    @staticmethod
    def log_total(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """For each pair of symbols the log of the sum of exp(score) over all predicted symbols, by one matrix product."""
        top_one, top_two = one.max(axis=1, keepdims=True), two.max(axis=1, keepdims=True)
        return np.log(np.exp(one - top_one) @ np.exp(two - top_two).T) + top_one + top_two.T


def _contexts(tokens: _Codes, symbol: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbol before each token, and the one before that."""
    one, two = np.roll(symbol, 1), np.roll(symbol, 2)
    start = tokens.last - tokens.counts + 1
    one[start] = two[start] = begin
    second = start[tokens.counts > 1] + 1
    two[second] = begin
    return one, two


CODES = "row long, id {kind}, n_tokens long, codes binary, size long, rare array<long>, times array<int>"


def encoded(docs: DataFrame, known: Vocabulary, id_col: str = "doc_id", text: str = "text", carry: str | None = None) -> DataFrame:
    """(row, id, n_tokens, codes, size, rare, times[, carried]): every text as the places of its words, written once for all passes.

    `codes` holds four bytes a token; `size` is the number of the text's bytes; `rare` are the hashes of a text's words that are not common, `times` how often each
    occurs; `row` tells rows apart. `carried` is the column named by `carry`. The table is one of `written`.
    """
    words = docs.sparkSession.sparkContext.broadcast(known)
    rows = docs.select(F.col(text).alias("text"), F.col(id_col).alias("id"), *([] if carry is None else [F.col(carry).alias("carried")]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for held in batches:
            for batch in blocks(held, "text"):
                tokens = _Tokens(batch.column(0))
                size = np.diff(text_bytes(batch.column(0))[1])
                code = words.value.places(tokens)
                raw = pa.Array.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer((4 * np.append(0, np.cumsum(tokens.counts))).astype(np.int64).tobytes()), pa.py_buffer(code.astype("<i4").tobytes())])
                rare = (code < 0) & (tokens.kind != _END)
                key, doc = tokens.key[rare] & ~3 | tokens.kind[rare], tokens.doc[rare]
                order = np.lexsort((key, doc))
                key, doc = key[order], doc[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                times = np.diff(np.append(np.flatnonzero(new), len(key)))
                per_row = np.bincount(doc[new], minlength=len(batch))
                columns = [pa.array(np.arange(row, row + len(batch))), batch.column(1), pa.array(tokens.counts, pa.int64()), raw.cast(pa.binary()), pa.array(size, pa.int64())]
                columns += [list_array(key[new], per_row, pa.int64()), list_array(times.astype(np.int32), per_row, pa.int32()), *batch.columns[2:]]
                row += len(batch)
                yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "n_tokens", "codes", "size", "rare", "times", *["carried"] * (carry is not None)])

    schema = CODES.format(kind=rows.schema["id"].dataType.simpleString())
    if carry is not None:
        schema += f", carried {rows.schema['carried'].dataType.simpleString()}"
    table = written(rows.mapInArrow(encode, schema), "codes")
    words.destroy()
    return table


def fit(docs: DataFrame, known: Vocabulary, text: str = "text", rounds: int = ROUNDS) -> LogBilinear:
    """The model after `rounds` passes over all texts, each averaged over the tasks."""
    codes = encoded(docs.select(F.lit(0).alias("id"), F.col(text).alias("text")), known, "id")
    model = fit_encoded(codes, known, rounds)
    discard(codes)
    return model


def fit_encoded(codes: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> LogBilinear:
    """`fit` over rows of `encoded`."""
    model = LogBilinear(known.unigrams())
    n, spark = known.size, codes.sparkSession
    words = spark.sparkContext.broadcast(known)
    rows = codes.select("codes", "size")
    for turn in range(rounds):
        now = spark.sparkContext.broadcast(model.flat)

        def train(batches: Iterator[pa.RecordBatch], turn: int = turn, now: object = now) -> Iterator[pa.RecordBatch]:
            codes, weights, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
            own = LogBilinear(words.value.unigrams())
            own.flat = now.value

            def learn(step: int) -> None:
                own.fit(codes // n % n, codes // n // n, codes % n, weights.astype(np.float64), 1000 * turn + step, 0.01 / (1 + turn))

            step = 0
            for held in batches:
                for batch in _blocks(held):
                    tokens = _Codes(batch.column(0))
                    symbol = words.value.by_code[0][tokens.code]
                    one, two = _contexts(tokens, symbol, n - 1)
                    seen += len(symbol)
                    more, count = counted((two * n + one) * n + symbol)
                    codes, weights = counted(np.concatenate((codes, more)), np.concatenate((weights, count)))
                    if len(codes) > _MAX_COUNTED:
                        learn(step)
                        codes, weights, step = codes[:0], weights[:0], step + 1
            if len(codes):
                learn(step)
            if seen:
                values = own.flat
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values * seen), pa.array(np.full(len(values), float(seen)))], names=["at", "value", "weight"])

        mean = rows.mapInArrow(train, "at long, value double, weight double").groupBy("at").agg((F.sum("value") / F.sum("weight")).alias("value")).orderBy("at").toArrow()
        if mean.num_rows:
            model.flat = mean["value"].to_numpy()
    model.tails = _fit_tails(rows, known, words, model)
    return model


_PART = 1 << 15
_SUM = "at long, scale float, sums binary"


def _packed(at: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """Rows of sums in two bytes a number, against the largest of their row."""
    scale = np.maximum(np.abs(sums).max(axis=1, initial=0), 1e-30).astype(np.float32)
    data = np.round(sums / scale[:, None] * 32767).astype("<i2").tobytes()
    offsets = (np.arange(len(at) + 1, dtype=np.int32) * 2 * DIMS).tobytes()
    raw = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(scale, pa.float32()), raw], names=["at", "scale", "sums"])


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data = text_bytes(batch.column(2))[0].view("<i2").reshape(-1, DIMS)
    return batch.column(0).to_numpy(), data * (batch.column(1).to_numpy().astype(np.float64) / 32767)[:, None]


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one place, which follow each other, as one row."""
    last, held = np.zeros(0, np.int64), np.zeros((0, DIMS))
    for batch in batches:
        at, sums = _unpacked(batch)
        at, sums = np.concatenate((last, at)), np.concatenate((held, sums))
        begin = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else np.zeros(0, np.int64)
        sums = np.add.reduceat(sums, begin, axis=0) if len(begin) else sums
        last, held = at[begin][-1:], sums[-1:]
        yield _packed(at[begin][:-1], sums[:-1])
    yield _packed(last, held)


def _parts(words: np.ndarray) -> list[np.ndarray]:
    return [words[at : at + _PART] for at in range(0, len(words), _PART)]


class Tails:
    """Words with vectors outside the head: their leaves in the trees of the three classes, and their vectors as context."""

    def __init__(self, known: Vocabulary, model: LogBilinear):
        self.size, self.head = known.size, known.head
        many = (known.counts >= LEAST) & (known.keys & 3 != _END)
        if many.sum() > OWN:  # those of one count have vectors or have not
            many &= known.counts > np.sort(known.counts[many])[-OWN - 1]
        self.has = many
        self.at = np.where(self.has, np.cumsum(self.has) - 1, -1)  # by place among the common words
        self.n, self.kind, self.symbols = known.counts[self.has], known.keys[self.has] & 3, known.symbols[self.has]
        self.outside = self.symbols >= known.head
        self.leaf = np.zeros(len(self.n), np.int64)
        self.vectors = model.parts[0].astype(np.float32)  # of the symbols, then of the words with vectors
        self.near, self.far = (m.astype(np.float32) for m in model.parts[1:3])
        held = [self.outside & (self.kind == k) for k in range(3)]
        self.rare = np.array([known.class_tokens[k] - self.n[held[k]].sum() + known.class_words[k] - held[k].sum() + 1 for k in range(3)])
        self.trees: list[np.ndarray] = []
        self.turned: tuple[np.ndarray, ...] = ()

    def contexts(self, tokens: _Codes, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The word with a vector of each token, or -1, and each token's context."""
        word = np.append(self.at, np.full(4, -1))[tokens.code]
        seen = np.where((word >= 0) & (symbol >= self.head), self.size + word, symbol) if len(self.vectors) > self.size else symbol
        one, two = _contexts(tokens, seen, self.size - 1)
        if not self.turned:  # each vector through both matrices, once in a worker rather than for every token
            self.turned = (self.vectors @ self.near, self.vectors @ self.far)
        return word, self.turned[0][one] + self.turned[1][two]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"turned": ()}

    def sums(self, batches: Iterator[pa.RecordBatch], known: Vocabulary) -> Iterator[pa.RecordBatch]:
        """Summed contexts by word, then by class for the words of its leaf 0, then the products of the dimensions."""
        n = len(self.n)
        total = np.zeros((n + 3 + DIMS, DIMS), np.float32)
        seen = np.zeros(len(total), bool)
        symbols, _, kinds = known.by_code
        for held in batches:
            for batch in _blocks(held):
                tokens = _Codes(batch.column(0))
                symbol, kind = symbols[tokens.code], kinds[tokens.code]
                word, context = self.contexts(tokens, symbol)
                to, inner = np.where(word >= 0, word, n + kind), kind != _END
                to, context = to[inner], context[inner]
                # by word and place in the block, as one number: plain numbers sort faster than an order is found
                both = np.sort(to << 32 | np.arange(len(to)))
                at, count = counted(both >> 32)
                if len(at):
                    total[at] += np.add.reduceat(context[both & 0xFFFFFFFF], np.cumsum(count) - count, axis=0)
                    seen[at] = True
                    total[n + 3 :] += context.T @ context
                    seen[n + 3 :] = True
        rows = np.flatnonzero(seen)
        for begin in range(0, len(rows), _PART):
            yield _packed(rows[begin : begin + _PART], total[rows[begin : begin + _PART]])

    def learn_vectors(self, total: np.ndarray) -> None:
        n, head = len(self.n), self.head
        middle = total[: n + 3].sum(axis=0, dtype=np.float64) / max(1, self.n.sum() + self.rare.sum())
        drawn = total[:n]  # in place: the table is as large as the vocabulary
        drawn -= self.n[:, None].astype(np.float32) * middle.astype(np.float32)
        drawn /= (self.n[:, None] + DRAWN).astype(np.float32)
        inner = ~self.outside
        x, y = drawn[inner], self.vectors[self.symbols[inner]]
        if not len(x):
            return
        weight = np.sqrt(self.n[inner])[:, None]
        mean = (weight * y).sum(axis=0) / weight.sum()
        square = x.T @ (weight * x)
        step = np.linalg.solve(square + (0.01 * np.trace(square) / DIMS + 1e-9) * np.eye(DIMS), x.T @ (weight * (y - mean)))
        self.vectors = np.concatenate((self.vectors, self.vectors[head + self.kind] + drawn @ step.astype(np.float32)))

    def learn_trees(self, total: np.ndarray) -> None:
        n = len(self.n)
        tokens = max(1.0, float(self.n.sum() + self.rare.sum()))
        middle = total[: n + 3].sum(axis=0, dtype=np.float64) / tokens
        spread = total[n + 3 :] / tokens - np.outer(middle, middle)
        spread = (spread + spread.T) / 2
        inverse = np.linalg.inv(spread + (0.01 * np.trace(spread) / DIMS + 1e-6) * np.eye(DIMS)).astype(np.float32)
        main = np.linalg.eigh(spread)[1][:, ::-1][:, :6].astype(np.float32)
        for k in range(3):
            words = np.flatnonzero(self.outside & (self.kind == k))
            mean = (sum(total[p].sum(axis=0, dtype=np.float64) for p in _parts(words)) + total[n + k]) / max(1.0, float(self.n[words].sum() + self.rare[k]))
            code = np.concatenate([(((total[p] / self.n[p, None] - mean) @ main) > 0) @ (1 << np.arange(6)[::-1]) for p in _parts(words)] or [words])
            words = words[np.argsort(code, kind="stable")]
            depth = int(len(words)).bit_length()  # leaf 0 is that of the rare words
            self.leaf[words] = (1 << depth) + 1 + np.arange(len(words))
            count, sums = np.zeros(1 << depth, np.float32), np.zeros((1 << depth, DIMS), np.float32)
            count[0], sums[0] = self.rare[k], total[n + k]
            count[1 : len(words) + 1] = self.n[words]
            for i, p in enumerate(_parts(words)):
                sums[1 + i * _PART : 1 + i * _PART + len(p)] = total[p]
            nodes = np.zeros((1 << depth, DIMS + 1), np.float32)
            for level in range(depth - 1, -1, -1):
                n_nodes = 1 << level
                up, up_sums = np.empty(n_nodes, np.float32), np.empty((n_nodes, DIMS), np.float32)
                for begin in range(0, n_nodes, _PART):
                    end = min(n_nodes, begin + _PART)
                    counts, both = count[2 * begin : 2 * end].reshape(-1, 2), sums[2 * begin : 2 * end].reshape(-1, 2, DIMS)
                    up[begin:end], up_sums[begin:end] = counts.sum(axis=1), both.sum(axis=1)
                    parent = up_sums[begin:end] / np.maximum(up[begin:end], 1)[:, None]
                    left, right = ((both[:, j] + DRAWN * parent) / (counts[:, j, None] + DRAWN) for j in range(2))
                    vector = (right - left) @ inverse
                    bias = np.log(np.maximum(counts[:, 1], 1e-20) / np.maximum(counts[:, 0], 1e-20)) - (vector * (left + right)).sum(axis=1) / 2
                    empty = (counts == 0).any(axis=1)
                    vector[empty], bias[empty] = 0, np.where(counts[empty, 1] > 0, 60, -60)
                    nodes[n_nodes + begin : n_nodes + end, :DIMS], nodes[n_nodes + begin : n_nodes + end, DIMS] = vector, bias
                count, sums = up, up_sums
            self.trees.append(nodes)

    def log10(self, kind: np.ndarray, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Log probabilities of words' leaves within their classes."""
        out = np.zeros(len(kind))
        for k, nodes in enumerate(self.trees):
            rows = np.flatnonzero(kind == k)
            at, own, log = np.where(word[rows] >= 0, self.leaf[word[rows]], len(nodes)) if len(self.leaf) else np.full(len(rows), len(nodes)), context[rows], np.zeros(len(rows))
            for _ in range(len(nodes).bit_length() - 1):
                side = (at & 1).astype(np.float32) * 2 - 1
                at >>= 1
                node = nodes[at]
                score = side * (np.einsum("nd,nd->n", node[:, :DIMS], own) + node[:, DIMS])
                log -= np.log1p(np.exp(-np.abs(score))) + np.maximum(-score, 0)
            out[rows] = log / np.log(10)
        return out


def _fit_tails(rows: DataFrame, known: Vocabulary, words: object, model: LogBilinear) -> Tails:
    tails = Tails(known, model)
    for learn in (tails.learn_vectors, tails.learn_trees):
        now = rows.sparkSession.sparkContext.broadcast(tails)

        def task(batches: Iterator[pa.RecordBatch], now: object = now) -> Iterator[pa.RecordBatch]:
            yield from now.value.sums(batches, words.value)

        parts = rows.mapInArrow(task, _SUM).repartition("at").sortWithinPartitions("at", "scale", "sums")
        held = written(parts.mapInArrow(_add_up, _SUM), "contexts")
        total = np.zeros((len(tails.n) + 3 + DIMS, DIMS), np.float32)
        for batch in held.toArrow().to_batches(_PART):
            at, sums = _unpacked(batch)
            total[at] = sums
        discard(held)
        learn(total)
        now.destroy()
    return tails


def score(docs: DataFrame, counts: DataFrame, known: Vocabulary, model: LogBilinear, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score): log10 probabilities of every row's text and its end.

    A null text is an empty one, which has its end alone. base_score is that of the smoothed word counts. Rows that
    repeat are scored one by one.
    """
    codes = encoded(docs, known, id_col, text)
    scored = score_encoded(codes, counts, known, model)
    discard(codes)
    return scored.withColumnRenamed("id", id_col)


def score_encoded(codes: DataFrame, counts: DataFrame, known: Vocabulary, model: LogBilinear) -> DataFrame:
    """`score` over rows of `encoded`, which may be discarded afterwards."""
    one, two = model.tables()
    shared = codes.sparkSession.sparkContext.broadcast((known, model.tails, one.astype(np.float32), two.astype(np.float32), model.log_total(one, two).astype(np.float32)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tails, by_one, by_two, total = shared.value
        class_log, (symbols, n_times, _) = np.log10(tails.rare), words.by_code
        for held in batches:
            for batch in _blocks(held):
                tokens = _Codes(batch.column(3))
                symbol, count = symbols[tokens.code], n_times[tokens.code]
                word, context = tails.contexts(tokens, symbol)
                before, earlier = _contexts(tokens, symbol, words.size - 1)
                log = (by_one[before, symbol] + by_two[earlier, symbol] - total[before, earlier]).astype(np.float64) / np.log(10)
                own = np.log10(np.maximum(count, 0) + 1.0)
                kind = symbol - words.head
                tail = (kind >= 0) & (kind < 3)
                log[tail] += tails.log10(kind[tail], word[tail], context[tail])
                tail &= word < 0
                log[tail] += own[tail] - class_log[kind[tail]]
                sums = [np.bincount(tokens.doc, weights=x, minlength=len(batch)) for x in (count > 0, own, log)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], names=["row", "id", "n_tokens", "n_known", "base", "model"])

    kind = codes.schema["id"].dataType.simpleString()
    rows = codes.select("row", "id", "n_tokens", "codes", "size")
    parts = written(rows.mapInArrow(measure, f"row long, id {kind}, n_tokens long, n_known long, base double, model double"), "scores")
    rare = codes.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("key"), F.col("x.times").alias("times"))
    found = rare.join(counts, "key").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs"))
    found = written(found, "rare")
    logs = F.coalesce("logs", F.lit(0.0))
    base = F.col("base") + logs - F.col("n_tokens") * F.lit(float(np.log10(known.tokens + known.distinct + 1)))
    return parts.join(found, "row", "left").select(
        "id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )
