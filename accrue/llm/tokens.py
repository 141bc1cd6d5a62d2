"""Token ids of whole texts by a public tokenizer, each distinct stretch of text encoded once per worker.

A byte-level tokenizer whose pattern never crosses from a visible character to white space gives a text the ids of its
stretches (white space and the visible characters after it), one behind the other. Those repeat a lot, so a worker
keeps the ids of the stretches it has seen, up to `MAX_KNOWN`, and starts anew beyond. Any other tokenizer gets whole texts.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import SparkSession

from accrue.llm.words import Words, ragged, text_bytes

MAX_KNOWN = 3 << 19
END = 0
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# last bytes but one of the other white space of Unicode; no cut is made behind any character with such a byte there
_UNSURE = np.zeros(256, dtype=bool)
_UNSURE[[0xC2, 0x80, 0x81, 0x9A]] = True


class _Stretches(Words):
    """White space and the visible characters behind it; no byte is left out."""

    def __init__(self, column: pa.Array, cut: bool):
        data, at = text_bytes(column)
        self.data, self.at = data, at
        begins = np.zeros(len(data), bool)
        if cut and len(data):
            space = _SPACE[data]
            sure = ~space
            sure[1:] &= (data[1:] < 0x80) | ~_UNSURE[data[:-1]]
            begins[1:] = space[1:] & sure[:-1]
        edges = at[:-1]
        begins[edges[edges < len(data)]] = True
        self.inside = np.ones(len(data), bool)
        self.starts = np.flatnonzero(begins)
        self.ends = np.append(self.starts[1:], len(data)) if len(self.starts) else self.starts
        self.first = np.searchsorted(self.starts, at)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(at) - 1), self.counts)


class Encoder:
    """Ids of texts; `END` behind each text."""

    def __init__(self, description: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        told = json.loads(description)
        first = told.get("pre_tokenizer") or {}
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not any(c.isspace() for c in t["content"]) for t in told.get("added_tokens", []))
        self.cut = told.get("normalizer") is None and first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space") and plain
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.uint32)
        self.length = np.zeros(0, np.uint32)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        held = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        length = np.array([len(x) for x in held], dtype=np.uint32)
        begin = (np.cumsum(length, dtype=np.int64) - length + len(self.ids)).astype(np.uint32)
        self.ids = np.concatenate((self.ids, np.array([i for x in held for i in x], dtype=np.uint32)))
        keys = np.concatenate((self.keys, keys))
        order = np.argsort(keys, kind="stable")
        self.keys, self.begin, self.length = keys[order], np.concatenate((self.begin, begin))[order], np.concatenate((self.length, length))[order]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, and how many each text has, its end included."""
        parts = _Stretches(column, self.cut)
        # the length in the key besides the hash of the bytes
        keys = parts.hashes(11) ^ ((parts.ends - parts.starts).astype(np.uint64) << np.uint64(40))
        order = np.argsort(keys)
        new = np.ones(len(keys), bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        distinct, which = keys[order[new]], order[new]
        inverse = np.empty(len(keys), np.int64)
        inverse[order] = np.cumsum(new) - 1
        if len(self.keys) > MAX_KNOWN or len(self.ids) > 8 * MAX_KNOWN:
            self.forget()
        at = np.searchsorted(self.keys, distinct)
        missing = np.ones(len(distinct), bool)
        inside = at < len(self.keys)
        missing[inside] = self.keys[at[inside]] != distinct[inside]
        if missing.any():
            self._learn(distinct[missing], [parts.word(i).decode("utf-8", "replace") for i in which[missing]])
            at = np.searchsorted(self.keys, distinct)
        at = at[inverse]
        length = self.length[at].astype(np.int64)
        total = np.bincount(parts.doc, weights=length, minlength=len(parts.counts)).astype(np.int64) + 1
        out = np.full(int(total.sum()), END, dtype=np.uint32)
        content = np.ones(len(out), bool)
        content[np.cumsum(total) - 1] = False
        out[content] = self.ids[ragged(self.begin[at].astype(np.int64), length)]
        return out, total


_KNOWN: dict[int, Encoder] = {}


def encoder(description: Broadcast) -> Encoder:
    """The worker's encoder of a broadcast tokenizer description."""
    key = hash(description.value)
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = Encoder(description.value)
    return _KNOWN[key]


def tokenizer_description(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer's file (a few MB) for the executors, which need not have it."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())
