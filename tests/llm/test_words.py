import random

import numpy as np
import pyarrow as pa
import pytest

from accrue.llm.words import ALPHANUMERIC, SPACED, Words, blocks, counted, joined, rolling, sliding_min, whole
from cases import ODD, words


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_are_those_of_the_pattern(kind):
    texts = [r[1] for r in ODD]
    found = Words(pa.array(texts, kind).slice(1), SPACED)
    for row, text in enumerate(texts[1:]):
        own = [found.word(i).decode() for i in range(found.first[row], found.first[row + 1])]
        assert own == words(text)
    assert joined(found, np.ones(len(found), bool)).to_pylist() == [" ".join(words(t)) for t in texts[1:]]


def test_lower_case_alphanumeric_words():
    found = Words(pa.array(["Ab-c, D1É é_x", None, "--"]), ALPHANUMERIC, lower=True)
    assert [found.word(i).decode() for i in range(len(found))] == ["ab", "c", "d1É", "é", "x"]
    assert found.counts.tolist() == [5, 0, 0]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "b", "ab", "ba", "aab", "é", "a" * 300]) for _ in range(40)) for _ in range(30)]
    together = Words(pa.array(texts)).hashes()
    alone = np.concatenate([Words(pa.array([t])).hashes() for t in texts])
    assert (together == alone).all()
    assert len({*together.tolist()}) == 7


@pytest.mark.parametrize("size", [1, 2, 3, 10, 26, 50])
def test_rolling_hashes_tell_runs_apart(size):
    rng = np.random.default_rng(size)
    values = rng.integers(0, 3, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    hashes = rolling(values, size)
    runs = [tuple(values[i : i + size].tolist()) for i in range(len(values) - size + 1)]
    assert len(hashes) == len(runs)
    assert len({*zip(runs, hashes.tolist())}) == len({*runs}) == len({*hashes.tolist()})
    assert sliding_min(values, size).tolist() == [min(r) for r in runs]
    assert len(rolling(values[: size - 1], size)) == 0


def test_runs_stay_within_a_text():
    assert whole(np.array([0, 0, 0, 1, 1]), 2).tolist() == [True, True, False, True]
    assert whole(np.array([], int), 2).tolist() == []


def test_blocks_cover_all_rows_once():
    batch = pa.record_batch([pa.array(range(len(ODD))), pa.array([r[1] for r in ODD])], names=["id", "text"])
    for limit in (1, 100, 10**9):
        parts = list(blocks(batch, "text", limit))
        assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(ODD)))
    assert list(blocks(batch.slice(0, 0))) == []


def test_counted():
    values, n = counted(np.array([3, 1, 3]))
    assert (values.tolist(), n.tolist()) == ([1, 3], [1, 2])
    values, n = counted(np.array([3, 1, 3]), np.array([5, 1, 7]))
    assert (values.tolist(), n.tolist()) == ([1, 3], [1, 12])
