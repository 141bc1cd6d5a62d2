import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import ODD, docs_of
from test_tokens import odd_texts
from tokenizers import Tokenizer

from accrue.llm.hilbert import WordEncoder, curve_keys, falling_powers, hilbert_key, pack_along_curve, tokens_and_points

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def direct(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_stretches_give_the_ids_of_whole_texts(tokenizer):
    more = ["ΑΣ ΑΣ.", "á ́b", "İstanbul İ", "it's  IT'S", "<|startoftext|> <|endoftext|>x", "가 ᆨ", "Å ̧ç"]
    own, texts = WordEncoder(tokenizer.to_str()), odd_texts() + more
    assert own.cut
    for part in (texts, texts[::-1]):
        ids, total = own.encode(pa.array(part, pa.string()))
        ends = np.cumsum(total)
        for text, end, n in zip(part, ends, total):
            assert ids[end - n : end].tolist() == direct(tokenizer, text), repr(text)


def test_other_tokenizers_get_whole_texts_or_their_own_stretches():
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids, _ = WordEncoder(other.to_str(), 7).encode(pa.array(["a b  c", ""]))
    assert ids.tolist() == [*other.encode("a b  c").ids, 7, 7]


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_once_and_neighbours_in_turn(dims, bits):
    side = np.arange(1 << bits)
    cells = np.stack([a.ravel() for a in np.meshgrid(*[side] * dims, indexing="ij")], axis=1)
    keys = hilbert_key(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_falling_powers():
    assert falling_powers(0) == [] and falling_powers(13) == [8, 4, 1]
    assert all(sum(falling_powers(n)) == n for n in range(5000))


def check(rows, texts, tokenizer, size):
    """Every id in exactly one piece, sequences gapless and full or a power of two."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at == size or (at < size and at & (at - 1) == 0)
    want = defaultdict(list)
    for i, text in texts:
        want[i].append(direct(tokenizer, text))
    assert {*docs} == {*want}
    for i, of in want.items():
        if len(of) == 1:
            at = 0
            for start, length, crc, total in sorted(docs[i]):
                assert start == at and total == len(of[0])
                assert crc == crc32(np.array(of[0][start : start + length], "<u4").tobytes())
                at += length
            assert at == len(of[0])
        else:  # of rows that share an id only what all hold together can be told
            assert sum(n for _, n, _, _ in docs[i]) == sum(map(len, of))


@pytest.mark.parametrize("size", [16, 4096])
def test_odd_rows(spark, tokenizer, size):
    rows = pack_along_curve(docs_of(spark, ODD), PATH, size=size)
    check(rows.collect(), [r[:2] for r in ODD], tokenizer, size)


@pytest.mark.parametrize("ids", [300, 1 << 20])
def test_many_ranges_with_one_text_for_most_rows(spark, tokenizer, ids):
    rng = random.Random(4)
    texts = [(i, "the very same words again" if i % 3 else " ".join(rng.choice("north south east west up down".split()) for _ in range(rng.randrange(90)))) for i in range(900)]
    rows = pack_along_curve(docs_of(spark, texts), PATH, size=64, range_ids=ids, least_ids=ids).collect()
    check(rows, texts, tokenizer, 64)
    if ids == 300:
        ways = defaultdict(int)
        for r in rows:
            ways[r.sequence_id >> 40] += r.length
        assert len(ways) > 10 and max(ways.values()) < 4 * sum(ways.values()) / len(ways)


def test_like_documents_lie_side_by_side(spark):
    rng = random.Random(5)
    topics = [[f"{a}{b}{t}" for a in "bcdfg" for b in "aeiou"] for t in ("m", "n", "p", "r", "s", "t")]
    texts = [(i, " ".join(rng.choice(topics[i % 6]) for _ in range(60))) for i in range(600)]
    keyed = curve_keys(tokens_and_points(docs_of(spark, texts), PATH)).select("id", "key").collect()
    order = [r.id % 6 for r in sorted(keyed, key=lambda r: r.key)]
    alike = sum(a == b for a, b in zip(order, order[1:]))
    assert alike > 0.6 * len(order)  # one in six by chance


def test_equal_texts_have_equal_keys(spark):
    texts = [(i, ["one two three", "four five", None, ""][i % 4] if i % 5 else f"filler {i} " * (i % 50)) for i in range(400)]
    keys = defaultdict(set)
    for r in curve_keys(tokens_and_points(docs_of(spark, texts).repartition(7), PATH)).select("id", "key").collect():
        keys[texts[r.id][1] or ""].add(r.key)
    assert all(len(k) == 1 for k in keys.values())


def test_an_empty_table_and_text_ids(spark, tokenizer):
    assert pack_along_curve(docs_of(spark, []), PATH).count() == 0
    rows = pack_along_curve(spark.createDataFrame([("k", "a b"), ("l", None)], "doc_id string, text string"), PATH).collect()
    check(rows, [("k", "a b"), ("l", None)], tokenizer, 4096)
