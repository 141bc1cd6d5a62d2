import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from cases import ODD, docs_of
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from accrue.llm.packing import best_fit, least_bins, pack, pieces
from accrue.llm.tokenfile import TokenFile, read_token_files, write_token_files
from accrue.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPACES = " \t\n\r\x0b\x0c\x85\xa0     　"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def direct(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def odd_texts():
    rng = random.Random(8)
    pieces = [*SPACES, "a", "the", "'s", "'", "12", "é", "語", "<|endoftext|>", "!", "-", "\U0001f600", "ça", "Ã", "̀"]
    return [r[1] for r in ODD] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(1500)]


def test_stretches_give_the_ids_of_whole_texts(tokenizer):
    own, texts = Encoder(tokenizer.to_str()), odd_texts()
    assert own.cut
    for part in (texts, texts[::-1]):  # the second time from memory
        ids, total = own.encode(pa.array(part, pa.string()))
        ends = np.cumsum(total)
        for text, end, n in zip(part, ends, total):
            assert ids[end - n : end].tolist() == direct(tokenizer, text), repr(text)


def test_other_tokenizers_get_whole_texts():
    other = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    own, texts = Encoder(other.to_str()), ["a b  c", "", "A  B"]
    ids, total = own.encode(pa.array(texts))
    assert not own.cut and ids.tolist() == [i for t in texts for i in direct(other, t)] and total.sum() == len(ids)


def fewest(lengths, size):
    """Brute force: the least number of bins."""
    for n in range(1, len(lengths) + 1):
        rooms = [size] * n

        def fits(k):
            if k == len(lengths):
                return True
            for b in range(n):
                if rooms[b] >= lengths[k] and rooms[b] not in rooms[:b]:
                    rooms[b] -= lengths[k]
                    if fits(k + 1):
                        return True
                    rooms[b] += lengths[k]
            return False

        if fits(0):
            return n
    return 0


@pytest.mark.parametrize("seed", range(40))
def test_bounds_never_exceed_the_optimum(seed):
    rng = random.Random(seed)
    size = rng.choice([10, 17, 30])
    lengths = sorted((rng.randrange(1, size + 1) for _ in range(rng.randrange(1, 9))), reverse=True)
    bins, offsets = best_fit(lengths, size)
    best = fewest(lengths, size)
    assert least_bins(np.array(lengths), size) <= best <= max(bins) + 1
    held = sorted(zip(bins, offsets, lengths))
    for (b, o, n), (c, p, _) in zip(held, held[1:]):
        assert (p == 0) if c != b else (p == o + n)
    assert all(o + n <= size for _, o, n in held)


def test_bounds_beyond_the_sum():
    assert least_bins(np.array([6, 6, 6, 4]), 10) == 3
    assert least_bins(np.array([4] * 5), 10) == 3  # two fit a bin, though three would by their sum
    assert least_bins(np.array([], int), 10) == 0


def check(rows, tokenizer, packed, size):
    by, sequences = {}, {}
    for r in packed.collect():
        by.setdefault(r.id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    for i, text in rows:
        ids = direct(tokenizer, text)
        own = sorted(by[i], key=lambda r: r.piece)
        assert [r.start for r in own] == [sum(p.length for p in own[:k]) for k in range(len(own))]
        assert [r.length for r in own] == [len(ids) - (len(own) - 1) * size, *[size] * (len(own) - 1)] and 1 <= own[0].length <= size
        for r in own:
            assert r.ids_crc32 == crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    return sequences


@pytest.mark.parametrize("group_rows", [7, 1 << 16])
def test_packing_of_odd_texts(spark, tokenizer, group_rows):
    rng = random.Random(2)
    rows = list(dict((r[0], r) for r in ODD if r[0] is not None and r[0] not in (8, 9)).values()) + [(100 + i, " ".join(["word"] * rng.randrange(70))) for i in range(150)]
    rows.append((-7, "end " * 64 + "x" * 0))
    cut = pieces(docs_of(spark, rows), PATH, size=64)
    sequences = check(rows, tokenizer, pack(cut, 64, group_rows), 64)
    total = sum(len(direct(tokenizer, t)) for _, t in rows)
    # a group of its own may end with a bin that is not full
    assert len(sequences) <= -(-total // 64) + 1 + cut.count() // group_rows


def test_exchange_mends_gaps(spark):
    lengths = [3, 3, 4, 4, 7, 6, 3, 7, 5, 5] * 12
    rows = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], "id long, piece int, start long, length long, ids_crc32 long")
    apart = pack(rows, 10, group_rows=10, rounds=0).select("sequence_id").distinct().count()
    mended = pack(rows, 10, group_rows=10, rounds=4)
    assert mended.count() == len(lengths)
    assert sum(lengths) / 10 <= mended.select("sequence_id").distinct().count() <= apart


def test_rows_of_one_id_spread_over_groups(spark):
    rows = spark.range(4000).selectExpr("CAST(NULL AS LONG) AS id", "0 AS piece", "0L AS start", "CAST(1 + id % 7 AS LONG) AS length", "0L AS ids_crc32")
    got = pack(rows, 10, group_rows=500, rounds=0)
    groups = [r["count"] for r in got.groupBy((F.col("sequence_id") / 2**32).cast("int").alias("g")).count().collect()]
    assert set(got.columns) == {*rows.columns, "offset", "bins", "bound", "sequence_id"}
    assert sum(groups) == 4000 and len(groups) == 8 and max(groups) < 700


def test_pieces_of_rows_that_repeat_or_have_no_id(spark, tokenizer):
    got = pack(pieces(docs_of(spark, ODD), PATH)).collect()
    assert sum(r.length for r in got) == sum(len(direct(tokenizer, r[1])) for r in ODD)
    assert pack(pieces(docs_of(spark, []), PATH)).count() == 0


def test_token_files(spark, tokenizer, tmp_path):
    rows = ODD + [(1000 + i, f"document {i} " * (i % 50)) for i in range(200)]
    path = f"{tmp_path}/files"
    write_token_files(docs_of(spark, rows), path, PATH, frame_ids=300, file_bytes=900, partition_bytes=200_000)
    got = sorted(read_token_files(spark, path, T.LongType(), with_ids=True).collect(), key=lambda r: r.start)
    start = 0
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert len(got) == len(rows)
    for r, (i, text) in zip(got, ordered):
        ids = direct(tokenizer, text)
        assert (r.id, r.start, r.n_tokens, r.ids_crc32, r.ids) == (i, start, len(ids), crc32(np.array(ids, "<u4").tobytes()), ids)
        start += len(ids)
    some = read_token_files(spark, path, T.LongType(), ids=[7, 1003, 55555], with_ids=True).collect()
    assert {r.id: r.ids for r in some} == {i: direct(tokenizer, t) for i, t in rows if i in (7, 1003)}

    files = [f for f in (tmp_path / "files").glob("*.txt") if f.stat().st_size]
    assert len(files) > 3
    for f in files:
        content = f.read_bytes()
        file = TokenFile(content)
        # any reader of zstandard passes over the seek table
        with zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True) as reader:
            assert reader.read()[: 4 * file.n_ids] == b"".join(file.frame(k) for k in range(len(file.table) - 1))


def test_only_the_frames_asked_for_are_decompressed_and_damage_is_found(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/files"
    write_token_files(docs_of(spark, [(i, f"text {i} " * 60) for i in range(40)]), path, PATH, frame_ids=200)
    content = bytearray(max((tmp_path / "files").glob("*.txt"), key=lambda f: f.stat().st_size).read_bytes())
    file, read = TokenFile(bytes(content)), []
    plain = TokenFile.frame
    monkeypatch.setattr(TokenFile, "frame", lambda self, k: read.append(k) or plain(self, k))
    list(file.read([0]))
    assert len(file.table) > 5 and {*read} == {0, len(file.table) - 1}
    content[file.begin[2] + 9] ^= 0x55
    with pytest.raises(Exception):
        TokenFile(bytes(content)).frame(2)
    with pytest.raises(ValueError, match="mark"):
        TokenFile(bytes(content[:-1]))


def test_no_documents_no_files(spark, tmp_path):
    write_token_files(docs_of(spark, []), f"{tmp_path}/f", PATH)
    assert read_token_files(spark, f"{tmp_path}/f", T.LongType()).count() == 0
