import hashlib
import random
import re

import pytest
import xxhash
from cases import LONG, ODD, docs_of
from pyspark.sql import functions as F

from accrue.llm.simhash import edited_fingerprints, simhash, within_radius

TERMS = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def fingerprint(text):
    """Brute force."""
    votes = [0] * 64
    for term in TERMS.split((text or "").lower()):
        h = xxhash.xxh64(term.encode(), seed=42).intdigest()
        for bit in range(64):
            votes[bit] += min(len(term), 16) * (1 if h >> bit & 1 else -1)
    return sum(1 << bit for bit in range(64) if votes[bit] > 0)


@pytest.mark.parametrize("bucket_bytes", [400, 1 << 20])
def test_edited_texts(spark, bucket_bytes):
    rng = random.Random(1)
    rows = [r for r in ODD if r[0] not in (8, 9)] + [(20 + 3 * i, " ".join(rng.choice(["alpha", "Beta", "é", "of"]) for _ in range(rng.randrange(60)))) for i in range(60)]
    got = edited_fingerprints(docs_of(spark, rows), bucket_bytes=bucket_bytes, probe=F.col("doc_id") % 20 == 0).collect()
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    prints = [fingerprint(t) for _, t in ordered]
    truth = []
    for k, (i, text) in enumerate(ordered):
        following = (k + 1) % len(ordered)
        half = len(text) // 2
        edited = text[: len(text) - half] + ordered[following][1][:half]
        changed = fingerprint(edited)
        near = sum((changed ^ p).bit_count() <= 3 for p in prints)
        shares = [1 - (prints[k] ^ p).bit_count() / 64 for p in (changed, prints[following])]
        own = sum((prints[k] ^ p).bit_count() <= 3 for p in prints) if i is not None and i % 20 == 0 else None
        truth.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{prints[k]:016x}", f"{changed:016x}", *shares, near, own))
    assert sorted(map(tuple, got), key=repr) == sorted(truth, key=repr)


@pytest.mark.parametrize("bucket_bytes", [60, 1 << 20])
def test_ids_that_are_texts(spark, bucket_bytes):
    rows = [(f"doc-{i:03d}é", f"words of number {i} and {i * i}") for i in range(40)] + [(None, "without"), ("", "empty"), ("doc-007é", "again")]
    got = edited_fingerprints(spark.createDataFrame(rows, "name string, body string"), "name", "body", bucket_bytes=bucket_bytes).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    truth = []
    for k, (name, text) in enumerate(ordered):
        half = len(text) // 2
        edited = text[: len(text) - half] + ordered[(k + 1) % len(ordered)][1][:half]
        truth.append((name, hashlib.sha256(edited.encode()).hexdigest(), sum((fingerprint(text) ^ fingerprint(t)).bit_count() <= 3 for _, t in rows)))
    assert sorted([(r.name, r.edited_sha256, r.near_own) for r in got], key=repr) == sorted(truth, key=repr)


def test_one_document_and_none(spark):
    one = edited_fingerprints(docs_of(spark, [(1, "abcdef")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1
    assert edited_fingerprints(docs_of(spark, [])).count() == 0


def test_long_texts_do_not_overflow(spark):
    got = simhash(spark.createDataFrame([(1, LONG * 3)], "k int, text string"), ["k"]).first().fingerprint
    assert got % (1 << 64) == fingerprint(LONG * 3)


@pytest.mark.parametrize("radius, blocks", [(0, 1), (1, 2), (3, 4), (3, 6)])
def test_the_tables_find_all_within_the_radius(spark, radius, blocks):
    rng = random.Random(radius)
    table = [rng.getrandbits(64) for _ in range(300)]
    queries = [x ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for x in table]
    signed = lambda xs: spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in xs] + [(None,)], "fingerprint long")
    got = {(r.query % (1 << 64), r.fingerprint % (1 << 64)) for r in within_radius(signed(queries), signed(table), radius, blocks).collect()}
    assert got == {(q, x) for q in queries for x in table if (q ^ x).bit_count() <= radius}


def test_no_python_on_the_main_path(spark):
    plan = edited_fingerprints(docs_of(spark, ODD).select(F.col("doc_id"), "text"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
