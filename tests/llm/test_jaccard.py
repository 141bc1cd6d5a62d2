import random

import numpy as np
import pytest
from cases import ODD, docs_of, words

from accrue.llm.components import components
from accrue.llm.jaccard import _possible, _prefixes, _shingles, _sieved, _verified, similar_groups


def shingles(text, size):
    w = words(text, lower=True)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def expected(rows, size, percent):
    """Rows of one id are one node; rows without id have no component."""
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = [(i, s) for i, s in sets if i is not None and s]
    for k, (i, a) in enumerate(held):
        for j, b in held[:k]:
            if 100 * len(a & b) >= percent * len(a | b):
                a_root, b_root = root(i), root(j)
                parent[max(a_root, b_root)] = min(a_root, b_root)
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=repr)


def edited(rng, base, n):
    out = list(base)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("size, percent, longest", [(3, 90, 4), (3, 90, 1), (5, 80, 4), (1, 60, 3), (2, 100, 2)])
def test_equals_brute_force(spark, size, percent, longest):
    rng = random.Random(size * percent)
    rows = [r for r in ODD if r[0] not in (8, 9)]
    for g in range(12):
        base = [f"g{g}w{rng.randrange(60)}" for _ in range(rng.randrange(4, 90))]
        rows += [(1000 * g + 50 + rng.randrange(900), edited(rng, base, rng.randrange(4)).upper() if k % 5 == 0 else edited(rng, base, rng.randrange(4))) for k in range(14)]
    rows = list({(r[0], k if r[0] is None else 0): r for k, r in enumerate(rows)}.values()) + [ODD[11]]
    got = similar_groups(docs_of(spark, rows), size=size, percent=percent, longest=longest)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows, size, percent)


def test_a_large_group_of_near_copies_and_a_common_line(spark):
    rng = random.Random(4)
    base, line = [f"b{i}" for i in range(80)], " ".join(f"l{i}" for i in range(12))
    rows = [(i, edited(rng, base, i % 6) + " " + line) for i in range(400)]
    rows += [(1000 + i, " ".join(f"r{rng.randrange(10**6)}" for _ in range(30)) + " " + line) for i in range(300)]
    rows += [(5000 + i, line + " copied") for i in range(300)]
    got = similar_groups(docs_of(spark, rows), size=3, percent=90)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows, 3, 90)


def test_rows_of_one_id_are_one_node(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(3, a), (7, a), (7, b), (9, b), (20, None), (20, a), (30, "quite alone"), (30, "and another text of it")]
    got = similar_groups(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows, 5, 80)
    assert {r.component_id for r in got} == {3, 30}


def test_no_documents(spark):
    assert similar_groups(docs_of(spark, [])).count() == 0
    assert [tuple(r) for r in similar_groups(docs_of(spark, [(4, None)])).collect()] == [(4, 0, 4)]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    n = 120
    links = [(i, i + 1) for i in range(0, 40)] + [(60, i) for i in range(61, 90)] + [(rng.randrange(n), rng.randrange(n)) for _ in range(10 * seed)]
    rng.shuffle(links)
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links + links[:3], "a long, b long")).collect()
    assert {(r.node, r.component) for r in got} == {(x, root(x)) for link in links for x in link if link[0] != link[1]} and len(got) == len({r.node for r in got})


def test_ids_of_pairs_are_sieved(spark):
    rows = spark.range(20_000).selectExpr("IF(id % 1000 = 7, NULL, id) AS id", "CAST(id AS STRING) AS text")
    ids = spark.createDataFrame([(5,), (11,), (19_999,)], "id long")
    kept = {r.id for r in _sieved(rows, ids).collect()}
    assert {5, 11, 19_999} <= kept and len(kept) < 10 and None not in kept
    assert _sieved(rows, ids.limit(0)).count() == 0


def test_sketches_as_long_as_the_sets_tell_long_texts_apart(spark):
    words = [f"w{i}" for i in range(3600)]
    texts = {1: words[:3000], 2: words[600:], 3: words[:2700] + words[3300:], 4: words[:2990]}
    rows = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "id long, text string")
    sets = rows.mapInArrow(lambda it: _shingles(it, 1), "id long, n long, sketch array<long>, grams array<long>")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (3, 4)], "a long, b long")
    # 1 and 2 share 2400 of 3600 words: 1024 bits can't tell, as they differ in more words than bits can show
    coarse = rows.mapInArrow(lambda it: _prefixes(it, 1, 80, 4, (np.zeros(0, np.uint64), np.zeros(0, np.uint64))), "id long, n long, s1 long, s2 long, b1 long, b2 long, b3 long, b4 long, sketch array<long>, prefix array<long>")
    assert {tuple(r) for r in _possible(pairs, coarse, 80).collect()} == {(1, 2), (1, 3), (1, 4), (3, 4)}
    assert {tuple(r) for r in _possible(pairs, sets, 80).collect()} == {(1, 3), (1, 4), (3, 4)}
    assert {tuple(r) for r in _verified(pairs, sets, 80).collect()} == {(1, 3), (1, 4), (3, 4)}


def test_sketches_of_different_lengths_are_folded(spark):
    # 1024 and 1050 n-grams have sketches of 64 and 128 numbers
    texts = {1: range(1024), 2: range(1050), 3: range(1000, 2050), 4: []}
    rows = spark.createDataFrame([(k, " ".join(f"w{i}" for i in v)) for k, v in texts.items()], "id long, text string")
    sets = rows.mapInArrow(lambda it: _shingles(it, 1), "id long, n long, sketch array<long>, grams array<long>")
    assert {r.id: len(r.sketch) for r in sets.collect()} == {1: 64, 2: 128, 3: 128, 4: 1}
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long")
    assert [tuple(r) for r in _possible(pairs, sets, 80).collect()] == [(1, 2)]
