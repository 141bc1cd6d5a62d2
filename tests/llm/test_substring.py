import random

import pytest
from cases import LONG, ODD, docs_of, words

from accrue.llm.substring import remove_repeats


def expected(rows, size):
    least = {}
    for row in rows:
        w = words(row[1])
        if row[0] is not None:
            for k in range(len(w) - size + 1):
                key = tuple(w[k : k + size])
                least[key] = min(row[0], least.get(key, row[0]))
    out = []
    for row in rows:
        w, gone = words(row[1]), set()
        if row[0] is not None:
            for k in range(len(w) - size + 1):
                if least[tuple(w[k : k + size])] < row[0]:
                    gone |= {*range(k, k + size)}
        out.append((row[0], row[1], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [1, 2, 5, 50])
def test_equals_brute_force(spark, size):
    rng = random.Random(size)
    passage = [f"p{i}" for i in range(size + 13)]
    rows = ODD[:7] + ODD[9:10] + ODD[11:]
    for i in range(150):
        w = [rng.choice("abcdefgh") for _ in range(rng.randrange(4 * size))]
        at = rng.randrange(len(w) + 1)
        if i % 3 == 0:
            w[at:at] = passage[rng.randrange(5) : len(passage) - rng.randrange(5)]
        rows.append((100 + rng.randrange(10_000) * 2 + i % 2, " ".join(w)))
    rows = [(i if i is None else i, t) for i, t in dict.fromkeys(rows)] + ODD[-6:-4]
    got = remove_repeats(docs_of(spark, rows), size=size)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows, size)


def test_long_copies_and_carried_columns(spark):
    rows = [(8, LONG), (9, LONG), (10, LONG + " tail"), (11, "x " + LONG)]
    got = sorted(remove_repeats(docs_of(spark, rows), carry=["kept", "runs"]).collect())
    n = len(words(LONG))
    assert [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got] == [(8, n, 0, LONG), (9, n, n, ""), (10, n + 1, n, "tail"), (11, n + 1, n, "x")]
    assert tuple(got[0].carried) == ("x", "x")


def test_rows_of_one_id_are_cut_each_by_itself(spark):
    a, c = (" ".join(f"{x}{i}" for i in range(120)) for x in "ac")
    rows = [(1, a), (2, a), (2, c), (3, c + " " + a), (3, a)]
    assert sorted(map(tuple, remove_repeats(docs_of(spark, rows)).collect()), key=repr) == expected(rows, 50)


@pytest.mark.parametrize("hot", [1, 10**6])
def test_hot_runs_are_met_either_way(spark, monkeypatch, hot):
    monkeypatch.setattr("accrue.llm.substring.HOT_HELD", hot)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"own{i} {passage} end{i}") for i in range(40)] + [(100, passage), (101, " ".join(passage.split()[3:] + ["x"]))]
    assert sorted(map(tuple, remove_repeats(docs_of(spark, rows)).collect()), key=repr) == expected(rows, 50)


def test_no_documents(spark):
    assert remove_repeats(docs_of(spark, [])).count() == 0
    assert [tuple(r) for r in remove_repeats(docs_of(spark, [(1, None)])).collect()] == [(1, None, 0, 0, "")]
