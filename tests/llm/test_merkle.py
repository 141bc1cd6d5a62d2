import hashlib
import random
from zlib import crc32

import pytest
from cases import ODD, docs_of, low
from pyspark.sql import functions as F

from accrue.llm.merkle import document_manifest, folded, siblings


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)])


def climb(hashes):
    """The top of a tree and of each leaf its sibling runs, from the leaves up, as (before, behind)."""
    paths, of, level = [[] for _ in hashes], [[i] for i in range(len(hashes))], list(hashes)
    while len(level) > 1:
        runs = [range(k, min(k + 8, len(level))) for k in range(0, len(level), 8)]
        for run in runs:
            for i in run:
                for leaf in of[i]:
                    paths[leaf].append(("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i)))
        level, of = [sha(*[level[i] for i in run]) for run in runs], [[x for i in run for x in of[i]] for run in runs]
    return level[0], paths


def expected(rows, tampered):
    """Rows of (doc_id, text, lang, source, n_chars)."""
    null_first = lambda v: (v is not None, v if v is not None else 0)
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    langs = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    built = {}
    for lang in langs:
        trees[lang].sort(key=lambda r: (null_first(r[0]), leaf(r, r[1])))
        built[lang] = climb([leaf(r, r[1]) for r in trees[lang]])
    root, above = climb([built[lang][0] for lang in langs])
    out = []
    for lang, upper in zip(langs, above, strict=True):
        subroot, paths = built[lang]
        for row, path in zip(trees[lang], paths, strict=True):
            own = leaf(row, row[1])
            top = leaf(row, None if row[1] is None else low(row[1])) if tampered(row[0]) else own
            for before, behind in path + upper:
                top = sha(before, top, behind)
            out.append((row[0], own, subroot, root, sha(*[b + a for b, a in path + upper]), top, top == root))
    return sorted(out, key=repr)


def third(i):
    return i is not None and crc32(str(i).encode()) % 3 == 0


def made(docs):
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    rows = document_manifest(docs, tampered=tampered)
    return sorted(map(tuple, rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256), "folded_root", "verified").collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1, 2], [64, 65, 7, 3, 1, 1, 1, 1, 1], [513, 2], [1300]])
def test_trees_of_many_shapes(spark, sizes):
    rng = random.Random(len(sizes))
    rows = [(rng.randrange(5000), f"Text {i}", None if k == 1 else f"l{k}", "s", i) for k, n in enumerate(sizes) for i in range(n)]
    rng.shuffle(rows)
    assert made(frame(spark, rows).repartition(3)) == expected(rows, third)


def test_odd_rows_with_nulls_in_every_column(spark):
    rows = [(r[0], r[1], ["en", None, "", "größe", "zz"][i % 5], [None, "S", "é"][i % 3], [None, 7][i % 2]) for i, r in enumerate(ODD)]
    rows += [(12, "Same", None, None, None)] * 20  # more copies than a run holds
    assert made(frame(spark, rows).repartition(4)) == expected(rows, third)


def test_a_key_with_nearly_all_rows_and_one_id(spark):
    rows = [(7, f"Copy {i % 3}", "hot", "s", 1) for i in range(700)] + [(i, "T", f"k{i}", "s", 1) for i in range(40)]
    assert made(frame(spark, rows)) == expected(rows, third)


def test_clashing_columns_and_an_empty_table(spark):
    rows = made(docs_of(spark, ODD))
    assert len(rows) == len(ODD) and len({r[3] for r in rows}) == 1
    assert made(docs_of(spark, [])) == []


def test_a_wrong_leaf_or_path_does_not_verify(spark):
    rows = document_manifest(frame(spark, [(i, f"text {i}", "en", "s", 1) for i in range(70)]))
    assert rows.where("NOT verified").count() == 0
    swapped = F.transform("path", lambda step: F.struct(step.after.alias("before"), step.before.alias("after")))
    wrong = rows.select(folded(F.sha2(F.col("leaf"), 256), F.col("path")).alias("a"), folded(F.col("leaf"), swapped).alias("b"), "root")
    assert wrong.where("a = root OR b = root").count() == 0
