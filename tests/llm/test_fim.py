import hashlib

import pytest
from cases import ODD, docs_of
from pyspark.sql import functions as F

from accrue.llm.fim import fill_in_middle, restored, unit_count


def expected(doc_id, text, percent=90, spm=20):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return (doc_id, n, "plain", None, None, text)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return (doc_id, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}")


def seams():
    """Texts whose cuts may fall beside halves of sentinels, line ends and characters of several units."""
    parts = ["<", "<P", "P>", ">", "S>", "<S", "M>", "$1", "\\", "\n", "\r\n", "\U0001f600", "é", " ", "x"]
    return [(1000 + i, "".join(parts[(i * 7 + j * j) % len(parts)] for j in range(1 + i % 40))) for i in range(400)]


ROWS = [*ODD, *seams(), (20, "holds <P> itself"), (21, "<S>"), (22, "a<M>"), (23, "x" * 1024), (24, "y" * 1023), (25, "z" * 2049), (26, "\U0001f600" * 3000), (27, "l\n" * 150_000)]


def test_every_row_equals_plain_slicing(spark):
    made = fill_in_middle(docs_of(spark, ROWS))
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    rows = made.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:6] for r in rows), key=repr) == sorted((expected(*r[:2]) for r in ROWS), key=repr)
    assert sorted((r.doc_id, r.back) for r in rows if r.doc_id is not None) == sorted((r[0], r[1] or "") for r in ROWS if r[0] is not None)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("rates", [(0, 20), (100, 0), (100, 100)])
def test_rates_are_parameters(spark, rates):
    rows = fill_in_middle(docs_of(spark, ROWS), fim_percent=rates[0], spm_percent=rates[1]).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted((expected(*r[:2], *rates) for r in ROWS), key=repr)


def test_units_are_counted_in_strides(spark):
    texts = ["", "a", "ab", "abc", "\U0001f600" * 7, "a\nb\r\n" * 5, "é" * 4]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for stride in (1, 2, 3, 1024):
        assert [r[0] for r in df.select(unit_count(F.col("text"), stride)).collect()] == [len(t) for t in texts]


def test_it_is_a_projection_of_the_scan(spark, tmp_path):
    docs_of(spark, ODD).write.parquet(f"{tmp_path}/d")
    plan = fill_in_middle(spark.read.parquet(f"{tmp_path}/d"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_text_ids_and_an_empty_table(spark):
    rows = fill_in_middle(spark.createDataFrame([("k1", "some text")], "doc_id string, text string")).collect()
    assert tuple(rows[0]) == expected("k1", "some text")
    empty = fill_in_middle(docs_of(spark, []))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"
