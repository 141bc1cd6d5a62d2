"""The registered queries on the smallest sample, beside their SQL or the columns asked for, and the pipeline."""

import os
import re
from pathlib import Path

import duckdb
import pytest
from cases import ODD, docs_of, words
from test_decontaminate import PATTERN
from test_jaccard import expected as groups
from test_substring import expected as removed

import corpus_pipeline
from accrue.llm.oracle import LLM_ORACLE
from accrue.llm.queries import LLM_QUERIES

SF = Path(os.environ.get("SAMPLE_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no sample tables")
COLUMNS = {
    1: "doc_id n_words n_hit n_items items_sha256 contaminated",
    2: "page_id payload_bytes payload_digest record_type refers_to",
    3: "doc_id n_words n_removed kept_sha256",
    4: "doc_id held_out n_tokens n_known train_tokens base_score score",
    5: "doc_id piece start length ids_crc32 sequence_id offset",
    6: "doc_id start n_tokens ids_crc32",
    7: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    8: "doc_id n_shingles component_id",
    9: "doc_id held_out score predicted",
    10: "doc_id held_out lang_pred score",
    13: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_there_is_a_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in LLM_QUERIES) == [*range(1, 14)]
    assert {*LLM_ORACLE} <= {*LLM_QUERIES}


@pytest.mark.parametrize("name", [*LLM_ORACLE])
def test_query_equals_sql(spark, duck, name):
    df = LLM_QUERIES[name](spark, str(SF))
    found = duck.execute(LLM_ORACLE[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == sorted(map(repr, found.fetchall()))


@pytest.mark.parametrize("name", [n for n in LLM_QUERIES if n not in LLM_ORACLE])
def test_the_other_queries(spark, duck, name):
    df = LLM_QUERIES[name](spark, str(SF))
    columns = COLUMNS[int(re.match(r"op(\d+)_", name)[1])].split()
    assert df.columns[: len(columns)] == columns or {*columns} <= {*df.columns}
    rows = df.collect()
    ids = {r[0] for r in duck.execute("SELECT doc_id FROM documents").fetchall()}
    assert {r.doc_id for r in rows} == ids and (len(rows) == len(ids) or name.startswith(("op5", "op13")))
    truth = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    if name.startswith("op10"):
        assert sum(r.lang_pred == truth[r.doc_id] for r in rows if r.held_out) >= 0.97 * sum(r.held_out for r in rows)
    if name.startswith("op9"):
        labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
        apart = [r for r in rows if r.held_out and r.doc_id in labels]
        assert sum(r.predicted == labels[r.doc_id] for r in apart) >= 0.85 * len(apart)
    if name.startswith("op4"):
        assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def table(spark, rows, folder, name):
    docs_of(spark, rows).write.parquet(f"{folder}/{name}.parquet")


def test_pipeline_stage_by_stage(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(70))
    near = " ".join(f"near{i}" for i in range(100))
    rows = [r for r in ODD if r[0] not in (8, 9, 11)] + [
        (200, f"first {long} one"), (201, "second " + " ".join(f"other{i}" for i in range(40)) + f" {long} two"), (202, long), (203, "quite another text"),
        (300, near), (301, near.replace("near50", "changed")), (302, near + " more"), (303, near),
        (500, "mine " + near), (500, "the only text of its kind, under an id that another has"),
        (400, "It says: " + " ".join(f"Item{i}" for i in range(12)) + "!"), (401, "clean item0 item1 text"),
    ]
    table(spark, rows, tmp_path, "documents")
    spark.createDataFrame([(1, " ".join(f"item{i}" for i in range(30)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), [(r[0], r[1]) for r in rows]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, docs, str(tmp_path))
        assert df.columns == corpus_pipeline.COLUMNS and df.schema == docs.select(*corpus_pipeline.COLUMNS).schema
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        got = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
        if name == "language":
            kept = [r for r in kept if any(c.isalpha() for c in r[1] or "")]
        elif name == "near_duplicates":
            held = sorted({r for r in kept if r[0] is not None}, key=lambda r: (r[0], r[1] or ""))
            head = {k for k, _, c in groups([(k, text) for k, (_, text) in enumerate(held)], 5, 80) if k == c}
            kept = [*[held[k] for k in sorted(head)], *[r for r in kept if r[0] is None]]
        elif name == "substring_dedup":
            kept = [(i, text if not gone else left) for i, text, _, gone, left in removed(kept, 50) if not gone or left]
        else:
            phrase = [tuple(f"item{i}" for i in range(k, k + 10)) for k in range(21)]
            runs = lambda t: {tuple(words(t, PATTERN, True)[k : k + 10]) for k in range(len(t))}
            kept = [r for r in kept if not runs(r[1]) & {*phrase}]
        assert got == sorted(kept, key=repr), name
        assert all(r.n_chars == len(r.text) for r in docs.collect())
    ids = {i for i, _ in kept}
    assert {200, 201, 203, 300, 401, 500} <= ids and not {202, 301, 302, 303, 400} & ids
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == ids
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "substring_dedup", "decontamination", "packing"]


def test_pipeline_of_an_empty_table(spark, tmp_path):
    table(spark, [], tmp_path, "documents")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
