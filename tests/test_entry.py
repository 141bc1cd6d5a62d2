"""The driver contract: every query next to its SQL on the smallest sample."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import __spark_entry__ as contract  # noqa: E402
from accrue.plans.oracle import ORACLE  # noqa: E402
from accrue.plans.queries import QUERIES  # noqa: E402

SF = Path(os.environ.get("SAMPLE_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no sample tables")
STREAMS = {name for name in QUERIES if name.startswith("stream_")} | {"restart_from_scratch", "replay_idempotent"}
OWN = {name: query for name, query in contract.queries().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(OWN) == set(ORACLE) == set(contract.oracle_sql()) & set(OWN)


def test_entry(spark):
    assert contract.entry(spark).count() == 557


# one stream is enough here: the others differ in what tests/test_stream.py covers
@pytest.mark.parametrize("name", [q for q in OWN if q not in STREAMS - {"replay_idempotent", "stream_midnight", "stream_late_changes", "stream_idle_inputs", "stream_state"}])
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, str(SF))
    found = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(map(repr, found.fetchall()))
    assert sorted(repr(tuple(row)) for row in df.select(*columns).collect()) == expected


def test_known_counts(spark):
    from accrue.operators import asof_join, to_intervals
    from accrue.plans import on_time_facts
    from accrue.sources import sample

    facts, log = sample.facts(spark, str(SF)), sample.changelog(spark, str(SF))
    kept = on_time_facts(facts, sample.MODEL, sample.DELAY_SECONDS)
    joined = asof_join(kept, log, ["cuit"], ["name"]).where("name IS NOT NULL")
    assert (facts.count(), log.count(), to_intervals(log, ["cuit"], ["name"]).count()) == (1000, 225, 182)
    assert (kept.count(), joined.count(), joined.where("name LIKE '% III'").count()) == (596, 509, 74)


def test_the_rest_works_without_the_training_data_operators(tmp_path):
    """A copy without the subpackage, with and without the pipeline's file, still imports and has the library's own queries."""
    import shutil
    import subprocess

    shutil.copytree(ROOT / "accrue", tmp_path / "accrue", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    told = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    for extra in ([], ["corpus_pipeline.py"]):
        for name in extra:
            if (ROOT / name).exists():
                shutil.copy(ROOT / name, tmp_path)
        done = subprocess.run([sys.executable, "-c", told], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
        assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLE))], done.stderr
