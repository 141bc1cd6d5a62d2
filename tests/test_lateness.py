import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from accrue.operators import drop_late, mark_late, watermark
from conftest import utc

T0 = datetime(2024, 1, 1)


def build(spark, rows):
    """rows: (arrival second, id, event second or None)"""
    typed = [(a, i, None if e is None else T0 + timedelta(seconds=e)) for a, i, e in rows]
    return spark.createDataFrame(typed, "arr bigint, id bigint, t timestamp_ntz")


def brute_force(rows, delay, seen=None):
    newest, late = seen, set()
    for _, id, event in sorted(rows, key=lambda r: r[:2]):
        newest = max((x for x in (newest, event) if x is not None), default=None)
        if event is None or event < newest - delay:
            late.add(id)
    return late


def late_ids(df):
    return {r.id for r in df.where("_late").collect()}


def test_exactly_at_the_bound_is_on_time(spark):
    rows = [(0, 0, 100), (1, 1, 95), (2, 2, 94), (3, 3, 200), (4, 4, 195), (5, 5, 194)]
    kept, late = drop_late(build(spark, rows), "t", ["arr", "id"], 5)
    assert {r.id for r in kept.collect()} == {0, 1, 3, 4}
    assert {r.id for r in late.collect()} == {2, 5}
    assert kept.columns == ["arr", "id", "t"]


def test_the_newest_event_before_the_first_row_counts(spark):
    rows = [(0, 0, 94), (1, 1, 95), (2, 2, 300)]
    marked = mark_late(build(spark, rows), "t", ["arr", "id"], 5, seen=T0 + timedelta(seconds=100))
    assert late_ids(marked) == {0}


def test_no_rows_and_no_event_time(spark):
    assert mark_late(build(spark, []), "t", ["arr", "id"], 5).collect() == []
    assert late_ids(mark_late(build(spark, [(0, 0, None), (1, 1, 5)]), "t", ["arr", "id"], 5)) == {0}


def test_ordered_arrival_needs_no_shuffle(spark):
    rows = [(i, i, i) for i in range(200)]
    marked = mark_late(build(spark, rows), "t", ["arr", "id"], 5, bucket_rows=2)
    assert late_ids(marked) == set()
    assert "Window" not in marked._jdf.queryExecution().toString()


def test_the_order_is_never_one_partition(spark):
    rng = random.Random(1)
    rows = [(i, i, i - rng.randrange(40)) for i in range(20_000)]
    marked = mark_late(build(spark, rows), "t", ["arr", "id"], 5)
    plan = marked._jdf.queryExecution().toString()
    assert "Window" in plan and "SinglePartition" not in plan
    assert late_ids(marked) == brute_force(rows, 5)


def test_only_ranges_that_may_hold_a_late_row_are_ordered(spark):
    rows = [(i, i, i) for i in range(4_000)] + [(100, 5_000, 96)]
    marked = mark_late(build(spark, rows), "t", ["arr", "id"], 5, bucket_rows=2)
    assert late_ids(marked) == set()
    marked = mark_late(build(spark, rows + [(3_000, 5_001, 1)]), "t", ["arr", "id"], 5, bucket_rows=2)
    assert late_ids(marked) == {5_001}
    assert "Union" in marked._jdf.queryExecution().toString()


@pytest.mark.parametrize("column", ["arr", "arr_t", "arr_date", "arr_dec"])
def test_arrival_may_have_any_ordered_type(spark, column):
    rng = random.Random(2)
    rows = [(i // 3, i, i - rng.randrange(30)) for i in range(300)]
    df = build(spark, rows).selectExpr(
        "*", "timestamp_seconds(arr) AS arr_t", "date_add(DATE '2024-01-01', CAST(arr AS INT)) AS arr_date",
        "CAST(arr AS DECIMAL(20,3)) / 7 AS arr_dec",
    )
    assert late_ids(mark_late(df, "t", [column, "id"], 5, slice_rows=20)) == brute_force(rows, 5)


def test_one_arrival_second_may_hold_most_rows(spark):
    rng = random.Random(3)
    rows = [(500 if i % 3 else i, i, 1000 + i // 10 - rng.randrange(60)) for i in range(3000)]
    marked = mark_late(build(spark, rows), "t", ["arr", "id"], 20, slice_rows=100)
    assert late_ids(marked) == brute_force(rows, 20)
    assert "_slice" in marked._jdf.queryExecution().toString()


def test_watermark(spark):
    assert watermark(build(spark, [(0, 0, 100), (1, 1, 7)]), "t", 5) == T0 + timedelta(seconds=95)
    assert watermark(build(spark, []), "t", 5) is None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    events=st.lists(st.tuples(st.integers(0, 30), st.one_of(st.none(), st.integers(0, 60))), max_size=60),
    delay=st.integers(0, 20),
    buckets=st.sampled_from([1, 3, 100]),
    slice_rows=st.sampled_from([2, 5, 1000]),
    seen=st.one_of(st.none(), st.integers(0, 60)),
)
def test_equals_the_row_by_row_rule(spark, events, delay, buckets, slice_rows, seen):
    rows = [(a, i, e) for i, (a, e) in enumerate(events)]
    start = None if seen is None else T0 + timedelta(seconds=seen)
    marked = mark_late(
        build(spark, rows), "t", ["arr", "id"], delay, start, max_buckets=buckets, bucket_rows=1, slice_rows=slice_rows
    )
    assert late_ids(marked) == brute_force(rows, delay, seen)


def test_any_split_into_batches_gives_the_same_rows(spark):
    rng = random.Random(5)
    rows = [(i, i, i * 2 - rng.randrange(50)) for i in range(200)]
    for cut in ([1, 100], [50, 51, 199], []):
        bounds, seen, late = [0, *cut, 200], None, set()
        for a, b in zip(bounds, bounds[1:]):
            part = rows[a:b]
            df = build(spark, part)
            late |= late_ids(mark_late(df, "t", ["arr", "id"], 10, seen))
            newest = watermark(df, "t", 0)
            seen = newest if seen is None else max(seen, newest)
        assert late == brute_force(rows, 10)
    assert utc("2024-01-01") == T0


def test_rows_of_an_unknown_arrival_range_raise(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = [(i, i, i - (40 if i % 7 == 0 else 0)) for i in range(4000)]
    folder = str(tmp_path / "rows")
    build(spark, rows).coalesce(1).write.parquet(folder)
    marked = mark_late(spark.read.parquet(folder), "t", ["arr", "id"], 5, bucket_rows=100)
    moved = build(spark, rows).withColumn("arr", F.col("arr") + 1_000_000)
    marked.count()
    name = next(p.name for p in (tmp_path / "rows").glob("*.parquet"))
    moved.coalesce(1).write.parquet(str(tmp_path / "moved"))
    new = next((tmp_path / "moved").glob("*.parquet"))
    (tmp_path / "rows" / f".{name}.crc").unlink()
    (tmp_path / "rows" / name).write_bytes(new.read_bytes())
    with pytest.raises(Exception, match="input changed"):
        marked.collect()
