import random
from datetime import datetime, timedelta

import pytest

from accrue.operators import asof_join, measure, to_intervals
from conftest import fact

T0 = datetime(2024, 1, 1)


def at(second):
    return T0 + timedelta(seconds=second)


def plain_facts(spark, rows):
    return spark.createDataFrame([(i, k, at(s)) for i, (k, s) in enumerate(rows)], "id int, cuit string, created_at timestamp_ntz")


def valid_version(log, cuit, moment):
    """Brute force: the last change at or before the moment."""
    past = [c for c in log if c[0] == cuit and c[4] <= moment]
    if not past:
        return None
    last = max(past, key=lambda c: (c[4], c[5]))
    return None if last[3] == "d" else last


def check(df, facts, log):
    found = {r.id: (r.name, r.establishment, r.version_from) for r in df.collect()}
    assert len(found) == len(facts)
    for i, (cuit, second) in enumerate(facts):
        v = valid_version(log, cuit, at(second))
        assert found[i] == ((None, None, None) if v is None else (v[1], v[2], v[4])), (i, cuit, second)


LOG = [
    ("a", "A1", "1", "r", at(10), 1),
    ("a", "A2", "2", "u", at(20), 2),
    ("a", "A3", "3", "u", at(20), 3),  # same time: the later change holds
    ("a", None, None, "d", at(30), 4),
    ("a", "A5", "5", "c", at(40), 5),  # inserted again
    ("b", "B1", "6", "r", at(15), 6),
]
FACTS = [(k, s) for k in ("a", "b", "z") for s in (0, 9, 10, 19, 20, 29, 30, 39, 40, 99)]


@pytest.mark.parametrize("strategy", ["auto", "interval", "union"])
def test_every_moment_of_a_small_history(spark, log_of, strategy):
    joined = asof_join(plain_facts(spark, FACTS), log_of(*LOG), ["cuit"], ["name", "establishment"], strategy=strategy)
    assert joined.columns == ["id", "cuit", "created_at", "name", "establishment", "version_from"]
    check(joined, FACTS, LOG)


def test_empty_log_and_null_key(spark, log_of):
    facts = spark.createDataFrame([(0, None, at(5)), (1, "a", at(5))], "id int, cuit string, created_at timestamp_ntz")
    for strategy in ("interval", "union"):
        rows = asof_join(facts, log_of(), ["cuit"], ["name"], strategy=strategy).collect()
        assert sorted((r.id, r.name) for r in rows) == [(0, None), (1, None)]


@pytest.mark.parametrize("slice_rows", [3, 25, 10_000])
def test_hot_keys_are_cut_without_changing_the_result(spark, log_of, slice_rows):
    rng = random.Random(slice_rows)
    keys = ["hot"] * 6 + ["warm"] * 2 + ["c1", "c2", "c3"]
    log = []
    for seq in range(300):
        op = "d" if rng.random() < 0.15 else "u"
        name = None if op == "d" else f"n{seq}"
        log.append((rng.choice(keys), name, name, op, at(rng.randrange(400)), seq))
    facts = [(rng.choice(keys + ["none"]), rng.randrange(-20, 420)) for _ in range(600)]
    log_df, facts_df = log_of(*log), plain_facts(spark, facts)
    for strategy in ("interval", "union"):
        joined = asof_join(
            facts_df, log_df, ["cuit"], ["name", "establishment"], strategy=strategy, slice_rows=slice_rows, versions_per_key=300
        )
        check(joined, facts, log)


def test_a_hot_key_with_versions_only_at_the_start(spark, log_of):
    """Slices without a version of their own take it from a slice far before them."""
    log = [("hot", "N", "1", "r", at(1), 1)]
    facts = [("hot", s) for s in range(400)]
    joined = asof_join(plain_facts(spark, facts), log_of(*log), ["cuit"], ["name", "establishment"], strategy="union", slice_rows=10)
    assert "_slice" in joined._jdf.queryExecution().toString()
    check(joined, facts, log)


def test_the_broadcast_is_bounded(spark, log_of):
    log, facts = log_of(*LOG), plain_facts(spark, FACTS)
    size = measure(log, ["cuit"], ["name", "establishment"])
    assert size.largest == 5 and size.bytes > 0

    def plan(**options):
        joined = asof_join(facts, log, ["cuit"], ["name", "establishment"], **options)
        check(joined, FACTS, LOG)
        return joined._jdf.queryExecution().toString()

    assert "ResolvedHint (strategy=broadcast)" in plan() or "BroadcastHashJoin" in plan()
    # too many bytes, or too many versions of one key: no broadcast
    assert "BroadcastHashJoin" not in plan(broadcast_bytes=10) and "Union" in plan(broadcast_bytes=10)
    assert "Union" in plan(versions_per_key=4)


def test_interval_refuses_a_log_it_cannot_broadcast(spark, log_of):
    for limit in ({"broadcast_bytes": 10}, {"versions_per_key": 4}):
        with pytest.raises(ValueError, match="does not fit"):
            asof_join(plain_facts(spark, FACTS), log_of(*LOG), ["cuit"], [], strategy="interval", **limit)


@pytest.mark.parametrize("limit", [{"broadcast_bytes": 10}, {"broadcast_bytes": 10, "versions_per_key": 4}, {"versions_per_key": 4}])
def test_intervals_of_a_log_too_large_to_broadcast_are_joined_through_the_shuffle(spark, log_of, limit):
    facts = [*FACTS, (None, 50)]
    joined = asof_join(plain_facts(spark, facts), log_of(*LOG), ["cuit"], ["name", "establishment"], strategy="interval", shuffle=True, **limit)
    assert ("Union" in joined._jdf.queryExecution().toString()) == ("versions_per_key" in limit)
    check(joined, facts, LOG)


@pytest.mark.parametrize("strategy", ["interval", "union"])
def test_facts_without_key_or_time_find_nothing(spark, log_of, strategy):
    facts = spark.createDataFrame([(0, None, at(50)), (1, "a", None), (2, "a", at(50)), (3, None, None)], "id int, cuit string, created_at timestamp_ntz")
    rows = asof_join(facts, log_of(*LOG), ["cuit"], ["name"], strategy=strategy).collect()
    assert sorted((r.id, r.name) for r in rows) == [(0, None), (1, None), (2, "A5"), (3, None)]


@pytest.mark.parametrize("strategy", ["interval", "union"])
@pytest.mark.parametrize("change", [(None, "N", "1", "u", at(5), 9), ("a", "N", "1", "u", None, 9), ("a", "N", "1", "u", at(5), None)])
def test_changes_without_a_place_in_history_raise(spark, log_of, strategy, change):
    with pytest.raises(Exception, match="a change without"):
        asof_join(plain_facts(spark, FACTS), log_of(*LOG, change), ["cuit"], ["name"], strategy=strategy).collect()


def test_facts_of_one_instant_fall_into_several_slices(spark, log_of):
    log, facts = [("hot", "N", "1", "r", at(1), 1)], [("hot", 7)] * 1000
    joined = asof_join(plain_facts(spark, facts), log_of(*log), ["cuit"], ["name", "establishment"], strategy="union", slice_rows=100)
    check(joined, facts, log)
    from accrue.operators.slices import find_cuts
    from pyspark.sql import functions as F

    rows = plain_facts(spark, facts).select("cuit", F.col("created_at").alias("_t"), F.lit(1).alias("_side"), F.xxhash64("id", "cuit", "created_at").alias("_seq"))
    cuts = find_cuts(rows, ["cuit"], ["_t", "_side", "_seq"], 100)
    assert cuts.apply(rows).groupBy("_slice").count().count() > 3


def test_unknown_strategy(spark, log_of):
    with pytest.raises(ValueError):
        asof_join(plain_facts(spark, FACTS), log_of(*LOG), ["cuit"], [], strategy="nested")


@pytest.mark.parametrize("slice_rows", [2, 7, 10_000])
def test_intervals(spark, log_of, slice_rows):
    rng = random.Random(9)
    log = LOG + [("hot", f"h{i}", str(i), "u", at(rng.randrange(60)), 100 + i) for i in range(80)]
    found = {
        (r.cuit, r.name, r.establishment, r.valid_from, r.valid_to)
        for r in to_intervals(log_of(*log), ["cuit"], ["name", "establishment"], slice_rows=slice_rows).collect()
    }
    expected = set()
    for cuit in {c[0] for c in log}:
        changes = sorted((c for c in log if c[0] == cuit), key=lambda c: (c[4], c[5]))
        for change, following in zip(changes, [*changes[1:], None]):
            end = following[4] if following else None
            if change[3] != "d" and end != change[4]:
                expected.add((cuit, change[1], change[2], change[4], end))
    assert found == expected


def test_facts_keep_their_columns(facts_of, log_of):
    facts = facts_of(fact(1, "a", "RET_IVA", "3.50", "10.00", "0.35", at(25)))
    row = asof_join(facts, log_of(*LOG), ["cuit"], ["name"], strategy="union").first()
    assert (row.id, row.transaction_id, row.name) == (1, "tx-1", "A3")
