import json
from datetime import datetime

import pytest

from accrue.operators import apply_changes, asof_join, latest_per_key, upsert
from accrue.sources import decode_changes, encode_changes, merge_snapshot_and_log, read_change_records, stamp_snapshot
from accrue.sources.schemas import MERCHANT
from conftest import utc


def merchant(cuit, name=None, establishment=None):
    return {"cuit": cuit, "name": name, "establishment": establishment}


def record(op, before, after, ts_ms, lsn):
    return json.dumps({"op": op, "before": before, "after": after, "source": {"ts_ms": ts_ms, "lsn": lsn}})


RECORDS = [
    record("c", None, merchant("1", "N", "10"), 1704067200123, 5),
    record("u", merchant("1", "N", "10"), merchant("1", "M", "11"), 1704067201000, 6),
    record("d", merchant("1", "M", "11"), None, 1704067202000, 7),
    record("r", None, merchant("2", "R", "20"), 1704067200000, 1),
]


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_decode(spark):
    rows = {r.seq: r for r in decode_changes(texts(spark, *RECORDS), MERCHANT, ["cuit"]).collect()}
    assert tuple(rows[5]) == ("1", "N", "10", "c", utc("2024-01-01 00:00:00.123"), 5)
    assert tuple(rows[6])[:4] == ("1", "M", "11", "u")
    # a delete keeps the key of its before image
    assert tuple(rows[7]) == ("1", None, None, "d", utc("2024-01-01 00:00:02"), 7)
    assert rows[1].op == "r"


@pytest.mark.parametrize(
    "value",
    [
        "{not json",
        record("d", None, None, 1, 1),
        record("u", None, merchant("1", "N", "10"), 1, 1),  # no before image
        record("c", None, None, 1, 1),
        record("x", None, merchant("1"), 1, 1),
        record(None, None, merchant("1"), 1, 1),
        record("c", None, merchant(None, "N", "1"), 1, 1),
        record("c", None, merchant("1", "N", "1"), None, 1),
        record("c", None, merchant("1", "N", "1"), 1, None),
    ],
)
def test_a_broken_record_is_not_skipped(spark, value):
    with pytest.raises(Exception, match="incomplete change record|MALFORMED"):
        decode_changes(texts(spark, value), MERCHANT, ["cuit"]).collect()
    if value.startswith("{not"):
        return
    for column in ("cuit", "name", "op_ts"):
        with pytest.raises(Exception, match="incomplete change record"):
            decode_changes(texts(spark, value), MERCHANT, ["cuit"]).select(column).collect()


def test_files_of_records_round_trip(spark, tmp_path, log_of):
    log = log_of(
        ("1", "N", "10", "c", "2024-01-01 00:00:00.123", 1),
        ("1", "M", "11", "u", "2024-01-02 00:00:00", 2),
        ("1", None, None, "d", "2024-01-03 00:00:00", 3),
    )
    encode_changes(log, MERCHANT, ["cuit"]).write.text(str(tmp_path / "records"))
    read = read_change_records(spark, str(tmp_path / "records"))
    assert set(map(tuple, read.select(*log.columns).collect())) == set(map(tuple, log.collect()))


def test_snapshot_versions_begin_at_the_read(spark):
    merchants = spark.createDataFrame([("1", "N", "10")], MERCHANT)
    stamped = stamp_snapshot(merchants, datetime(2024, 1, 2))
    facts = spark.sql("SELECT id, '1' AS cuit, TIMESTAMP_NTZ '2024-01-01 12:00:00' + INTERVAL '1' DAY * id AS created_at FROM range(2)")
    rows = asof_join(facts, stamped, ["cuit"], ["name"]).collect()
    assert {r.id: r.name for r in rows} == {0: None, 1: "N"}


def test_snapshot_and_log_hand_over(spark):
    snapshot = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    log = spark.createDataFrame([(3, "c"), (4, "d"), (4, "d")], "id int, v string")
    merged = merge_snapshot_and_log(snapshot, log, ["id"])
    assert sorted(map(tuple, merged.collect())) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_upsert_and_delete(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "k string, v int")
    delta = spark.createDataFrame([("b", 2, 1), ("b", 3, 2), ("d", 4, 1)], "k string, v int, n int")
    assert sorted(map(tuple, upsert(target, delta, ["k"], ["n"]).collect())) == [("a", 1), ("b", 3), ("c", 1), ("d", 4)]
    changes = spark.createDataFrame(
        [("a", None, "d", 1), ("b", 5, "u", 1), ("b", None, "d", 2), ("c", None, "d", 1), ("c", 9, "c", 2)],
        "k string, v int, op string, n int",
    )
    assert sorted(map(tuple, apply_changes(target, changes, ["k"], ["n"]).collect())) == [("c", 9)]


def test_the_last_row_is_taken_whole(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, None)], "k string, n int, v string")
    assert [tuple(r) for r in latest_per_key(rows, ["k"], ["n"]).collect()] == [("a", 3, None)]


def test_keyed_changes_take_null_keys_as_equal(spark):
    target = spark.createDataFrame([(None, 1), ("a", 1), ("b", 1)], "k string, v int")
    delta = spark.createDataFrame([(None, 2, 1), ("a", 2, 1), ("a", 3, 2), ("c", 2, 1)], "k string, v int, seq int")
    found = upsert(target, delta, ["k"], ["seq"]).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(None, 2), ("a", 3), ("b", 1), ("c", 2)], key=repr)
    changes = spark.createDataFrame([(None, None, "d", 1), ("b", 5, "u", 1), ("b", None, "d", 2), ("d", 9, "c", 3)], "k string, v int, op string, seq int")
    found = apply_changes(target, changes, ["k"], ["seq"]).collect()
    assert sorted(map(tuple, found)) == [("a", 1), ("d", 9)]
