import random

import pytest
from pyspark.sql import functions as F

from accrue.operators.keyed import latest_per_key
from accrue.sources.incremental import ChunkedSnapshot
from accrue.sources.schemas import CHANGES, MERCHANT
from conftest import utc

CHUNKS = 3
AT = utc("2024-01-01 00:00")


def moment(position):
    return position, AT.replace(minute=position // 60, second=position % 60)


def history(seed):
    """Changes of 12 keys at positions 1 to 120, as (cuit, name, establishment, op, op_ts, seq)."""
    draw, there, log = random.Random(seed), set(), []
    for seq in range(1, 121):
        key = draw.randrange(12)
        op = "c" if key not in there else draw.choice(["u", "u", "d"])
        (there.discard if op == "d" else there.add)(key)
        texts = (None, None) if op == "d" else (f"n{seq}", f"e{seq}")
        log.append((str(key), *texts, op, moment(seq)[1], seq))
    return log


def state(log, upto):
    now = {}
    for cuit, name, establishment, op, _, seq in log:
        if seq <= upto:
            now[cuit] = None if op == "d" else (name, establishment)
    return {k: v for k, v in now.items() if v is not None}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_reading_moments_give_the_table_at_the_end(spark, tmp_path, seed):
    draw, events = random.Random(seed), history(seed)
    log = spark.createDataFrame(events, CHANGES)
    chunk = F.col("cuit").cast("int") % CHUNKS
    for _ in range(2):  # taken up again by another object
        snapshot = ChunkedSnapshot(spark, str(tmp_path / "s"), MERCHANT, ["cuit"])
        for number in snapshot.missing(range(CHUNKS))[:2]:
            low, middle, high = sorted(draw.sample(range(1, 120), 3))
            seen = [(k, *v) for k, v in state(events, middle).items() if int(k) % CHUNKS == number]
            times = iter([moment(low), moment(high)])
            snapshot.take(number, spark.createDataFrame(seen, MERCHANT), lambda times=times: next(times))
    assert snapshot.missing(range(CHUNKS)) == []
    changes = snapshot.changes(log, chunk)
    assert changes.columns == CHANGES.fieldNames()
    last = latest_per_key(changes, ["cuit"], ["seq"]).where("op != 'd'").collect()
    assert {r.cuit: (r.name, r.establishment) for r in last} == state(events, 120)
    # one version of a key at one position, and times never run against positions
    order = [(r.cuit, r.seq, r.op_ts) for r in changes.orderBy("cuit", "seq").collect()]
    assert len({(c, s) for c, s, _ in order}) == len(order)
    assert all(a[2] <= b[2] for a, b in zip(order, order[1:]) if a[0] == b[0])


def test_a_chunk_broken_off_is_read_again(spark, tmp_path):
    snapshot = ChunkedSnapshot(spark, str(tmp_path / "s"), MERCHANT, ["cuit"])
    first = iter([(5, AT)])
    with pytest.raises(StopIteration):
        snapshot.take(0, spark.createDataFrame([("1", "old", "o")], MERCHANT), lambda: next(first))
    assert snapshot.missing(range(1)) == [0]
    log = spark.createDataFrame([], CHANGES)
    assert snapshot.changes(log, F.lit(0)).count() == 0
    again = iter([(6, AT), (7, AT)])
    snapshot.take(0, spark.createDataFrame([("1", "new", "n")], MERCHANT), lambda: next(again))
    assert [(r.name, r.op, r.seq) for r in snapshot.changes(log, F.lit(0)).collect()] == [("new", "r", 7)]


def test_a_position_that_goes_back_raises(spark, tmp_path):
    times = iter([(9, AT), (8, AT)])
    with pytest.raises(ValueError, match="went back from 9 to 8"):
        ChunkedSnapshot(spark, str(tmp_path / "s"), MERCHANT, ["cuit"]).take(0, spark.createDataFrame([], MERCHANT), lambda: next(times))
