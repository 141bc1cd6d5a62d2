"""The source with offsets: snapshot first, log by position, limited batches, nothing lost over a stop."""

import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.sources.landed import LandedBehind, LandedReader, read_landed

SCHEMA = T.StructType([T.StructField("seq", T.LongType()), T.StructField("v", T.StringType())])


def land(folder, name, positions, row_group=4):
    folder.mkdir(parents=True, exist_ok=True)
    table = pa.table({"seq": pa.array(positions, pa.int64()), "v": [f"{name}-{i}" for i in range(len(positions))]})
    pq.write_table(table, folder / f"{name}.parquet", row_group_size=row_group)
    return table.to_pylist()


def reader(tmp_path, **options):
    return LandedReader({"path": str(tmp_path / "log"), "position": "seq", **options}, SCHEMA)


def take(source, start):
    end = json.loads(json.dumps(source.latestOffset()))
    return [row for p in source.partitions(start, end) for b in source.read(p) for row in b.to_pylist()], end


def by_value(rows):
    return sorted(rows, key=lambda r: r["v"])


@pytest.mark.parametrize("seed", range(8))
def test_every_record_once_whatever_the_files_and_stops(tmp_path, seed):
    rng = random.Random(seed)
    log = [row for f in range(5) for row in land(tmp_path / "log", f"l{f}", [rng.randrange(40) for _ in range(rng.randrange(15))], rng.choice([1, 3, 50]))]
    first = land(tmp_path / "snapshot", "s", list(range(rng.randrange(10))), 2)
    options = {"snapshot": str(tmp_path / "snapshot"), "limit": str(rng.randrange(1, 12))}
    source = reader(tmp_path, **options)
    at, got = source.initialOffset(), []
    while True:
        rows, end = take(source, at)
        if end == at:
            break
        got, at = got + [rows], end
        if rng.random() < 0.4:  # a stop: Spark tells the new reader the last offset by an empty range
            source = reader(tmp_path, **options)
            assert source.partitions(at, at) == []
    flat = [row for rows in got for row in rows]
    assert by_value(flat) == by_value(log + first)
    kinds = [row["v"][0] for row in flat]
    assert kinds == sorted(kinds, reverse=True)  # the snapshot's before the log's
    newest = [max(r["seq"] for r in rows if r["v"][0] == "l") for rows in got if any(r["v"][0] == "l" for r in rows)]
    assert newest == sorted(set(newest))


def test_ordered_row_groups_keep_to_the_limit(tmp_path):
    land(tmp_path / "log", "a", list(range(40)))
    source, at, sizes = reader(tmp_path, limit="8"), None, []
    at = source.initialOffset()
    for _ in range(5):
        rows, at = take(source, at)
        sizes.append(len(rows))
    assert sizes == [8] * 5 and take(source, at) == ([], at)


def test_no_folder_and_empty_files_hold_nothing(tmp_path):
    source = reader(tmp_path, snapshot=str(tmp_path / "none"))
    assert take(source, source.initialOffset()) == ([], source.initialOffset())
    land(tmp_path / "log", "a", [])
    assert take(source, source.initialOffset()) == ([], source.initialOffset())


@pytest.mark.parametrize("behind", [[3], [7], [5, 12]])
@pytest.mark.parametrize("again", [False, True])
def test_records_that_land_behind_raise(tmp_path, behind, again):
    land(tmp_path / "log", "a", [1, 4, 7])
    source = reader(tmp_path)
    _, at = take(source, source.initialOffset())
    land(tmp_path / "log", "b", [8, 9])
    if again:
        source = reader(tmp_path)
        source.partitions(at, at)
    rows, at = take(source, at)
    assert [r["seq"] for r in rows] == [8, 9]
    land(tmp_path / "log", "c", behind)
    with pytest.raises(LandedBehind):
        source.latestOffset()


def test_other_snapshot_and_missing_positions_raise(tmp_path):
    land(tmp_path / "snapshot", "a", [1, 2, 3], 1)
    source = reader(tmp_path, snapshot=str(tmp_path / "snapshot"), limit="1")
    take(source, source.initialOffset())
    land(tmp_path / "snapshot", "b", [4])
    with pytest.raises(LandedBehind):
        source.latestOffset()
    land(tmp_path / "log", "n", [1, None])
    with pytest.raises(LandedBehind):
        reader(tmp_path).latestOffset()


@pytest.mark.parametrize("options", [{"path": ""}, {"position": ""}, {"limit": "0"}])
def test_options_are_checked(tmp_path, options):
    with pytest.raises(ValueError):
        reader(tmp_path, **options)


def test_stream_stops_and_goes_on(spark, tmp_path):
    folder = str(tmp_path)
    schema = "seq bigint, amount decimal(18,2), at timestamp_ntz, v string"
    rows = spark.range(1000).selectExpr(
        "id AS seq", "CAST(id / 7 AS DECIMAL(18,2)) AS amount", "timestampadd(SECOND, id, TIMESTAMP_NTZ '2024-01-01 00:00:00') AS at",
        "IF(id % 5 = 0, NULL, CAST(id AS STRING)) AS v", "'more' AS extra",
    )
    rows.repartitionByRange(10, "seq").write.parquet(f"{folder}/log")

    def run(**trigger):
        read = read_landed(spark, f"{folder}/log", T.StructType.fromDDL(schema), "seq", limit=250)
        out = read.writeStream.foreachBatch(lambda b, n: b.withColumn("n", F.lit(n)).write.parquet(f"{folder}/out/n={n}"))
        return out.option("checkpointLocation", f"{folder}/checkpoint").trigger(**trigger).start()

    for _ in range(2):
        run(availableNow=True).awaitTermination()
    rest = run(processingTime="0 seconds")
    rest.processAllAvailable()
    rest.stop()
    got = spark.read.parquet(f"{folder}/out")
    sizes = {r.n: r["count"] for r in got.groupBy("n").count().collect()}
    assert sum(sizes.values()) == 1000 and len(sizes) >= 4 and max(sizes.values()) < 500
    assert got.drop("n").exceptAll(rows.drop("extra")).isEmpty() and rows.drop("extra").exceptAll(got.drop("n")).isEmpty()
    rows.limit(3).write.mode("append").parquet(f"{folder}/log")
    with pytest.raises(StreamingQueryException, match="LandedBehind"):
        run(availableNow=True).awaitTermination()
