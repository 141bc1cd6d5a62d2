import pytest
from pyspark.sql import functions as F

from accrue.streaming import KeyedTable


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k string, d date, v int") if values and len(values[0]) == 3 else \
        spark.createDataFrame(list(values), "k string, v int")


def content(table, **options):
    df = table.read(**options)
    return None if df is None else sorted(map(tuple, df.collect()))


def test_upserts(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"])
    assert table.read() is None
    written = table.upsert(rows(spark, ("a", 1), ("b", 1)), "1")
    assert sorted(map(tuple, written.collect())) == [("a", 1), ("b", 1)]
    table.upsert(rows(spark, ("b", 2), ("c", 2)), "2")
    assert content(table) == [("a", 1), ("b", 2), ("c", 2)]
    assert content(table, before="2") == [("a", 1), ("b", 1)]


def test_the_same_token_replaces_its_version(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"])
    table.upsert(rows(spark, ("a", 1)), "1")
    table.upsert(rows(spark, ("a", 9), ("z", 9)), "2")
    table.upsert(rows(spark, ("a", 2)), "2")
    assert content(table) == [("a", 2)]
    # another object over the same folder goes on from there
    KeyedTable(spark, str(tmp_path), ["k"]).upsert(rows(spark, ("b", 3)), "3")
    assert content(table) == [("a", 2), ("b", 3)]


@pytest.mark.parametrize("merge_every", [2, 3])
def test_merging_folders_keeps_the_rows(spark, tmp_path, merge_every):
    table = KeyedTable(spark, str(tmp_path), ["k"], merge_every=merge_every)
    expected = {}
    for i in range(7):
        delta = {f"k{i % 4}": i, "always": i}
        if i % 3 == 0:
            table.upsert(rows(spark, ("always", -1), ("wrong", -1)), str(i))
        table.upsert(rows(spark, *delta.items()), str(i))
        expected |= delta
        assert content(table) == sorted(expected.items())
        assert len(table._head()["folders"]) <= 3
    before = len(list((tmp_path / "rows").glob("_folder=*")))
    table.vacuum()
    assert len(list((tmp_path / "rows").glob("_folder=*"))) < before
    assert content(table) == sorted(expected.items())
    table.upsert(rows(spark, ("always", 99)), "6")
    assert dict(content(table))["always"] == 99


def test_a_delete_survives_merging(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"], merge_every=2)
    table.upsert(rows(spark, ("a", 1)), "1")
    table.upsert(rows(spark, ("b", 1)), "2")
    table.upsert(rows(spark, ("c", 1)), "3")
    table.apply_changes(spark.createDataFrame([("a", None, "d", 1)], "k string, v int, op string, seq int"), "4", ["seq"])
    table.upsert(rows(spark, ("d", 1)), "5")
    assert content(table) == [("b", 1), ("c", 1), ("d", 1)]


def test_deletes(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"], merge_every=3)
    table.upsert(rows(spark, ("a", 1), ("b", 1), ("c", 1)), "1")
    changes = spark.createDataFrame(
        [("a", None, "d", 1), ("b", 2, "u", 1), ("b", 3, "u", 2), ("c", None, "d", 1), ("c", 4, "c", 2)],
        "k string, v int, op string, seq int",
    )
    table.apply_changes(changes, "2", ["seq"])
    assert content(table) == [("b", 3), ("c", 4)]
    table.upsert(rows(spark, ("a", 5)), "3")
    table.upsert(rows(spark, ("e", 6)), "4")
    assert content(table) == [("a", 5), ("b", 3), ("c", 4), ("e", 6)]


def test_reads_can_be_pruned(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"], "substring(k, 1, 1)")
    table.upsert(rows(spark, ("a1", 1), ("b1", 1)), "1")
    table.upsert(rows(spark, ("a2", 2), ("b2", 2)), "2")
    assert content(table, parts=["a"]) == [("a1", 1), ("a2", 2)]
    only = spark.createDataFrame([("a1",), ("b2",)], "k string")
    assert content(table, parts=["a"], only=only) == [("a1", 1)]
    plan = table.read(parts=["a"]).where(F.col("v") > 0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan or "_part" in plan.split("PartitionFilters")[1][:80]


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"])
    table.upsert(rows(spark, ("a", 1)), "1")
    broken = rows(spark, ("a", 2)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.upsert(broken, "2")
    assert content(table) == [("a", 1)]


def test_an_upsert_of_one_key_twice_raises(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"])
    with pytest.raises(ValueError, match="several rows"):
        table.upsert(rows(spark, ("a", 1), ("a", 2)), "1")
    assert table.read() is None


def test_an_upsert_with_other_columns_raises(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"])
    table.upsert(rows(spark, ("a", 1)).withColumn("w", F.lit(7)), "1")
    with pytest.raises(ValueError, match="other columns"):
        table.upsert(rows(spark, ("b", 1)), "2")
    assert table.read().columns == ["k", "v", "w"]


def _rows_scanned(df):
    df.collect()
    nodes, rows = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            nodes.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName().startswith("Scan"):
            rows += node.metrics().apply("numOutputRows").value()
    return rows


def test_a_lookup_reads_the_pages_that_can_hold_its_key(spark, tmp_path):
    rows = spark.range(400_000, numPartitions=4).selectExpr("CAST(hash(id) AS STRING) AS cuit", "id", "0 AS day")
    table = KeyedTable(spark, str(tmp_path / "t"), ["cuit", "id"], "day")
    table.upsert(rows, token="a", unique=True)
    wanted = rows.where("id = 77").first().cuit
    whole, found = table.read(), table.read().where(F.col("cuit") == wanted)
    assert _rows_scanned(whole) == 400_000
    assert _rows_scanned(found) <= 50_000  # pages of some 20,000 rows
    assert [r.id for r in found.collect()] == [77]
    assert _rows_scanned(table.read().where(F.col("cuit") == "no such key")) <= 50_000


def test_the_query_aggregates_each_delta_once(spark, tmp_path, monkeypatch):
    from accrue.plans import queries

    items = spark.range(200).selectExpr(
        "id % 150 AS l_orderkey", "1 AS l_linenumber", "TIMESTAMP_NTZ '1997-12-01 00:00:00' + INTERVAL '1' DAY * (id % 60) AS l_shipdate",
        *[f"id AS {c}" for c in queries.ITEM_ORDER[1:]]
    )
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(value):
        seen.add(1)
        return value

    monkeypatch.setattr(queries, "_table", lambda *_: spark.read.parquet(f"{tmp_path}/lineitem.parquet").withColumn("l_tax", counted("l_tax")))
    assert queries.keyed_table_upsert(spark, str(tmp_path)).count() == 150
    assert seen.value == 200
