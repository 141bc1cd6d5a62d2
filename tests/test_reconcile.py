from decimal import Decimal

import pytest

from accrue.operators.quality import differences
from accrue.operators.reconcile import reconcile

SCHEMA = "k long, j string, amount decimal(10,2), rate double"


def rows_of(found):
    return sorted(tuple(r) for r in found.select("k", "j", "status").collect())


def rows(n, change=()):
    return [(i, None if i % 5 == 0 else str(i % 3), Decimal(i + (100 if i in change else 0)), 0.0) for i in range(n)]


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_finds_what_the_full_join_finds(spark, buckets):
    left = spark.createDataFrame(rows(200), SCHEMA)
    right = spark.createDataFrame([r for r in rows(230, change=(7, 55)) if r[0] not in (3, 120)], SCHEMA)
    found = rows_of(reconcile(left, right, ["k", "j"], buckets))
    plain = sorted(rows_of(differences(left, right, ["k", "j"])), key=str)
    assert sorted(found, key=str) == plain and len(found) == 34


def test_equal_tables_are_not_joined(spark):
    left = spark.createDataFrame(rows(100), SCHEMA)
    right = left.selectExpr("k", "j", "CAST(amount AS DECIMAL(18,4)) AS amount", "-rate AS rate").repartition(7)
    found = reconcile(left, right, ["k"])
    assert found.count() == 0
    # nothing is read again
    assert found._jdf.queryExecution().optimizedPlan().toString().startswith("LocalRelation <empty>")


def test_null_that_moved_and_swapped_values_are_seen(spark):
    schema = "k long, a string, b string"
    left = spark.createDataFrame([(1, None, "x"), (2, "x", "y"), (None, "p", "q")], schema)
    right = spark.createDataFrame([(1, "x", None), (2, "y", "x"), (None, "p", "q")], schema)
    assert sorted(r.k for r in reconcile(left, right, ["k"]).collect()) == [1, 2]


def test_empty_tables_and_other_types(spark):
    left = spark.createDataFrame([], SCHEMA)
    assert reconcile(left, left, ["k"]).count() == 0
    assert [r.status for r in reconcile(left, spark.createDataFrame(rows(1), SCHEMA), ["k"]).collect()] == ["only_right"]
    with pytest.raises(TypeError, match="column k is bigint and string"):
        reconcile(left, left.selectExpr("string(k) AS k", "j", "amount", "rate"), ["k"])
