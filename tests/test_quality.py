from datetime import datetime
from decimal import Decimal

from accrue.operators import quality
from accrue.sources.schemas import RATE_LINES

T = datetime(2024, 1, 15, 3)
KEYS = ["cuit", "tax_id", "window_start", "tax_rate"]


def rate_line(cuit, total="10.00", name="N", tax_id="RET_IVA", end=datetime(2024, 1, 16, 3), start=T):
    return (cuit, tax_id, start, Decimal("3.50"), "1", name, end, Decimal(total), Decimal("0.35"))


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), RATE_LINES)


def test_duplicates(spark):
    found = quality.duplicates(lines(spark, rate_line("a"), rate_line("a", "1.00"), rate_line("b")), KEYS)
    assert [(r.cuit, r["count"]) for r in found.collect()] == [("a", 2)]


def test_orphans_and_family(spark):
    df = lines(spark, rate_line("a"), rate_line("b", tax_id="PER_IVA"))
    dimension = spark.createDataFrame([("a",), ("a",)], "cuit string")
    assert [r.cuit for r in quality.orphans(df, dimension, ["cuit"]).collect()] == ["b"]
    assert [r.cuit for r in quality.family_leak(df).collect()] == ["b"]


def test_differences_are_null_safe(spark):
    left = lines(spark, rate_line("a"), rate_line("b", name=None), rate_line("c"), rate_line("d"))
    right = lines(spark, rate_line("a"), rate_line("b", name=None), rate_line("c", name=None), rate_line("e"))
    found = {r.cuit: r.status for r in quality.differences(left, right, KEYS, same=True).collect()}
    assert found == {"a": "equal", "b": "equal", "c": "changed", "d": "only_left", "e": "only_right"}
    assert {r.cuit for r in quality.changed_lines(left, right, KEYS).collect()} == {"c", "d"}


def test_amounts(spark):
    facts = spark.sql("SELECT * FROM VALUES (1, 1000.00BD, 3.50BD, 35.00BD), (2, 5000.00BD, 2.00BD, 150.00BD) AS t(id, base_tax, tax_rate, tax_amount)")
    assert [r.id for r in quality.wrong_amounts(facts).collect()] == [2]


def test_spans(spark):
    df = lines(
        spark,
        rate_line("a"),
        rate_line("b", end=datetime(2024, 1, 17, 3)),
        rate_line("c", start=datetime(2024, 1, 15, 4), end=datetime(2024, 1, 16, 3)),
    )
    assert {r.cuit for r in quality.wrong_spans(df, "daily", "America/Argentina/Buenos_Aires").collect()} == {"b", "c"}


def test_totals(spark):
    facts = lines(spark, rate_line("a", "4.00"), rate_line("a", "6.00"), rate_line("b")).selectExpr(
        *KEYS, "total_base_tax AS base_tax"
    )
    found = quality.wrong_totals(lines(spark, rate_line("a"), rate_line("b", "9.00")), facts, KEYS, {"base_tax": "total_base_tax"})
    assert {(r.cuit, r.status) for r in found.collect()} == {("b", "changed")}


def test_differences_take_null_keys_as_equal(spark):
    left = spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int")
    right = spark.createDataFrame([(None, 1), ("a", 2), ("b", 1)], "k string, v int")
    from accrue.operators import quality

    found = {(r.k, r.status) for r in quality.differences(left, right, ["k"], same=True).collect()}
    assert found == {(None, "equal"), ("a", "changed"), ("b", "only_right")}


def test_planted_wrong_amounts_are_found(spark):
    import __spark_entry__ as contract

    row = contract.queries()["qa_amounts"](spark, "/root/testdata/sf0.001").first()
    assert row.facts == 1000 and row.wrong == 11
