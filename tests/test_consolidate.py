"""Planted scenarios of the consolidation, batch. M is the start of a 60 s period."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from accrue.functions import exact_sum, last_non_null, now_utc
from accrue.plans import Model, certificates, closed, consolidate, enriched_keys, final, line, report, still_open
from accrue.sources.schemas import RATE_LINES
from conftest import fact, line_set, utc

M = datetime(2024, 5, 6, 15, 0, 0)
PLATA, ANDINO, SUR, NOBODY = "30123456781", "33123456780", "23123456783", "20123456786"


def s(seconds):
    return M + timedelta(seconds=seconds)


def tick(id, at):
    return fact(id, NOBODY, "PER_IVA", "21.00", "1.00", "0.21", at)


def test_consolidate_six_rows(facts_of, log_of):
    facts = facts_of(
        fact(1, PLATA, "RET_IVA", "3.50", "1234.56", "43.21", s(28)),
        fact(2, PLATA, "RET_IVA", "3.50", "765.43", "26.79", s(29)),
        fact(3, PLATA, "RET_IVA", "5.00", "1000.00", "50.00", s(30)),
        fact(4, PLATA, "RET_GANANCIAS", "3.00", "2000.00", "60.00", s(31)),
        fact(5, PLATA, "PER_IVA", "21.00", "1000.00", "210.00", s(32)),
        fact(6, PLATA, "PER_IIBB_CABA", "5.00", "5000.00", "250.00", s(33)),
        fact(7, PLATA, "RETXIVA", "5.00", "1.00", "0.05", s(33)),
    )
    lines = consolidate(facts, log_of())
    assert lines.columns == RATE_LINES.names
    assert [f.dataType for f in lines.schema] == [f.dataType for f in RATE_LINES]
    assert line_set(lines) == {
        (PLATA, "RET_GANANCIAS", "3.00", M, None, "2000.00", "60.00"),
        (PLATA, "RET_IVA", "3.50", M, None, "1999.99", "70.00"),
        (PLATA, "RET_IVA", "5.00", M, None, "1000.00", "50.00"),
    }


def test_lateness_in_one_second_periods(facts_of, log_of):
    facts = facts_of(
        fact(1, PLATA, "RET_IVA", "3.50", "1000.00", "35.00", s(10)),
        fact(2, PLATA, "RET_IVA", "3.50", "500.00", "17.50", s(9)),
        tick(3, s(16.5)),
        fact(4, PLATA, "RET_IVA", "3.50", "2000.00", "70.00", s(3)),
    )
    assert line_set(consolidate(facts, log_of(), "1s")) == {
        (PLATA, "RET_IVA", "3.50", s(10), None, "1000.00", "35.00"),
        (PLATA, "RET_IVA", "3.50", s(9), None, "500.00", "17.50"),
    }


@pytest.mark.parametrize("gap, period, kept", [(5, "60s", True), (6, "60s", False)])
def test_rows_of_other_families_advance_the_watermark(facts_of, log_of, gap, period, kept):
    facts = facts_of(tick(1, s(gap)), fact(2, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(0)))
    assert (consolidate(facts, log_of(), period).count() == 1) is kept


def test_daily_and_monthly(facts_of, log_of):
    now = utc("2024-05-06 15:00:00")
    facts = facts_of(
        fact(1, PLATA, "RET_IVA", "5.00", "40000.00", "2000.00", now - timedelta(hours=26)),
        fact(2, PLATA, "RET_IVA", "5.00", "8000.00", "400.00", now),
    )
    assert {(r.window_start, r.window_end, str(r.total_base_tax)) for r in consolidate(facts, log_of(), "daily").collect()} == {
        (utc("2024-05-05 03:00:00"), utc("2024-05-06 03:00:00"), "40000.00"),
        (utc("2024-05-06 03:00:00"), utc("2024-05-07 03:00:00"), "8000.00"),
    }
    facts = facts_of(
        fact(1, PLATA, "RET_GANANCIAS", "3.00", "30000.00", "900.00", now - timedelta(days=40)),
        fact(2, PLATA, "RET_GANANCIAS", "3.00", "1000.00", "35.00", now),
    )
    assert {(r.window_start, r.window_end) for r in consolidate(facts, log_of(), "monthly").collect()} == {
        (utc("2024-03-01 03:00:00"), utc("2024-04-01 03:00:00")),
        (utc("2024-05-01 03:00:00"), utc("2024-06-01 03:00:00")),
    }


@pytest.mark.parametrize("strategy", ["auto", "interval", "union"])
def test_enrichment(facts_of, log_of, strategy):
    log = log_of(
        (PLATA, "Supermercados del Plata S.A.", "10001", "r", s(10), 1),
        (ANDINO, "Comercio Andino S.A.", "10002", "r", s(10), 2),
        (ANDINO, "Comercio Andino Express", "10999", "u", s(30), 3),
        (SUR, "Almacenes del Sur S.A.", "10003", "r", s(10), 4),
        (SUR, None, None, "d", s(70), 5),
    )
    facts = facts_of(
        fact(1, PLATA, "RET_IVA", "4.25", "2500.00", "106.25", s(5)),  # before the first version
        fact(2, PLATA, "RET_IVA", "6.75", "1500.75", "101.30", s(20)),
        fact(3, NOBODY, "RET_IVA", "3.50", "640.00", "22.40", s(21)),
        fact(4, ANDINO, "RET_IIBB_CABA", "2.00", "1000.00", "20.00", s(22)),
        fact(5, ANDINO, "RET_IIBB_CABA", "2.00", "500.00", "10.00", s(35)),  # updated within the period
        fact(6, SUR, "RET_IVA", "6.75", "1500.75", "101.30", s(40)),
        fact(7, SUR, "RET_IVA", "2.50", "800.00", "20.00", s(80)),  # after the delete
    )
    lines = consolidate(facts, log, strategy=strategy)
    assert line_set(lines) == {
        (PLATA, "RET_IVA", "4.25", M, None, "2500.00", "106.25"),
        (PLATA, "RET_IVA", "6.75", M, "Supermercados del Plata S.A.", "1500.75", "101.30"),
        (NOBODY, "RET_IVA", "3.50", M, None, "640.00", "22.40"),
        (ANDINO, "RET_IIBB_CABA", "2.00", M, "Comercio Andino Express", "1500.00", "30.00"),
        (SUR, "RET_IVA", "6.75", M, "Almacenes del Sur S.A.", "1500.75", "101.30"),
        (SUR, "RET_IVA", "2.50", s(60), None, "800.00", "20.00"),
    }
    assert {r.cuit for r in enriched_keys(lines).collect()} == {PLATA, ANDINO, SUR}


def test_a_null_never_replaces_a_name(facts_of, log_of):
    """Enriched, then deleted, within one line."""
    log = log_of((PLATA, "P", "1", "r", s(0), 1), (PLATA, None, None, "d", s(10), 2))
    facts = facts_of(
        fact(1, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(5)), fact(2, PLATA, "RET_IVA", "3.50", "2.00", "0.07", s(15))
    )
    assert line_set(consolidate(facts, log)) == {(PLATA, "RET_IVA", "3.50", M, "P", "3.00", "0.11")}


@pytest.mark.parametrize("strategy", ["interval", "union"])
def test_each_column_keeps_its_own_last_value(facts_of, log_of, strategy):
    """(n1, e1), then (n2, none), then (none, none), a fact in each."""
    facts = facts_of(*[fact(i, PLATA, "RET_IVA", "5.00", "1.00", "0.05", s(10 * i)) for i in (1, 2, 3)])
    log = log_of((PLATA, "n1", "e1", "r", s(5), 1), (PLATA, "n2", None, "u", s(15), 2), (PLATA, None, None, "u", s(25), 3))
    assert [(r.merchant_name, r.establishment) for r in consolidate(facts, log, strategy=strategy).collect()] == [("n2", "e1")]


def test_unflushed_rows_wait_for_the_watermark(facts_of, log_of):
    facts = facts_of(
        fact(1, PLATA, "RET_IVA", "3.50", "1.00", "0.04", s(0)),
        fact(2, PLATA, "RET_IVA", "5.00", "2.00", "0.10", s(5)),
        fact(3, PLATA, "RET_IVA", "3.00", "3.00", "0.09", s(5.001)),
        tick(4, s(10)),
    )
    assert {str(r.tax_rate) for r in consolidate(facts, log_of(), flush=False).collect()} == {"3.50", "5.00"}


def test_a_total_that_does_not_fit_raises(spark, facts_of, log_of):
    facts = facts_of(*[fact(i, PLATA, "RET_IVA", "3.50", "9999999999999999.99", "0.00", s(i)) for i in range(2)])
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="does not fit"):
                consolidate(facts, log_of()).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


def test_no_facts(facts_of, log_of):
    assert consolidate(facts_of(), log_of()).collect() == []


def test_aggregates(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a', 1.10BD), (2, 'b', 2.20BD), (3, NULL, 3.30BD) AS t(n, v, m)")
    row = df.agg(last_non_null(F.col("v"), F.col("n")).alias("v"), exact_sum(F.col("m")).alias("m")).first()
    assert (row.v, row.m) == ("b", Decimal("6.60"))


def test_views(facts_of, log_of):
    facts = facts_of(
        fact(1, PLATA, "RET_IVA", "5.00", "10.00", "0.50", s(10)),
        fact(2, PLATA, "RET_IVA", "3.50", "20.00", "0.70", s(11)),
        fact(3, PLATA, "RET_GANANCIAS", "3.00", "30.00", "0.90", s(70)),
    )
    lines = consolidate(facts, log_of())
    assert closed(lines, s(60)).count() == 0 and final(lines, s(60)).count() == 2
    assert closed(lines, s(61)).count() == 2 and still_open(lines, s(61)).count() == 1
    found = {(r.tax_id, r.rate_line_count, str(r.total_base_tax), tuple(str(x.tax_rate) for x in r.rate_lines)) for r in certificates(lines).collect()}
    assert found == {("RET_IVA", 2, "30.00", ("3.50", "5.00")), ("RET_GANANCIAS", 1, "30.00", ("3.00",))}
    key = {"cuit": PLATA, "tax_id": "RET_IVA", "window_start": M, "tax_rate": Decimal("5.00")}
    assert [str(r.total_base_tax) for r in line(lines, **key).collect()] == ["10.00"]
    assert [str(r.tax_rate) for r in report(lines, PLATA).collect()] == ["3.00", "3.50", "5.00"]
    assert [r.window_start for r in report(lines, PLATA, by="period").collect()] == [M, M, s(60)]


def test_plan_prunes_and_carries_no_texts_through_the_shuffle(spark, tmp_path, facts_of, log_of):
    facts_of(fact(1, PLATA, "RET_IVA", "5.00", "10.00", "0.50", s(10))).write.parquet(str(tmp_path / "facts"))
    log_of((PLATA, "P", "1", "r", s(0), 1)).write.parquet(str(tmp_path / "log"))
    lines = consolidate(spark.read.parquet(str(tmp_path / "facts")), spark.read.parquet(str(tmp_path / "log")))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    scan = next(row for row in plan.splitlines() if "ReadSchema" in row and "tax_rate" in row)
    for unused in ("transaction_id", "tax_status", "exclusion_rate"):
        assert unused not in scan
    assert "StartsWith(tax_id, RET_)" in scan.replace("StringStartsWith", "StartsWith").replace("tax_id,RET_", "tax_id, RET_")
    assert "SortAggregate" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_closed_by_the_clock(spark, facts_of, log_of):
    clock = spark.sql("SELECT unix_timestamp() AS e").select("e", now_utc().alias("n")).first()
    assert abs((clock.n - datetime(1970, 1, 1)).total_seconds() - clock.e) < 60
    lines = consolidate(facts_of(fact(1, PLATA, "RET_IVA", "5.00", "10.00", "0.50", s(10))), log_of())
    assert closed(lines, now_utc()).count() == 1 and still_open(lines, now_utc()).count() == 0


def test_other_column_names(spark):
    """Times with zone, no group but the rate, one measure, another family."""
    model = Model(
        key="shop",
        group=(),
        rate="level",
        measures={"paid": "total_paid"},
        attributes={"owner": "owner_name"},
        event_time="at",
        arrival=("arrived", "n"),
        family_column="kind",
        family="SALE-",
    )
    facts = spark.sql(
        """SELECT * FROM VALUES
          (1, TIMESTAMP '2024-01-01 00:00:10Z', 's', 'SALE-a', 1, 10.00BD, TIMESTAMP '2024-01-01 00:00:05Z'),
          (2, TIMESTAMP '2024-01-01 00:00:11Z', 's', 'SALE-b', 1, 20.00BD, TIMESTAMP '2024-01-01 00:00:25Z'),
          (3, TIMESTAMP '2024-01-01 00:00:12Z', 's', 'RENT-a', 1, 40.00BD, TIMESTAMP '2024-01-01 00:00:40Z'),
          (4, TIMESTAMP '2024-01-01 00:00:13Z', 's', 'SALE-a', 1, 80.00BD, TIMESTAMP '2024-01-01 00:00:34Z')
        AS t(n, arrived, shop, kind, level, paid, at)"""
    )
    log = spark.sql(
        """SELECT * FROM VALUES ('s', 'Ann', 'r', TIMESTAMP '2024-01-01 00:00:00Z', 1L),
           ('s', 'Bob', 'u', TIMESTAMP '2024-01-01 00:00:20Z', 2L) AS t(shop, owner, op, op_ts, seq)"""
    )
    row = consolidate(facts, log, "60s", zone="UTC", model=model).collect()
    assert [tuple(r) for r in row] == [
        ("s", datetime(2024, 1, 1), 1, "Bob", datetime(2024, 1, 1, 0, 1), Decimal("30.00"))
    ]
