from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from accrue.functions import check_fixed_offset, parse_period, to_utc, with_period
from conftest import utc

BA = "America/Argentina/Buenos_Aires"


# a period is a name, or a number without sign, fraction or other decoration and the letter s
NAMES, NUMBERS = ["daily", "monthly"], ["1", "7", "90", "86400", "007"]


@pytest.mark.parametrize("spec", NAMES)
def test_names(spec):
    assert (parse_period(spec).kind, parse_period(spec).seconds) == (spec, 0)


@pytest.mark.parametrize("number", NUMBERS)
def test_numbers_of_seconds(number):
    period = parse_period(f"{number}s")
    assert (period.kind, period.seconds, period.spec) == ("seconds", int(number), f"{number}s")


def broken_specs():
    yield from (None, 60, b"60s", "", "s")
    for name in NAMES:
        yield from (name.upper(), name[:-1], name + "s", f" {name}", f"{name} ", f"{name}\n")
    for number in NUMBERS:
        yield number
        yield from (f"{number}{unit}" for unit in ("S", "m", "h", "d", "ms", " s", "ss", "s\n"))
        yield from (f"{sign}{number}s" for sign in ("-", "+", " ", "0x"))
        yield f"{number}.5s"
    yield from ("0s", "000s", "1e3s", "1_0s", "\u0663s", f"{2**63}s")


@pytest.mark.parametrize("spec", list(broken_specs()), ids=repr)
def test_all_else_is_refused_with_the_three_forms(spec):
    with pytest.raises(ValueError, match="<n>s.*daily.*monthly"):
        parse_period(spec)


def window(spark, at, spec, zone=BA, anchor="epoch"):
    df = spark.createDataFrame([(utc(at),)], "t timestamp_ntz")
    row = with_period(df, "t", spec, zone, anchor).first()
    return row.window_start, row.window_end


@pytest.mark.parametrize(
    "at, spec, start, end",
    [
        ("2024-01-15 12:34:56.789", "1s", "2024-01-15 12:34:56", "2024-01-15 12:34:57"),
        ("2024-01-15 12:34:56.789", "60s", "2024-01-15 12:34:00", "2024-01-15 12:35:00"),
        ("2024-01-15 12:34:56", "120s", "2024-01-15 12:34:00", "2024-01-15 12:36:00"),
        ("2024-01-15 12:34:56", "86400s", "2024-01-15 03:00:00", "2024-01-16 03:00:00"),
        ("2024-01-15 02:59:59", "daily", "2024-01-14 03:00:00", "2024-01-15 03:00:00"),
        ("2024-01-15 03:00:00", "daily", "2024-01-15 03:00:00", "2024-01-16 03:00:00"),
        ("2024-02-29 12:00:00", "daily", "2024-02-29 03:00:00", "2024-03-01 03:00:00"),
        ("2024-02-29 12:00:00", "monthly", "2024-02-01 03:00:00", "2024-03-01 03:00:00"),
        ("2024-01-01 02:59:59", "monthly", "2023-12-01 03:00:00", "2024-01-01 03:00:00"),
        ("2024-01-01 03:00:00", "monthly", "2024-01-01 03:00:00", "2024-02-01 03:00:00"),
        # inside the zone's last era of daylight saving (UTC-2)
        ("2009-01-10 12:00:00", "daily", "2009-01-10 02:00:00", "2009-01-11 02:00:00"),
    ],
)
def test_period_bounds(spark, at, spec, start, end):
    assert window(spark, at, spec) == (utc(start), utc(end))


@pytest.mark.parametrize("spec", ["7s", "daily", "monthly"])
@pytest.mark.parametrize("zone", [BA, "Asia/Kolkata", "America/New_York"])
def test_the_fixed_offset_path_equals_the_zone_rules(spark, monkeypatch, spec, zone):
    moments = [(datetime(2005, 1, 1) + timedelta(hours=37 * i, seconds=i),) for i in range(2000)]
    df = spark.createDataFrame(moments, "t timestamp_ntz")
    found = [tuple(r) for r in with_period(df, "t", spec, zone).collect()]
    monkeypatch.setattr("accrue.functions.periods._fixed_era", lambda zone: None)
    assert found == [tuple(r) for r in with_period(df, "t", spec, zone).collect()]


def test_a_day_may_last_23_hours(spark):
    assert window(spark, "2024-03-10 12:00:00", "daily", "America/New_York") == (
        utc("2024-03-10 05:00:00"),
        utc("2024-03-11 04:00:00"),
    )


@pytest.mark.parametrize("n", [1, 2, 7, 11, 60, 3600])
def test_fixed_seconds_count_from_the_local_epoch(spark, n):
    start = datetime(2024, 1, 15, 2, 59, 50)
    rows = [(start + timedelta(seconds=i),) for i in range(25)]
    for row in with_period(spark.createDataFrame(rows, "t timestamp_ntz"), "t", f"{n}s", BA).collect():
        local = int((row.t - datetime(1970, 1, 1)).total_seconds()) - 10800
        expected = datetime(1970, 1, 1) + timedelta(seconds=local - local % n + 10800)
        assert (row.window_start, row.window_end) == (expected, expected + timedelta(seconds=n))


def test_counting_from_midnight_restarts_each_day(spark):
    assert window(spark, "2024-01-15 03:00:08", "7s", BA, "midnight")[0] == utc("2024-01-15 03:00:07")
    # 86400 is no multiple of 7: the day's last period is cut at midnight
    assert window(spark, "2024-01-15 02:59:59", "7s", BA, "midnight") == (
        utc("2024-01-15 02:59:54"),
        utc("2024-01-15 03:00:00"),
    )


def test_instants_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-15 02:59:59.123456Z' AS t")
    assert to_utc(df, "t").first().t == utc("2024-01-15 02:59:59.123456")
    rows = spark.createDataFrame([(utc("2024-03-31 01:30:00"),)], "t timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    found = set()
    try:
        for zone in ("UTC", "Europe/Berlin", "America/New_York"):  # 01:30 is a gap or not, by zone
            spark.conf.set("spark.sql.session.timeZone", zone)
            found.add(tuple(with_period(rows, "t", "60s", BA).first()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == {(utc("2024-03-31 01:30:00"), utc("2024-03-31 01:30:00"), utc("2024-03-31 01:31:00"))}


def test_strict_zone():
    check_fixed_offset(BA)
    with pytest.raises(ValueError):
        check_fixed_offset("America/New_York")


def test_other_types_are_refused(spark):
    with pytest.raises(TypeError):
        to_utc(spark.range(1).select(F.lit("2024-01-01").alias("t")), "t")
