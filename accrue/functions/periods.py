"""Calendar and fixed-second periods aligned to a local time zone.

All functions take and return UTC wall clocks (TIMESTAMP_NTZ), see
``accrue.functions.timestamps``. Zone rules apply to each row's own instant, so
zones with daylight saving work; ``check_fixed_offset`` is the opt-in guard for
callers that want such zones rejected. Rows after a zone's last change, all rows of
today in a zone without daylight saving, take the cheap path of a fixed offset.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrue.functions.timestamps import from_epoch, seconds_interval

DEFAULT_PERIOD = "60s"
DEFAULT_ZONE = "America/Argentina/Buenos_Aires"
_MAX_SECONDS = 2**63 - 1


@dataclass(frozen=True)
class Period:
    """A parsed period spec. ``seconds`` is 0 for the calendar kinds."""

    kind: str  # "seconds" | "daily" | "monthly"
    seconds: int
    spec: str

def parse_period(spec: str | Period | None) -> Period:
    """``'<n>s'`` with n >= 1, ``'daily'`` or ``'monthly'``; anything else raises."""
    if isinstance(spec, Period):
        return spec
    if spec in ("daily", "monthly"):
        return Period(spec, 0, spec)
    digits = re.fullmatch(r"([0-9]+)s", spec) if isinstance(spec, str) else None
    if digits and 1 <= int(digits[1]) <= _MAX_SECONDS:
        return Period("seconds", int(digits[1]), spec)
    raise ValueError(
        f"Unknown period {spec!r}; use '<n>s' (whole seconds from 1 up, like '90s'), 'daily' or 'monthly'"
    )


@lru_cache
def _offsets(zone: str) -> tuple[tuple[date, int], ...]:
    """(first UTC day, offset in seconds) of each run of days with one offset, 1970 to ten years ahead."""
    tz, day = ZoneInfo(zone), datetime(1970, 1, 1, tzinfo=timezone.utc)
    runs, last = [], datetime.now(timezone.utc) + timedelta(days=3660)
    while day < last:
        offset = int(day.astimezone(tz).utcoffset().total_seconds())
        if not runs or runs[-1][1] != offset:
            runs.append((day.date(), offset))
        day += timedelta(days=1)
    return tuple(runs)


def check_fixed_offset(zone: str) -> None:
    """Reject a zone whose UTC offset changes within the next ten years."""
    if _offsets(zone)[-1][0] > datetime.now(timezone.utc).date():
        raise ValueError(f"Zone {zone} changes its UTC offset in the next ten years")


def _fixed_era(zone: str) -> tuple[date, int] | None:
    """Since when a zone has had its present offset for good, two months spared; None if it still changes."""
    since, offset = _offsets(zone)[-1]
    return None if since > datetime.now(timezone.utc).date() else (since + timedelta(days=62), offset)


def _by_era(ts: Column, zone: str, fixed, general) -> Column:
    """``fixed(offset)`` where the zone's offset is settled, which is plain arithmetic; else ``general()``."""
    era = _fixed_era(zone)
    if era is None:
        return general()
    return F.when(ts >= F.expr(f"TIMESTAMP_NTZ '{era[0]} 00:00:00'"), fixed(era[1])).otherwise(general())


def _local(ts: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def _instant(local: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local.cast("timestamp_ntz"))


def _floor_seconds(ts: Column, local_seconds: Column, n: int) -> Column:
    return from_epoch(F.unix_timestamp(ts) - F.pmod(local_seconds, F.lit(n)))


def period_start(
    ts: Column,
    period: str | Period = DEFAULT_PERIOD,
    zone: str = DEFAULT_ZONE,
    anchor: str = "epoch",
    strict_zone: bool = False,
) -> Column:
    """Start of the period that holds ``ts``.

    Fixed-second periods are multiples of n on the local wall clock, counted from
    local 1970-01-01 (``anchor='epoch'``) or from each local midnight
    (``anchor='midnight'``); the two differ when n does not divide a day.
    Fractions of a second are dropped.
    """
    period = parse_period(period)
    if strict_zone:
        check_fixed_offset(zone)
    if anchor not in ("epoch", "midnight"):
        raise ValueError(f"anchor must be 'epoch' or 'midnight', got {anchor!r}")
    # unix_timestamp reads a TIMESTAMP_NTZ as UTC whatever the session zone is
    seconds = F.unix_timestamp(ts)
    if period.kind == "daily":
        return _by_era(
            ts,
            zone,
            lambda offset: _floor_seconds(ts, seconds + offset, 86400),
            lambda: _instant(_local(ts, zone).cast("date"), zone),
        )
    if period.kind == "monthly":
        return _by_era(
            ts,
            zone,
            lambda offset: F.trunc((ts + seconds_interval(offset)).cast("date"), "MM").cast("timestamp_ntz")
            - seconds_interval(offset),
            lambda: _instant(F.trunc(_local(ts, zone).cast("date"), "MM"), zone),
        )

    def counted(local_seconds: Column) -> Column:
        if anchor == "midnight":
            local_seconds = F.pmod(local_seconds, F.lit(86400))
        return _floor_seconds(ts, local_seconds, period.seconds)

    return _by_era(
        ts, zone, lambda offset: counted(seconds + offset), lambda: counted(F.unix_timestamp(_local(ts, zone)))
    )


def period_end(
    start: Column,
    period: str | Period = DEFAULT_PERIOD,
    zone: str = DEFAULT_ZONE,
    anchor: str = "epoch",
) -> Column:
    """End (exclusive) of the period that begins at ``start``."""
    period = parse_period(period)
    first = _local(start, zone).cast("date")
    next_midnight = _by_era(
        start,
        zone,
        lambda offset: _floor_seconds(start, F.unix_timestamp(start) + offset, 86400) + seconds_interval(86400),
        lambda: _instant(F.date_add(first, 1), zone),
    )
    if period.kind == "daily":
        return next_midnight
    if period.kind == "monthly":
        return _by_era(
            start,
            zone,
            lambda offset: F.add_months((start + seconds_interval(offset)).cast("date"), 1).cast("timestamp_ntz")
            - seconds_interval(offset),
            lambda: _instant(F.add_months(first, 1), zone),
        )
    end = start + seconds_interval(period.seconds)
    # counting restarts at local midnight, so the last period of a day may be short
    return F.least(end, next_midnight) if anchor == "midnight" else end


def with_period(
    df: DataFrame,
    event_time: str,
    period: str | Period = DEFAULT_PERIOD,
    zone: str = DEFAULT_ZONE,
    anchor: str = "epoch",
) -> DataFrame:
    """Add ``window_start`` and ``window_end`` for a UTC wall-clock column."""
    return df.withColumn("window_start", period_start(F.col(event_time), period, zone, anchor)).withColumn(
        "window_end", period_end(F.col("window_start"), period, zone, anchor)
    )
