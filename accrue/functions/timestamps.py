"""Time columns as UTC wall clocks.

The library keeps every instant as TIMESTAMP_NTZ holding the UTC wall clock, so
no result depends on ``spark.sql.session.timeZone``. Casting between TIMESTAMP
and TIMESTAMP_NTZ goes through the session zone, hence the epoch arithmetic here.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def seconds_interval(seconds: int | float) -> Column:
    """A constant day-time interval of ``seconds``."""
    return F.expr(f"INTERVAL '1' SECOND * {seconds}")


def utc_literal(instant: datetime) -> Column:
    """A naive UTC datetime as a constant."""
    return F.expr(f"TIMESTAMP_NTZ '{instant.isoformat(sep=' ')}'")


def from_epoch(seconds: Column) -> Column:
    """Whole epoch seconds -> UTC wall clock."""
    return F.expr(_EPOCH) + F.expr("INTERVAL '1' SECOND") * seconds.cast("bigint")


def utc_column(column: Column, data_type: T.DataType) -> Column:
    """UTC wall clock of a TIMESTAMP; TIMESTAMP_NTZ columns already hold it."""
    if isinstance(data_type, T.TimestampNTZType):
        return column
    if isinstance(data_type, T.TimestampType):
        return F.expr(_EPOCH) + F.expr("INTERVAL '0.000001' SECOND") * F.unix_micros(column)
    raise TypeError(f"expected a timestamp column, got {data_type.simpleString()}")


def now_utc() -> Column:
    """The time of the query, for ``closed(lines, now_utc())``."""
    return utc_column(F.current_timestamp(), T.TimestampType())


def to_utc(df: DataFrame, *names: str) -> DataFrame:
    """Normalise the named time columns to UTC wall clocks."""
    changed = {
        name: utc_column(F.col(name), df.schema[name].dataType)
        for name in names
        if not isinstance(df.schema[name].dataType, T.TimestampNTZType)
    }
    return df.withColumns(changed) if changed else df
