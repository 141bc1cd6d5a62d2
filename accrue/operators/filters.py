"""Row filters of the consolidation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrue.functions.timestamps import utc_literal


def in_family(tax_id: Column, family: str = "RET_") -> Column:
    """Tax ids of one family. The underscore is literal: ``RETXIVA`` is not in ``RET_``."""
    return tax_id.startswith(family)


def released(df: DataFrame, event_time: str, wm: datetime | None) -> DataFrame:
    """Rows whose event time the watermark has passed; none before the first watermark."""
    return df.where(F.lit(False)) if wm is None else df.where(F.col(event_time) <= utc_literal(wm))


def pending(df: DataFrame, event_time: str, wm: datetime | None) -> DataFrame:
    """The complement of :func:`released`: rows that wait for a newer event."""
    return df if wm is None else df.where(F.col(event_time) > utc_literal(wm))
