"""Views over rate lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accrue.functions.aggregates import exact_sum
from accrue.functions.timestamps import utc_literal
from accrue.plans.model import TAXES, Model


def _instant(value: datetime | Column) -> Column:
    return value if isinstance(value, Column) else utc_literal(value)


def closed(lines: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Lines whose period ended before ``as_of`` (UTC wall clock)."""
    return lines.where(F.col("window_end") < _instant(as_of))


def still_open(lines: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Lines that may still grow by the clock."""
    return lines.where(F.col("window_end") >= _instant(as_of))


def final(lines: DataFrame, wm: datetime | Column) -> DataFrame:
    """Lines no accepted fact can change any more: their period ended at or before the watermark.

    ``closed`` compares with a clock; an accepted fact may still be waiting then.
    """
    return lines.where(F.col("window_end") <= _instant(wm))


def certificates(lines: DataFrame, model: Model = TAXES) -> DataFrame:
    """One row per (key, group, period) with its rate lines, in order of the rate."""
    line = F.struct(model.rate, *model.measures.values(), *model.attributes.values())
    return lines.groupBy(model.key, *model.group, "window_start", "window_end").agg(
        F.count(F.lit(1)).alias("rate_line_count"),
        *[exact_sum(F.col(total)).alias(total) for total in model.measures.values()],
        F.sort_array(F.collect_list(line)).alias("rate_lines"),
    )


def line(lines: DataFrame, **key) -> DataFrame:
    """The line(s) of the given key columns; datetimes are UTC wall clocks."""
    for name, value in key.items():
        lines = lines.where(F.col(name) == (utc_literal(value) if isinstance(value, datetime) else F.lit(value)))
    return lines


def report(lines: DataFrame, key=None, model: Model = TAXES, by: str = "tax") -> DataFrame:
    """Lines in reading order: by tax, rate and period (``by='tax'``) or by period and tax."""
    if key is not None:
        lines = lines.where(F.col(model.key) == F.lit(key))
    if by == "tax":
        return lines.orderBy(*model.group, model.rate, "window_start")
    return lines.orderBy("window_start", *model.group)


def numbered(lines: DataFrame, order: list[str], within: list[str]) -> DataFrame:
    """Lines with their ``position`` in an order, counted within each group so that no task orders them all."""
    return lines.withColumn("position", F.row_number().over(Window.partitionBy(*within).orderBy(*order)))


def enriched_keys(lines: DataFrame, model: Model = TAXES) -> DataFrame:
    """Distinct keys of lines that found any attribute."""
    found = F.lit(False)
    for name in model.attributes.values():
        found = found | F.col(name).isNotNull()
    return lines.where(found).select(model.key).distinct()
