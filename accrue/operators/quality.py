"""Checks over rate lines, each a DataFrame of the offending rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrue.functions.aggregates import exact_sum
from accrue.functions.periods import Period, period_end, period_start


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def orphans(keyed: DataFrame, dimension: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key the dimension never had."""
    return keyed.join(dimension.select(*on).distinct(), on, "left_anti")


def family_leak(lines: DataFrame, column: str = "tax_id", family: str = "PER") -> DataFrame:
    """Lines of a family that must not consolidate."""
    return lines.where(F.col(column).startswith(family))


def differences(left: DataFrame, right: DataFrame, keys: list[str], same: bool = False) -> DataFrame:
    """Keys with ``status`` only_left / only_right / changed (and equal, with ``same``).

    All columns are compared NULL-safe, keys too; decimals by value, times by instant.
    """
    values = [c for c in left.columns if c not in keys]
    a = left.select(*keys, F.struct(*values).alias("_left"))
    b = right.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], F.struct(*values).alias("_right"))
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    equal = reduce(
        lambda x, y: x & y, [F.col(f"_left.{c}").eqNullSafe(F.col(f"_right.{c}")) for c in values], F.lit(True)
    )
    status = (
        F.when(F.col("_right").isNull(), "only_left")
        .when(F.col("_left").isNull(), "only_right")
        .when(equal, "equal")
        .otherwise("changed")
    )
    either = [F.when(F.col("_left").isNull(), F.col(f"_key_{i}")).otherwise(F.col(k)).alias(k) for i, k in enumerate(keys)]
    found = a.join(b, on, "full_outer").select(*either, status.alias("status"))
    return found if same else found.where(F.col("status") != "equal")


def wrong_amounts(facts: DataFrame, base="base_tax", rate="tax_rate", amount="tax_amount") -> DataFrame:
    """Facts whose amount is not base * rate percent (holds for seeded facts, not for every source)."""
    percent = (F.col(base) * F.col(rate) * F.expr("0.01BD")).cast("decimal(18,2)")
    return facts.where(~F.col(amount).eqNullSafe(percent))


def wrong_spans(lines: DataFrame, period: str | Period, zone: str) -> DataFrame:
    """Lines whose window is not a period: the start not on a boundary, or the end not the period's end."""
    start = F.col("window_start")
    right = (period_start(start, period, zone) == start) & (period_end(start, period, zone) == F.col("window_end"))
    return lines.where(~F.coalesce(right, F.lit(False)))


def wrong_totals(lines: DataFrame, facts: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    """Lines whose totals are not the plain sums of ``facts`` (which carry the keys), both ways."""
    plain = facts.groupBy(*keys).agg(*[exact_sum(F.col(c)).alias(t) for c, t in measures.items()])
    return differences(lines.select(*keys, *measures.values()), plain, keys)


def changed_lines(earlier: DataFrame, later: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of the earlier snapshot that differ or are missing in the later one."""
    found = differences(earlier, later, keys)
    return found.where(F.col("status") != "only_right")
