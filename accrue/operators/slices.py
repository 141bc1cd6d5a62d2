"""Cutting hot groups into ordered slices.

A window over a group that holds a large share of all rows is one slow task.
Here such a group is cut into consecutive slices of its own sort order, so each
slice can run in its own task, and the caller carries a small summary from one
slice to the next. The cut points come from a sample, as in a range sort; any
choice of them gives the same exact result, only the balance differs. They are
fixed on the driver once, so a recomputed task sees the same slices.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_ROWS = 2_000_000  # rows one task may order by itself
MAX_SLICES = 16_384  # upper bound of hot groups, and of their slices together (times two)
_SAMPLES = 16  # sampled rows per slice, so at most 262144 rows reach the driver

SLICE = "_slice"


def same_group(left: DataFrame, right: DataFrame, group: list[str]) -> Column:
    condition = F.lit(True)
    for name in group:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


@dataclass(frozen=True)
class Cuts:
    """Cut points of the hot groups: a small local table (group columns, bounds array)."""

    group: list[str]
    order: list[str]
    table: DataFrame
    longest: int

    def apply(self, df: DataFrame) -> DataFrame:
        """Add the slice number; groups that are not hot are one slice."""
        cuts = F.broadcast(self.table)
        point = F.struct(*[F.col(name) for name in self.order])
        rows = df.join(cuts, same_group(df, cuts, self.group), "left")
        rows = rows.select(*[df[name] for name in df.columns], "_bounds", point.alias("_point"), F.lit(0).alias(SLICE))
        # binary search for the number of bounds <= point; one projection per step keeps
        # the search in generated code, where a higher-order function would be interpreted
        step = 1 << max(0, self.longest.bit_length() - 1)
        while step and self.longest:
            reached = F.get("_bounds", F.col(SLICE) + (step - 1)) <= F.col("_point")
            rows = rows.withColumn(SLICE, F.col(SLICE) + F.when(reached, step).otherwise(0))
            step //= 2
        return rows.drop("_bounds", "_point")

    def only_hot(self, df: DataFrame) -> DataFrame:
        cuts = F.broadcast(self.table)
        return df.join(cuts, same_group(df, cuts, self.group), "left_semi")

    def every_slice(self) -> DataFrame:
        """One row per (hot group, slice number)."""
        return self.table.select(
            *self.group, F.explode(F.sequence(F.lit(0), F.size("_bounds"))).alias(SLICE)
        )


def cut_groups(df: DataFrame, group: list[str], order: list[str], hot: list[Row], slice_rows: int) -> Cuts:
    """Sample the ``hot`` groups (their count is bounded by the caller) and choose cut points."""
    spark = df.sparkSession
    fields = {f.name: T.StructField(f.name, f.dataType) for f in df.schema}
    keys = T.StructType([fields[name] for name in group])
    hot_table = F.broadcast(spark.createDataFrame([tuple(row[name] for name in group) for row in hot], keys))
    fraction = min(1.0, _SAMPLES / slice_rows)
    # a bounded sample, so its lists are bounded; sorted by Spark's own order
    sample = (
        df.join(hot_table, same_group(df, hot_table, group), "left_semi")
        .select(*group, *order)
        .sample(fraction=fraction, seed=7)
        .groupBy(*group)
        .agg(F.sort_array(F.collect_list(F.struct(*order))).alias("_points"))
        .collect()
    )
    step = max(1, round(fraction * slice_rows))
    rows = []
    for row in sample:
        points = [tuple(point) for point in row["_points"]][step::step]
        rows.append((*(row[name] for name in group), list(dict.fromkeys(points))))
    point = T.StructType([fields[name] for name in order])
    schema = T.StructType([*keys.fields, T.StructField("_bounds", T.ArrayType(point))])
    longest = max((len(row[-1]) for row in rows), default=0)
    return Cuts(group, order, spark.createDataFrame(rows, schema), longest)


def find_cuts(
    df: DataFrame, group: list[str], order: list[str], slice_rows: int = SLICE_ROWS, largest: int | None = None
) -> Cuts | None:
    """Cut points of every group larger than one task should order; None if there is none.

    A known size of the ``largest`` group spares the count. At most MAX_SLICES groups
    are cut, the largest first; any left whole holds less than 1 / MAX_SLICES of the rows.
    """
    if largest is not None and largest <= slice_rows:
        return None
    size = F.count(F.lit(1)).alias("_n")
    sizes = df.groupBy(*group).agg(size).where(F.col("_n") > slice_rows)
    hot = sizes.orderBy(F.desc("_n")).limit(MAX_SLICES).collect()
    if not hot:
        return None
    limit = max(slice_rows, sum(row["_n"] for row in hot) // MAX_SLICES)
    return cut_groups(df, group, order, hot, limit)
