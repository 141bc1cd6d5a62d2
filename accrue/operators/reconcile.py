"""Comparing two large tables that should be alike, without joining what is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.operators.quality import differences

#: Buckets of the first and, inside a bucket that differs, of the second level.
BUCKETS = 4096
_LOW = 0xFFFFFFFF
_SUMS = ["rows", "low_a", "high_a", "low_b", "high_b"]


def _common(left: T.DataType, right: T.DataType, name: str) -> T.DataType:
    if isinstance(left, T.DecimalType) and isinstance(right, T.DecimalType):
        scale = max(left.scale, right.scale)
        digits = max(left.precision - left.scale, right.precision - right.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    elif left == right:
        return left
    raise TypeError(f"column {name} is {left.simpleString()} and {right.simpleString()}")


def _alike(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with the columns of the left one, decimals of one type, so that equal values hash alike."""
    kinds = {f.name: _common(f.dataType, right.schema[f.name].dataType, f.name) for f in left.schema}

    def of(df: DataFrame) -> DataFrame:
        columns = {c: F.col(c).cast(t) for c, t in kinds.items()}
        # 0.0 and -0.0 are equal
        floats = {c: columns[c] + F.lit(0.0).cast(t) for c, t in kinds.items() if isinstance(t, (T.FloatType, T.DoubleType))}
        return df.select(*[(floats.get(c, e)).alias(c) for c, e in columns.items()])

    return of(left), of(right)


def _hash(columns: list[str], seed: int) -> Column:
    """64 bits over values and over which of them are NULL (a NULL alone leaves a hash as it is)."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *parts)


def bucket_sums(df: DataFrame, bucket: list[Column], columns: list[str]) -> DataFrame:
    """Per bucket: rows, and the sums of two 64-bit hashes of the columns, each in two halves.

    Sums do not depend on the order of rows, and the halves do not overflow below 2**31 rows a bucket.
    """
    hashed = df.select(*bucket, _hash(columns, 1).alias("_a"), _hash(columns, 2).alias("_b"))
    halves = {
        "low_a": F.col("_a").bitwiseAND(F.lit(_LOW)), "high_a": F.shiftrightunsigned("_a", 32),
        "low_b": F.col("_b").bitwiseAND(F.lit(_LOW)), "high_b": F.shiftrightunsigned("_b", 32),
    }
    names = [c for c in hashed.columns if c not in ("_a", "_b")]
    return hashed.groupBy(*names).agg(F.count("*").alias("rows"), *[F.sum(e).alias(n) for n, e in halves.items()])


def _differing(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """The buckets whose sums differ, or that one side lacks."""
    sides = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    gap = reduce(lambda x, y: x | y, [F.sum(F.col(c) * F.col("_side")) != 0 for c in _SUMS])
    return sides.groupBy(*names).agg(gap.alias("_gap")).where("_gap").select(*names)


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys with ``status`` only_left / only_right / changed, as :func:`differences` finds them.

    Each table is summed up by buckets of its key's hash. Where all sums agree that is all; otherwise the buckets that differ
    are summed up again by finer ones, and only rows of the finer ones that differ are compared. At most ``buckets``
    numbers reach the driver. Two tables that differ pass as equal only where sums of 128 bits collide.

    The keys are unique in each table, NULLs included as values. Columns are those of ``left``; the types are equal, but
    for decimals, which are compared by value. The tables are read up to three times, so expensive ones should be written
    first.
    """
    left, right = _alike(left, right)
    columns, spread = left.columns, _hash(keys, 3)
    first = F.pmod(spread, F.lit(buckets)).alias("_first")
    second = F.pmod(F.floor(spread / buckets), F.lit(buckets)).alias("_second")
    coarse = _differing(bucket_sums(left, [first], columns), bucket_sums(right, [first], columns), ["_first"])
    found = [r[0] for r in coarse.collect()]  # at most `buckets`
    if not found:
        return differences(left.limit(0), right.limit(0), keys)
    rows = [df.withColumns({"_first": first, "_second": second}) for df in (left, right)]
    if len(found) < buckets:
        rows = [df.where(F.col("_first").isin(found)) for df in rows]
    fine = ["_first", "_second"]
    apart = _differing(*[bucket_sums(df, [F.col(c) for c in fine], columns) for df in rows], fine)
    left, right = (df.join(apart, fine, "left_semi").select(*columns) for df in rows)
    return differences(left, right, keys)
