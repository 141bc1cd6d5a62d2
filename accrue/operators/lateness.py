"""Late arrivals: rows more than ``delay`` behind the newest event time seen before them.

The rule orders all rows by arrival, which must not become one sort in one task.
Arrival is cut into at most ``MAX_BUCKETS`` ranges; one cheap aggregation gives
each range's newest and oldest event time, the running maximum over that bounded
table is carried on the driver, and only ranges that may hold a late row order
their rows, each range by itself. Input that arrives nearly in order is not
shuffled at all. A range with very many rows is cut further.
"""

from __future__ import annotations

from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.functions.timestamps import seconds_interval, utc_column
from accrue.operators.slices import MAX_SLICES, SLICE, SLICE_ROWS, cut_groups

MAX_BUCKETS = 2**20  # 32 MB of summary; a month in ranges of under 3 s
BUCKET_ROWS = 1_024  # fewer ranges for few rows
LATE = "_late"


def _ascending_number(df: DataFrame, name: str) -> Column:
    """A bigint that never falls when the column rises."""
    data_type, column = df.schema[name].dataType, F.col(name)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_timestamp(column)
    if isinstance(data_type, T.DateType):
        return F.unix_date(column).cast("bigint")
    return F.floor(column).cast("bigint")


def newest_event(df: DataFrame, event_time: str) -> datetime | None:
    """Newest event time as a UTC wall clock; None without rows."""
    return df.agg(F.max(utc_column(F.col(event_time), df.schema[event_time].dataType))).first()[0]


def watermark(df: DataFrame, event_time: str, delay: float) -> datetime | None:
    """Event time the rows have passed: the newest one minus ``delay`` seconds."""
    newest = newest_event(df, event_time)
    return None if newest is None else newest - timedelta(seconds=delay)


def mark_late(
    df: DataFrame,
    event_time: str,
    arrival: list[str],
    delay: float,
    seen: datetime | None = None,
    max_buckets: int = MAX_BUCKETS,
    bucket_rows: int = BUCKET_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add the boolean ``_late``.

    ``arrival`` names the columns whose order is the order of arrival and must
    identify a row; ``seen`` is the newest event time (UTC) before the first row.
    A row exactly ``delay`` seconds behind is on time; one without event time is late.
    The rows are read more than once; those of an arrival range that an earlier pass
    did not see raise.
    """
    rows = df.withColumn("_t", utc_column(F.col(event_time), df.schema[event_time].dataType))
    number = _ascending_number(df, arrival[0])
    first, last, total = rows.agg(F.min(number), F.max(number), F.count(F.lit(1))).first()
    buckets = max(1, min(max_buckets, total // bucket_rows))
    width = 1 if first is None else (last - first) // buckets + 1
    steps = F.call_function("div", number - F.lit(first or 0), F.lit(width))
    rows = rows.withColumn("_bucket", F.coalesce(steps, F.lit(-1)).cast("bigint"))

    def summarise(part: DataFrame, slice_number: Column, *keys: str) -> pd.DataFrame:
        newest, oldest = F.max("_t").alias("newest"), F.min("_t").alias("oldest")
        found = part.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), newest, oldest)
        columns = ["_bucket", slice_number.alias(SLICE), "n", "newest", "oldest"]
        return found.select(*columns).toArrow().to_pandas()

    ranges = summarise(rows, F.lit(0), "_bucket")  # at most max_buckets + 2 rows
    limit = max(slice_rows, total // MAX_SLICES)
    hot = ranges[ranges["n"] > limit]
    keys = ["_bucket"]
    if len(hot):
        keys.append(SLICE)
        cuts = cut_groups(rows, ["_bucket"], arrival, [Row(_bucket=int(b)) for b in hot["_bucket"]], limit)
        rows = cuts.apply(rows)
        cut_ranges = summarise(cuts.only_hot(rows), F.col(SLICE), *keys)
        ranges = pd.concat([ranges[ranges["n"] <= limit], cut_ranges])

    ranges = _carry(ranges.sort_values(["_bucket", SLICE]), seen, delay)
    unsure = ranges[ranges["unsure"]]
    if not len(unsure):
        return df.withColumn(LATE, F.col(event_time).isNull())
    if 2 * unsure["n"].sum() > ranges["n"].sum():
        unsure = ranges  # most rows need ordering: one pass over all beats a second scan

    schema = f"_bucket bigint, {SLICE} int, _carried timestamp_ntz, _unsure boolean"
    told = ranges.assign(_unsure=ranges["unsure"] | (len(unsure) == len(ranges)))[["_bucket", SLICE, "_carried", "_unsure"]]
    table = pa.Table.from_pandas(told, preserve_index=False)
    carry = F.broadcast(df.sparkSession.createDataFrame(table, schema))  # at most one row per range
    # a row of a range the first pass has not seen has no decision; it must not get lost
    moved = F.raise_error(F.lit("the input changed between two passes over it")).cast("boolean")
    rows = rows.join(carry.select(*keys, "_carried", "_unsure"), keys, "left").withColumn("_unsure", F.coalesce("_unsure", moved))
    order = W.partitionBy(*keys).orderBy(*arrival).rowsBetween(W.unboundedPreceding, W.currentRow)
    newest = F.greatest("_carried", F.max("_t").over(order))
    checked = rows.where("_unsure").withColumn(LATE, F.coalesce(F.col("_t") < newest - seconds_interval(delay), F.lit(True)))
    checked = checked.select(*df.columns, LATE)
    if len(unsure) == len(ranges):
        return checked
    settled = rows.where("NOT _unsure").withColumn(LATE, F.col("_t").isNull())
    return checked.unionByName(settled.select(*df.columns, LATE))


def _carry(ranges: pd.DataFrame, seen: datetime | None, delay: float) -> pd.DataFrame:
    """Add ``_carried``, the newest event time before each range, and whether it may hold a late row."""
    start = pd.Series([pd.NaT if seen is None else pd.Timestamp(seen)], dtype="datetime64[us]")
    reached = pd.concat([start, ranges["newest"].astype("datetime64[us]")], ignore_index=True).cummax().ffill()
    behind = ranges["oldest"].astype("datetime64[us]").to_numpy() < (
        reached[1:] - pd.Timedelta(seconds=delay)
    ).to_numpy()
    return ranges.assign(_carried=reached[:-1].to_numpy(), unsure=behind)


def drop_late(df: DataFrame, event_time: str, arrival: list[str], delay: float, **options) -> tuple[DataFrame, DataFrame]:
    """Split rows into (kept, late), see :func:`mark_late`."""
    marked = mark_late(df, event_time, arrival, delay, **options)
    return marked.where(~F.col(LATE)).drop(LATE), marked.where(LATE).drop(LATE)
