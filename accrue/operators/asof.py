"""Event-time as-of join: each fact with the dimension version valid at its time."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from accrue.functions.timestamps import to_utc, utc_column
from accrue.operators.intervals import DELETE, checked_log, to_intervals
from accrue.operators.slices import SLICE, SLICE_ROWS, find_cuts

BROADCAST_BYTES = 128 * 1024 * 1024
VERSIONS_PER_KEY = 64

VERSION = "version_from"


@dataclass(frozen=True)
class LogSize:
    """Measured size of a change log."""

    largest: int  # most versions of one key
    bytes: int  # upper estimate in memory, attributes included
    gaps: bool = False  # whether some version has NULL in an attribute

    def fits_broadcast(self, limit: int = BROADCAST_BYTES) -> bool:
        return self.bytes <= limit

    def fits_probe(self, limit: int = BROADCAST_BYTES, versions: int = VERSIONS_PER_KEY) -> bool:
        """A probe by key alone visits every version of the key, so their number counts too."""
        return self.fits_broadcast(limit) and self.largest <= versions


def measure(log: DataFrame, on: list[str], attributes: list[str], op: str = "op") -> LogSize:
    """One narrow aggregation over the change log."""
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in [*on, *attributes]]
    row_bytes = reduce(lambda a, b: a + b, texts) + F.lit(64 + 16 * len(texts))
    gap = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in attributes], F.lit(False)) & (F.col(op) != DELETE)
    sizes = log.groupBy(*on).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).alias("b"), F.count_if(gap).alias("gaps"))
    largest, size, gaps = sizes.agg(F.max("n"), F.sum("b"), F.sum("gaps")).first()
    return LogSize(largest or 0, size or 0, bool(gaps))


def asof_join(
    facts: DataFrame,
    log: DataFrame,
    on: list[str],
    attributes: list[str],
    event_time: str = "created_at",
    time: str = "op_ts",
    seq: str = "seq",
    op: str = "op",
    strategy: str = "auto",
    broadcast_bytes: int = BROADCAST_BYTES,
    versions_per_key: int = VERSIONS_PER_KEY,
    slice_rows: int = SLICE_ROWS,
    size: LogSize | None = None,
    gauge: DataFrame | None = None,
    shuffle: bool = False,
) -> DataFrame:
    """LEFT join to the last change with ``time <= event_time`` of the same key.

    Adds ``attributes`` and ``version_from``, the time the joined version began;
    all are NULL before the first version, after a delete and for unknown keys. A
    fact without key or time finds nothing; a change without key, time or ``seq``
    raises. Both strategies give the same rows.

    ``interval`` broadcasts validity intervals and raises when their measured size
    does not allow it; with ``shuffle`` it goes on through the shuffle: intervals are joined by key, or, where a key has
    more versions than a probe should visit, as ``union`` does. ``union`` sorts facts and changes together by key and time and cuts
    hot keys into slices. ``auto`` takes the first where it can broadcast. ``size``
    is the log's :func:`measure`, if already taken. ``gauge`` may stand in for the
    facts where hot keys are looked for, a cheaper plan with much the same rows.
    """
    if strategy not in ("auto", "interval", "union"):
        raise ValueError(f"strategy must be 'auto', 'interval' or 'union', got {strategy!r}")
    if strategy != "union" and size is None:
        size = measure(log, on, attributes, op)
    small = strategy != "union" and size.fits_probe(broadcast_bytes, versions_per_key)
    by_key = strategy == "interval" and shuffle and size.largest <= versions_per_key
    if strategy == "interval" and not small and not shuffle:
        raise ValueError(f"the change log does not fit strategy 'interval': {size.bytes} bytes, {size.largest} versions of one key")
    if small or by_key:
        intervals = to_intervals(log, on, attributes, time, seq, op, slice_rows, size.largest)
        return _interval_join(facts, F.broadcast(intervals) if small else intervals, on, attributes, event_time)
    gauge = facts if gauge is None else gauge
    return _union_join(facts, log, on, attributes, event_time, time, seq, op, slice_rows, gauge)


def _interval_join(
    facts: DataFrame, intervals: DataFrame, on: list[str], attributes: list[str], event_time: str
) -> DataFrame:
    at = utc_column(facts[event_time], facts.schema[event_time].dataType)
    begun = intervals["valid_from"] <= at
    in_force = intervals["valid_to"].isNull() | (at < intervals["valid_to"])
    same = [facts[c] == intervals[c] for c in on]
    return facts.join(intervals, [*same, begun, in_force], "left").select(
        *[facts[c] for c in facts.columns],
        *[intervals[c] for c in attributes],
        intervals["valid_from"].alias(VERSION),
    )


def _union_join(
    facts: DataFrame,
    log: DataFrame,
    on: list[str],
    attributes: list[str],
    event_time: str,
    time: str,
    seq: str,
    op: str,
    slice_rows: int,
    gauge: DataFrame,
) -> DataFrame:
    # a deleted version stays a (non-null) struct, so it is not skipped as a missing one
    version = F.struct(F.col(op).alias("op"), F.col(time).alias("since"), *attributes)
    changes = checked_log(to_utc(log, time), on, time, seq).select(
        *on, F.col(time).alias("_t"), F.lit(0).alias("_side"), F.col(seq).cast("bigint").alias("_seq"),
        version.alias("_version"),
    )

    def placed(facts: DataFrame, *columns: str) -> DataFrame:
        # after the changes of its time any order of facts will do; a hash lets many facts of one instant be cut apart
        at = utc_column(F.col(event_time), facts.schema[event_time].dataType)
        return facts.select(*columns, at.alias("_t"), F.lit(1).alias("_side"), F.xxhash64(*facts.columns).alias("_seq"))

    order = ["_t", "_side", "_seq"]
    keys = list(on)
    rows = placed(facts, "*").unionByName(changes, allowMissingColumns=True)
    cuts = find_cuts(placed(gauge, *on).unionByName(changes.select(*on, *order)), on, order, slice_rows)
    if cuts is not None:
        keys.append(SLICE)
        # the last version before each slice joins the slice as one more row
        lasts = cuts.only_hot(cuts.apply(changes)).groupBy(*keys).agg(
            F.max_by(F.struct(*order, "_version"), F.struct(*order)).alias("_last")
        )
        before = W.partitionBy(*on).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
        carried = (
            cuts.every_slice()
            .join(lasts, keys, "left")
            .select(*keys, F.last("_last", ignorenulls=True).over(before).alias("_last"))
            .where(F.col("_last").isNotNull())
            .select(*keys, "_last.*")
        )
        rows = cuts.apply(rows).unionByName(carried, allowMissingColumns=True)

    newest = F.last("_version", ignorenulls=True).over(
        W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    alive = F.col("_found.op") != DELETE
    return (
        rows.withColumn("_found", newest)
        .where(F.col("_side") == 1)
        .select(
            *facts.columns,
            *[F.when(alive, F.col(f"_found.{c}")).alias(c) for c in attributes],
            F.when(alive, F.col("_found.since")).alias(VERSION),
        )
    )
