"""Change log -> validity intervals ``[valid_from, valid_to)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from accrue.functions.timestamps import to_utc
from accrue.operators.slices import SLICE, SLICE_ROWS, find_cuts

DELETE = "d"


def checked_log(log: DataFrame, on: list[str], time: str, seq: str) -> DataFrame:
    """The change log, raising at a change without key, time or position: its place in history would be chance."""
    complete = F.lit(True)
    for name in [*on, time, seq]:
        complete = complete & F.col(name).isNotNull()
    complaint = F.raise_error(F.lit(f"a change without {', '.join([*on, time])} or {seq}"))
    key = on[0]
    return log.withColumn(key, F.when(complete, F.col(key)).otherwise(complaint.cast(log.schema[key].dataType)))


def to_intervals(
    log: DataFrame,
    on: list[str],
    attributes: list[str],
    time: str = "op_ts",
    seq: str = "seq",
    op: str = "op",
    slice_rows: int = SLICE_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Versions of each key with the time they hold; a delete only ends the version before it.

    Of several changes at one time the last by ``seq`` holds. ``valid_to`` is NULL
    for a version still in force. (key, valid_from) identifies a row. ``largest``
    is the most versions of one key, if known. A change without key, time or
    ``seq`` raises.
    """
    changes = checked_log(to_utc(log, time), on, time, seq).select(*on, time, seq, op, *attributes)
    cuts = find_cuts(changes, on, [time, seq], slice_rows, largest)
    following = F.lead(time)
    if cuts is None:
        valid_to = following.over(W.partitionBy(*on).orderBy(time, seq))
        versions = changes.withColumn("valid_to", valid_to)
    else:
        sliced = cuts.apply(changes)
        # first change of each slice, so the last row of the slice before it finds its end;
        # only slices of hot groups, whose number is bounded
        firsts = cuts.only_hot(sliced).groupBy(*on, SLICE).agg(F.min(time).alias("_first"))
        after = F.lead("_first").over(W.partitionBy(*on).orderBy(SLICE))
        firsts = F.broadcast(firsts.withColumn("_after", after).select(*on, SLICE, "_after"))
        within = following.over(W.partitionBy(*on, SLICE).orderBy(time, seq))
        versions = (
            sliced.withColumn("_within", within)
            .join(firsts, [*on, SLICE], "left")
            .withColumn("valid_to", F.coalesce("_within", "_after"))
        )
    holds = F.col("valid_to").isNull() | (F.col(time) < F.col("valid_to"))
    return versions.where(holds & (F.col(op) != DELETE)).select(
        *on, *attributes, F.col(time).alias("valid_from"), "valid_to"
    )
