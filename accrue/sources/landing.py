"""Landing a bounded input as change files, wave by wave, for runs and tests of the stream."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fan_out(transactions: DataFrame, lines: list[dict[str, object]], schema: T.StructType) -> DataFrame:
    """Every transaction with every line of a fixed list: fixture rows of one transaction each."""
    rows = [F.struct(*[F.lit(line[f.name]).cast(f.dataType).alias(f.name) for f in schema]) for line in lines]
    return transactions.select("*", F.inline(F.array(*rows)))


def land_in_waves(facts: DataFrame, folder: str, waves: int, arrival: str) -> Iterator[int]:
    """Append the facts to ``folder`` in ``waves`` steps of their arrival, yielding after each.

    All rows are landed; a wave holds an equal span of arrival, not an equal count.
    """
    first, last = facts.agg(F.min(arrival), F.max(arrival)).first()
    span = (last - first) // waves + 1
    for wave in range(waves):
        low = first + wave * span
        facts.where((F.col(arrival) >= low) & (F.col(arrival) < low + span)).write.mode("append").parquet(folder)
        yield wave
