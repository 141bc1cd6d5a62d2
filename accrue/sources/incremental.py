"""A snapshot of a changing table, read chunk by chunk beside its change log."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.functions.timestamps import utc_literal

#: Log position and time (UTC), read from the database.
Position = Callable[[], tuple[int, datetime]]

_BRACKETS = "chunk long, low long, high long, read_at timestamp_ntz"


def merge_chunks(rows: DataFrame, log: DataFrame, brackets: DataFrame, key: list[str], seq: str = "seq") -> DataFrame:
    """Rows read chunk by chunk and the change log of the same table as one change log without overlap or gap.

    ``rows`` and ``log`` carry the ``chunk`` their key belongs to; ``brackets`` has a row per chunk: the log positions before
    (``low``) and after (``high``) it was read, and ``read_at``. What is committed in between may or may not have been seen:
    the log's changes in a bracket replace the rows read, changes up to its low position are in the rows already, and later
    ones follow. A row read is a version (op ``r``) that begins at ``read_at``, or with the first change of its key behind
    it, if the clock of the reader is ahead of the commit times.

    Chunks that have no bracket yet contribute nothing. Rows or changes without chunk are dropped with them; a key is in
    one chunk only.
    """
    position = F.col(seq)
    held = log.join(brackets.select("chunk", "low", "high"), "chunk").where(position > F.col("low"))
    inside = held.where(position <= F.col("high")).select("chunk", *key).distinct()
    following = held.where(position > F.col("high")).groupBy("chunk", *key).agg(F.min("op_ts").alias("_next"))
    read = rows.join(inside, ["chunk", *key], "left_anti").join(following, ["chunk", *key], "left").join(brackets, "chunk")
    read = read.withColumns({"op": F.lit("r"), "op_ts": F.least("read_at", "_next"), seq: F.col("high")})
    columns = [c for c in log.columns if c != "chunk"]
    return read.select(*columns).unionByName(held.select(*columns))


class ChunkedSnapshot:
    """Chunks of a table below ``folder``, each with its bracket of log positions; goes on where it stopped."""

    def __init__(self, spark: SparkSession, folder: str, row: T.StructType, key: list[str]):
        self.spark, self.folder, self.row, self.key = spark, folder, row, key

    def _read(self, name: str, schema: T.StructType | str) -> DataFrame:
        empty = self.spark.createDataFrame([], schema)
        # the folder is there from the first chunk on
        empty.write.mode("append").parquet(f"{self.folder}/{name}/none")
        return self.spark.read.schema(empty.schema).option("recursiveFileLookup", "true").parquet(f"{self.folder}/{name}")

    def brackets(self) -> DataFrame:
        return self._read("brackets", _BRACKETS)

    def missing(self, chunks: range) -> list[int]:
        """The chunks not taken yet, in order."""
        taken = {r.chunk for r in self.brackets().select("chunk").collect()}
        return [c for c in chunks if c not in taken]

    def take(self, chunk: int, rows: DataFrame, position: Position) -> None:
        """Read a chunk between two positions of the log.

        ``rows`` is read after the first position is known and before the second one is asked for. The bracket is written
        last: a chunk whose reading was broken off has none, and is replaced when it is read again.
        """
        low, _ = position()
        rows = rows.select(*self.row.fieldNames()).withColumn("chunk", F.lit(chunk).cast("long"))
        rows.write.mode("overwrite").parquet(f"{self.folder}/rows/chunk-{chunk}")
        high, at = position()
        if high < low:
            raise ValueError(f"the log position went back from {low} to {high} while chunk {chunk} was read")
        bracket = self.spark.range(1).select(
            F.lit(chunk).cast("long").alias("chunk"), F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high"),
            utc_literal(at).alias("read_at"),
        )
        bracket.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/brackets/chunk-{chunk}")

    def changes(self, log: DataFrame, chunk: Column) -> DataFrame:
        """The chunks taken so far and the log of their keys, as one change log; ``chunk`` is computed from a log row's key."""
        schema = T.StructType([*self.row.fields, T.StructField("chunk", T.LongType())])
        rows = self._read("rows", schema)
        return merge_chunks(rows, log.withColumn("chunk", chunk.cast("long")), self.brackets(), self.key)
