"""A keyed Parquet target for upserts, where no table format is at hand.

An upsert writes only its own rows, as one more folder, and then a version record
that lists the folders in force; readers take the last row per key. Small folders are
merged into larger ones by levels. Versions carry a token: writing the same token
again replaces that version, so a replayed micro-batch changes nothing.

Rows lie sorted by key, with a Bloom filter for keys that are texts or integers, so
a filter on leading key columns reads the pages, and one on any such column the row
groups, that can hold it.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.operators.intervals import DELETE
from accrue.operators.keyed import latest_per_key
from accrue.streaming.files import Records

BUCKETS = 32

_PART, _GONE, _AGE = "_part", "_gone", "_age"


class KeyedTable:
    """``partition`` is a SQL expression over key columns, by which reads can be pruned; else keys are hashed into buckets."""

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], partition: str | None = None, merge_every: int = 8
    ):
        if merge_every < 2:
            raise ValueError("merge_every must be at least 2")
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.partition, self.merge_every = partition or f"pmod(hash({', '.join(keys)}), {BUCKETS})", merge_every
        self._versions = Records(spark, f"{self.path}/versions")

    def _head(self) -> dict | None:
        last = self._versions.last()
        return None if last is None else self._versions.get(last)

    def _folders(self, head: dict | None, before: str | None) -> list[list]:
        """[folder, level] from the oldest to the newest."""
        if head is None:
            return []
        return head["parent"] if before is not None and head["token"] == before else head["folders"]

    def _latest(
        self, schema: T.StructType, folders: list[list], parts: list[str] | None = None, only: DataFrame | None = None
    ) -> DataFrame:
        """The last row per key, deleted ones included."""
        hidden = [(_GONE, T.BooleanType()), (_AGE, T.LongType()), ("_folder", T.StringType()), (_PART, T.StringType())]
        stored = T.StructType([*schema.fields, *[T.StructField(name, kind) for name, kind in hidden]])
        paths = [f"{self.path}/rows/_folder={folder}" for folder, _ in folders]
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/rows").parquet(*paths)
        if parts is not None:
            rows = rows.where(F.col(_PART).isin(parts))
        if only is not None:
            only = only.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(self.keys)])
            same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(self.keys)]
            rows = rows.join(only, reduce(lambda a, b: a & b, same), "left_semi")
        rows = rows.select(*schema.names, _GONE, _AGE)
        return latest_per_key(rows, self.keys, [_AGE]) if len(folders) > 1 else rows

    def _current(self, schema: T.StructType, folders: list[list], *pruning) -> DataFrame:
        return self._latest(schema, folders, *pruning).where(~F.col(_GONE)).select(*schema.names)

    def read(
        self, parts: list[str] | None = None, only: DataFrame | None = None, before: str | None = None
    ) -> DataFrame | None:
        """Current rows, None before the first upsert.

        ``parts`` keeps some partition values, ``only`` the keys of another
        DataFrame; ``before`` leaves out the version of that token.
        """
        head = self._head()
        folders = self._folders(head, before)
        if not folders:
            return None
        return self._current(T.StructType.fromJson(json.loads(head["schema"])), folders, parts, only)

    def upsert(self, delta: DataFrame, token: str, unique: bool = False) -> DataFrame:
        """Add or replace the delta's rows, one per key, with the table's columns. Returns the written rows.

        Several rows of one key, or other columns than the table's, raise; ``unique`` says that keys are known to differ.
        """
        twice = not unique and delta.groupBy(*self.keys).count().where("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"several rows of one key: {twice[0].asDict()}")
        return self._put(delta.withColumn(_GONE, F.lit(False)), token)

    def apply_changes(self, changes: DataFrame, token: str, order: list[str], op: str = "op") -> DataFrame:
        """Upserts and deletes (``op = 'd'``), the last change per key by ``order``."""
        head = self._head()
        columns = [c for c in changes.columns if c != op]
        if head is not None:
            columns = T.StructType.fromJson(json.loads(head["schema"])).names
        last = latest_per_key(changes, self.keys, order)
        return self._put(last.select(*columns, (F.col(op) == DELETE).alias(_GONE)), token)

    def _put(self, rows: DataFrame, token: str) -> DataFrame:
        head = self._head()
        number = 0 if head is None else head["number"] + 1
        schema = rows.drop(_GONE).schema
        if head is not None and set(schema.names) != set(T.StructType.fromJson(json.loads(head["schema"])).names):
            raise ValueError(f"the table has other columns than {schema.names}")
        parent = self._folders(head, token)
        new = [self._write(rows.withColumn(_AGE, F.lit(number).cast("bigint"))), 0]
        folders = [*parent, new]
        # as many folders of one level become one of the next, so a row is rewritten
        # once per level and not with every merge
        while len({level for _, level in folders[-self.merge_every:]}) == 1 and len(folders) >= self.merge_every:
            run, folders = folders[-self.merge_every:], folders[: -self.merge_every]
            folders.append([self._write(self._latest(schema, run)), run[0][1] + 1])
        record = {"number": number, "token": token, "folders": folders, "parent": parent, "schema": schema.json()}
        self._versions.put(number, record)
        return self._current(schema, [new])

    def _write(self, rows: DataFrame) -> str:
        folder = uuid.uuid4().hex
        rows = rows.withColumn(_PART, F.expr(self.partition).cast("string"))
        # few files per part, and a large part still split over tasks; sorted, so that a key is in few pages of a file
        rows = rows.hint("rebalance", _PART).sortWithinPartitions(_PART, *self.keys)
        writer = rows.write.partitionBy(_PART).option("parquet.bloom.filter.adaptive.enabled", "true")
        for key in self.keys:
            if isinstance(rows.schema[key].dataType, (T.StringType, T.IntegerType, T.LongType)):
                writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.parquet(f"{self.path}/rows/_folder={folder}")
        return folder

    def vacuum(self) -> None:
        """Delete row folders the newest version does not need. No older version may be in use."""
        head = self._head() or {"folders": [], "parent": []}
        needed = {folder for folder, _ in [*head["folders"], *head["parent"]]}
        rows = Records(self.spark, f"{self.path}/rows")
        for name in rows.names():
            if name.startswith("_folder=") and name.removeprefix("_folder=") not in needed:
                rows.delete(name)


def merge_into(delta: DataFrame, table: str, keys: list[str]) -> None:
    """The same upsert on a table of a catalog that supports MERGE (Delta, Iceberg, ...)."""
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"{table}.{key}").eqNullSafe(F.col(f"delta.{key}"))
    delta.alias("delta").mergeInto(table, same).whenMatched().updateAll().whenNotMatched().insertAll().merge()
