"""Landed Parquet records as a stream with offsets: a snapshot first, then a log by its positions, so many rows a batch.

The folder of the log holds records of growing integer positions. An offset says how many row groups of the snapshot are
taken and up to which position the log is; a batch takes whole row groups of the snapshot, or all records of a range of
positions. The driver reads file names and footers only; the records are read by tasks, one row group each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from accrue.sources.ship import send_library

LIMIT = 10_000_000  # rows a batch
_FOOTERS_AT_ONCE = 32
_ROWS_AT_ONCE = 10_000


class LandedBehind(RuntimeError):
    """What the folders hold does not continue what was read: taking it as it is would lose records or count them twice."""


@dataclass
class RowGroup(InputPartition):
    """A row group and which of its positions are meant: above ``above``, up to ``up_to``; all where there are none."""

    path: str
    number: int
    rows: int
    low: int | None = None
    high: int | None = None
    above: int | None = None
    up_to: int | None = None


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


class _Folder:
    """The row groups of a folder's Parquet files; a file's footer is read once."""

    def __init__(self, uri: str, position: str | None):
        self.files, self.root = _opened(uri.rstrip("/"))
        self.position = position
        self._known: dict[str, list[RowGroup]] = {}

    def _names(self) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(self.root, allow_not_found=True, recursive=True))
        inside = [(f.path, f.path[len(self.root) :].strip("/").split("/")) for f in found if f.is_file]
        return sorted(p for p, parts in inside if p.endswith(".parquet") and not any(x[0] in "_." for x in parts))

    def _footer(self, path: str) -> list[RowGroup]:
        with self.files.open_input_file(path) as file:
            meta = pq.ParquetFile(file).metadata
        groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
        if self.position is None:
            return [RowGroup(path, i, g.num_rows) for i, g in enumerate(groups) if g.num_rows]
        names = [meta.schema.column(i).path for i in range(meta.num_columns)]
        if self.position not in names:
            raise ValueError(f"{path} has no column {self.position}")
        column, out = names.index(self.position), []
        for i, g in enumerate(groups):
            if not g.num_rows:
                continue
            told = g.column(column).statistics
            if told is None or not told.has_min_max or told.null_count:
                raise LandedBehind(f"{path} holds records without {self.position}, or no statistics of it")
            if not isinstance(told.min, int):
                raise TypeError(f"{self.position} is not an integer in {path}")
            out.append(RowGroup(path, i, g.num_rows, told.min, told.max))
        return out

    def groups(self) -> list[RowGroup]:
        """All row groups there are now, by file name."""
        names = self._names()
        new = [n for n in names if n not in self._known]
        with ThreadPoolExecutor(_FOOTERS_AT_ONCE) as pool:
            self._known.update(zip(new, pool.map(self._footer, new)))
        return [g for n in names for g in self._known[n]]


class LandedReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        missing = [o for o in ("path", "position") if not options.get(o)]
        if missing:
            raise ValueError(f"the option {missing[0]} is required")
        self.schema, self.position = schema, options["position"]
        self.limit = int(options.get("limit", LIMIT))
        if self.limit < 1:
            raise ValueError("limit must be at least 1")
        self.log_uri, self.snapshot_uri = options["path"], options.get("snapshot")
        self.log = _Folder(self.log_uri, self.position)
        self.snapshot = _Folder(self.snapshot_uri, None) if self.snapshot_uri else None
        self._at: dict | None = None

    def initialOffset(self) -> dict:
        return {"snapshot": 0, "of": None, "position": None, "rows": 0}

    def _snapshot_groups(self, at: dict) -> tuple[list[RowGroup], int | None]:
        """The snapshot's row groups and a number that tells this list from another."""
        if self.snapshot is None:
            return [], None
        groups = self.snapshot.groups()
        told = zlib.crc32(repr([(g.path, g.number, g.rows) for g in groups]).encode())
        if at["snapshot"] and at["of"] != told:
            raise LandedBehind(f"the snapshot {self.snapshot_uri} has changed since it was begun")
        return groups, told

    def _log_groups(self, at: dict) -> list[RowGroup]:
        groups = self.log.groups()
        if at["position"] is not None and _rows_up_to(groups, at["position"]) != at["rows"]:
            raise LandedBehind(
                f"{self.log_uri} holds other records up to {self.position} {at['position']} than when that was reached"
            )
        return groups

    def latestOffset(self) -> dict:
        at = self._at or self.initialOffset()
        snapshot, told = self._snapshot_groups(at)
        log, left = self._log_groups(at), self.limit
        taken, position = at["snapshot"], at["position"]
        while taken < len(snapshot) and left > 0:
            left -= snapshot[taken].rows
            taken += 1
        if taken == len(snapshot):
            for g in sorted(log, key=lambda g: g.high):
                if left <= 0:
                    break
                if position is None or g.high > position:
                    position, left = g.high, left - g.rows
        rows = 0 if position is None else _rows_up_to(log, position)
        return {"snapshot": taken, "of": told if taken else None, "position": position, "rows": rows}

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        # after a restart Spark asks for the empty range behind the last offset it knows: from there it goes on
        self._at = end
        if start == end:
            return []
        snapshot, _ = self._snapshot_groups(end)
        out = snapshot[start["snapshot"] : end["snapshot"]]
        if end["position"] != start["position"]:
            above, up_to = start["position"], end["position"]
            for g in self._log_groups(end):
                if g.low <= up_to and (above is None or g.high > above):
                    out.append(RowGroup(g.path, g.number, g.rows, g.low, g.high, above, up_to))
        return out

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        ranged = partition.up_to is not None
        files, _ = _opened((self.log_uri if ranged else self.snapshot_uri).rstrip("/"))
        names = self.schema.names
        columns = list(dict.fromkeys([*names, self.position])) if ranged else names
        with files.open_input_file(partition.path) as file:
            parquet = pq.ParquetFile(file)
            absent = [c for c in columns if c not in parquet.schema_arrow.names]
            if absent:
                raise ValueError(f"{partition.path} has no column {absent[0]}")
            for batch in parquet.iter_batches(_ROWS_AT_ONCE, row_groups=[partition.number], columns=columns):
                if ranged:
                    at = batch.column(batch.schema.get_field_index(self.position))
                    wanted = pc.less_equal(at, partition.up_to)
                    if partition.above is not None:
                        wanted = pc.and_(wanted, pc.greater(at, partition.above))
                    batch = batch.filter(wanted)
                if batch.num_rows:
                    yield batch.select(names)

    def commit(self, end: dict) -> None:
        pass


def _rows_up_to(groups: list[RowGroup], position: int) -> int:
    """Rows of the row groups that begin at or before a position: another number tells of files landed there later."""
    return sum(g.rows for g in groups if g.low <= position)


class Landed(DataSource):
    """Options: ``path`` of the log, ``position`` (its integer column), ``snapshot`` (a folder), ``limit`` (rows a batch)."""

    @classmethod
    def name(cls) -> str:
        return "landed"

    def schema(self) -> T.StructType:
        raise ValueError("state the schema; nothing is inferred from data")

    def streamReader(self, schema: T.StructType) -> LandedReader:
        return LandedReader(dict(self.options), schema)


def read_landed(
    spark: SparkSession, path: str, schema: T.StructType, position: str, snapshot: str | None = None, limit: int = LIMIT
) -> DataFrame:
    """Stream of landed Parquet records: all of the folder ``snapshot`` first, then those of ``path`` by ``position``.

    A batch takes about ``limit`` rows: row groups are added until they have as many, so it is at least one row group, and
    records of one position are never parted. Small row groups in the order of the positions keep a batch near its limit.
    With ``availableNow`` a run takes one batch; with a processing time it goes on until all is read.

    Within the snapshot no order is promised. The snapshot is whole before the stream begins, and no file leaves or changes.
    Files that land later hold later positions only; otherwise ``LandedBehind`` is raised, as it is for records without a
    position, instead of losing records. Folders that do not exist yet hold nothing. Folders are opened by pyarrow: local
    and mounted ones, and those of the stores it knows.
    """
    send_library(spark)
    spark.dataSource.register(Landed)
    reader = spark.readStream.format("landed").schema(schema).option("position", position).option("limit", limit)
    if snapshot:
        reader = reader.option("snapshot", snapshot)
    return reader.load(path)
