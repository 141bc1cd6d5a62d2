"""Landed change files. The readers declare the schema and work for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from accrue.sources.changelog import decode_changes
from accrue.sources.schemas import CHANGES, FACTS, MERCHANT


def _reader(spark: SparkSession, stream: bool):
    return spark.readStream if stream else spark.read


def read_facts(
    spark: SparkSession, path: str, schema: T.StructType = FACTS, format: str = "parquet", stream: bool = False
) -> DataFrame:
    """Append-only facts."""
    return _reader(spark, stream).schema(schema).format(format).load(path)


def read_changelog(
    spark: SparkSession, path: str, schema: T.StructType = CHANGES, format: str = "parquet", stream: bool = False
) -> DataFrame:
    """A decoded dimension change log."""
    return _reader(spark, stream).schema(schema).format(format).load(path)


def read_change_records(
    spark: SparkSession, path: str, row: T.StructType = MERCHANT, key: tuple[str, ...] = ("cuit",), stream: bool = False
) -> DataFrame:
    """JSON change records, one per line, decoded."""
    return decode_changes(_reader(spark, stream).format("text").load(path), row, list(key))
