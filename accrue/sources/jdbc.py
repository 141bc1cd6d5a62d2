"""Databases over Spark's JDBC source and sink.

User and password go to Spark as options of their own, so they may hold any character. Host, port
and database name become part of the URL; what would end or extend that part is refused.
"""

from __future__ import annotations

import re
from ipaddress import AddressValueError, IPv6Address

from pyspark.sql import DataFrame, SparkSession

# What an unquoted identifier may consist of
_IDENTIFIER = re.compile(r"[A-Za-z0-9_]{1,63}")
_ENDS_A_HOST = set("/?#@:,[]%&;=\\")


def _url_host(host: str) -> str:
    """A name or address as the URL wants it; an IPv6 address goes in brackets."""
    bare = host[1:-1] if host.startswith("[") and host.endswith("]") else host
    try:
        return f"[{IPv6Address(bare)}]"
    except AddressValueError:
        pass
    if not host or len(host) > 253 or not host.isascii() or any(c in _ENDS_A_HOST or c in "'\"" or c <= " " or c == "\x7f" for c in host):
        raise ValueError(f"{host!r} is no host name or address")
    return host


def jdbc_options(host: str, port: str | int, user: str, password: str, database: str) -> dict[str, str]:
    """Options for ``spark.read/write.format('jdbc')`` on PostgreSQL."""
    for label, value in {"host": host, "user": user, "password": password, "database": database}.items():
        if not isinstance(value, str):
            raise ValueError(f"{label} must be text")
    number = str(port)
    if not (number.isascii() and number.isdigit() and len(number) <= 5 and 0 < int(number) < 1 << 16):
        raise ValueError(f"{port!r} is no port")
    if not user:
        raise ValueError("user is empty")
    if not _IDENTIFIER.fullmatch(database):
        raise ValueError(f"{database!r} is no plain database name")
    url = f"jdbc:postgresql://{_url_host(host)}:{number}/{database}"
    return {"url": url, "user": user, "password": password, "driver": "org.postgresql.Driver"}


def read_snapshot(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Snapshot of a table; with ``partition_column`` in parallel ranges (append-only facts).

    Without it one consistent read by one task: for a dimension of master data only.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column is not None:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()


def write_staging(delta: DataFrame, options: dict[str, str], table: str) -> None:
    """Replace a staging table with the delta; :func:`upsert_statement` then merges it."""
    delta.write.format("jdbc").options(**options).option("dbtable", table).option("truncate", "true").mode(
        "overwrite"
    ).save()


def upsert_statement(target: str, staging: str, columns: list[str], keys: list[str]) -> str:
    """One idempotent statement that upserts a staging table by key, for the database to run."""
    for name in [*target.split("."), *staging.split("."), *columns]:
        if not _IDENTIFIER.fullmatch(name):
            raise ValueError(f"Invalid identifier {name!r}")
    names = ", ".join(columns)
    assignments = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in keys)
    return (
        f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging} "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {assignments}"
    )
