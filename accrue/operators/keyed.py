"""Upserts and deletes of keyed rows as plain DataFrame operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrue.operators.intervals import DELETE


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The last row of each key by ``order``.

    An aggregation, not a window: each task keeps one row per key before the
    shuffle, so a key with very many versions stays cheap.
    """
    last = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(
        last.alias("_last")
    ).select("_last.*")


def _others(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key the delta has not. NULL keys are equal.

    An anti join: the target is never sorted or aggregated, and not shuffled either where the delta's keys turn out
    small enough to be broadcast.
    """
    found = delta.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return target.join(found, reduce(lambda a, b: a & b, same), "left_anti")


def upsert(target: DataFrame, delta: DataFrame, keys: list[str], order: list[Column | str] | None = None) -> DataFrame:
    """Target rows replaced or added to by the delta's last row per key by ``order``.

    The target has one row per key, and without ``order`` the delta too. Only the delta is aggregated.
    """
    last = delta.select(*target.columns) if order is None else latest_per_key(delta, keys, order).select(*target.columns)
    return _others(target, last, keys).unionByName(last)


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: list[str], order: list[Column | str], op: str = "op"
) -> DataFrame:
    """Upserts and deletes (``op = 'd'``) applied to the target of one row per key, last change per key first."""
    last = latest_per_key(changes, keys, order)
    return _others(target, last, keys).unionByName(last.where(F.col(op) != DELETE).select(*target.columns))
