"""Which rows a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))
