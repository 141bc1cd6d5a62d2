from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(column: Column, precision: int = 18, scale: int = 2) -> Column:
    """Decimal sum in ``decimal(precision, scale)``.

    A total that does not fit raises in both ANSI modes: the column it feeds is
    NOT NULL, so a silent NULL would be a lost amount.
    """
    money = f"decimal({precision},{scale})"
    fits = F.sum(column).try_cast(money)
    return F.coalesce(fits, F.raise_error(F.lit(f"sum does not fit {money}")).cast(money))


def last_non_null(column: Column, *order: Column) -> Column:
    """The non-null value that is last by ``order``; nulls never replace a value."""
    return F.max_by(F.when(column.isNotNull(), column), F.when(column.isNotNull(), F.struct(*order)))
