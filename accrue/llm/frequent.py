"""The most frequent rows of a table of counts, without sorting it and without one task that meets them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LEVELS, _SHARES = 64, 16


def most_frequent(counts: DataFrame, limit: int, key: str = "key", n: str = "n") -> DataFrame:
    """The `limit` rows of the largest `n`, ties by ascending `key`, a 64-bit hash; all rows where there are no more.

    Histograms find the threshold: of `n` on a logarithmic scale, of the exact `n` within the level where the limit falls,
    and of the leading bits of `key` for rows of that `n`. Only rows of one share of the keys are then put in order.
    """
    number, hashed = F.col(n), F.col(key)
    level = F.floor(F.log(number.cast("double")) * _LEVELS)
    levels = sorted(((r.least, r.most, r.size) for r in counts.groupBy(level.alias("level")).agg(F.min(n).alias("least"), F.max(n).alias("most"), F.count("*").alias("size")).collect()), reverse=True)
    taken = 0
    for least, most, size in levels:
        if taken + size > limit:
            break
        taken += size
    else:
        return counts
    edge = sorted(((r[0], r[1]) for r in counts.where(number.between(least, most)).groupBy(n).agg(F.count("*")).collect()), reverse=True)
    for value, size in edge:
        if taken + size > limit:
            break
        taken += size
    share = F.shiftright(hashed, 64 - _SHARES)
    shares = sorted(tuple(r) for r in counts.where(number == value).groupBy(share.alias("share")).agg(F.count("*")).collect())
    for last, size in shares:
        if taken + size > limit:
            break
        taken += size
    above = (number > value) | ((number == value) & (share < last))
    if taken == limit:
        return counts.where(above)
    few = counts.where((number == value) & (share == last)).orderBy(key).limit(limit - taken)
    return counts.where(above).union(few)
