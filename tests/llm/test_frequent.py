import random

import pytest

from accrue.llm.frequent import most_frequent


@pytest.mark.parametrize("limit", [0, 1, 7, 50, 199, 200, 1000])
def test_equals_an_ordered_limit(spark, limit):
    rng = random.Random(limit)
    rows = [(rng.randrange(-(1 << 63), 1 << 63), rng.choice([1, 1, 1, 2, 3, 500, 501, 502, 10**9])) for _ in range(200)]
    rows += [(k, 1) for k in range(5)]  # of one share of the keys
    got = most_frequent(spark.createDataFrame(rows, "key long, n long").repartition(5), limit).collect()
    assert sorted(map(tuple, got)) == sorted(sorted(rows, key=lambda r: (-r[1], r[0]))[:limit])


def test_an_empty_table(spark):
    assert most_frequent(spark.createDataFrame([], "key long, n long"), 5).count() == 0
