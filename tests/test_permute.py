"""Permutations without sorting: every rank is hit once, keys differ, values are only dealt anew."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from callcast.operators.permute import feistel, permuted, ranked


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_every_rank_is_hit_once(n):
    images = [feistel(np.arange(n), n, np.full(n, key)) for key in (7, -3, 1 << 62)]
    for image in images:
        assert sorted(image.tolist()) == list(range(n))
    if n > 100:
        assert all(np.mean(a == b) < 0.02 for a, b in ((images[0], images[1]), (images[1], images[2]), (images[0], np.arange(n))))
        assert abs(np.corrcoef(np.arange(n), images[0])[0, 1]) < 0.1


def test_values_of_one_column_are_dealt_anew(spark):
    df = spark.createDataFrame([(i * 3, f"v{i}" if i % 7 else None, i) for i in range(200)], "contact_id long, s string, k int")
    rows, n = ranked(df)
    assert n == 200
    got = permuted(rows, n, "s", repeats=4).collect()
    assert len(got) == 800
    orders = []
    for r in range(4):
        part = sorted((x.contact_id, x.k, x.s) for x in got if x.perm_repeat == r)
        assert [(a, b) for a, b, _ in part] == [(i * 3, i) for i in range(200)]
        assert sorted(str(s) for *_, s in part) == sorted(str(f"v{i}" if i % 7 else None) for i in range(200))
        orders.append([s for *_, s in part])
    assert len({tuple(o) for o in orders}) == 4
    plan = permuted(rows, n, "s", 4)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
