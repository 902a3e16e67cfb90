"""Hard negatives against plain pairs: random and clustered vectors, small leaves, hot cells, edge rows; elimination by ranges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from callcast.llm import hard_negatives as H
from callcast.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100, positives=5, negatives=5, low=80, high=100):
    """All pairs, in plain Python; rows are (id, integer vector, label)."""
    out = set()
    for a, x, la in rows:
        if a % every:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(x, y)), b, lb) for b, y, lb in rows if b != a), key=lambda t: (t[0], t[1]))
        for s, b, lb in [t for t in scored if t[2] == la][:positives]:
            fits = [(n, c) for n, c, lc in scored if lc != la and low * -s <= 100 * -n <= high * -s]
            out |= {(a, b, k, c, -s, -n) for k, (n, c) in enumerate(fits[:negatives], 1)}
    return out


def made(seed, n=600, d=6, clusters=0):
    r = np.random.default_rng(seed)
    if clusters:
        x = r.normal(size=(clusters, d))[r.integers(0, clusters, n)] * 4 + r.normal(size=(n, d)) * 0.05
    else:
        x = r.normal(size=(n, d)) * 0.3
    return [(i, v, int(k)) for i, (v, k) in enumerate(zip(x.tolist(), r.integers(0, 4, n)))]


def as_integers(rows):
    return [(i, [int(np.floor(256 * c)) for c in v], k) for i, v, k in rows]


def mined(df, **params):
    return {tuple(r) for r in H.mine(df, F.col("vec_id") % params.pop("every", 20) == 0, **params).collect()}


@pytest.mark.parametrize("seed,clusters", [(1, 0), (2, 12)])
def test_equals_all_pairs(spark, seed, clusters):
    rows = made(seed, clusters=clusters)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(as_integers(rows), 20)
    assert want and mined(df, sample_rows=80, fan_out=3, depth=3, leaf_rows=16, block_rows=4) == want
    if not clusters:
        assert mined(df) == want


def test_hot_vector_and_ties(spark):
    """A third of the rows hold one vector: many ties, one cell of many leaves."""
    rows = made(3, n=300)
    rows = [(i, rows[0][1] if i % 3 else v, k) for i, v, k in rows]
    got = mined(spark.createDataFrame(rows, SCHEMA), sample_rows=60, fan_out=4, leaf_rows=20, block_rows=3)
    assert got == brute(as_integers(rows), 20) and len(got) > 50


def test_ranges_eliminate_subtrees_and_never_a_match():
    r = np.random.default_rng(5)
    x = np.rint(r.normal(size=(40, 5))[r.integers(0, 40, 2000)] * 800 + r.normal(size=(2000, 5)) * 10).astype(np.int64)
    root, n = H.build(x[:400], 6, 2)
    cell = H.descend(root, x)
    way = H.paths(root)
    assert sorted(way) == list(range(n))
    rows = []
    for c in np.unique(cell):
        d2 = np.concatenate([H.squared_distances(x[cell == c], node.points) for node, _ in way[c]], axis=1)
        size = H.norms(x[cell == c])
        rows.append((int(c), 1, d2.min(axis=0).tolist(), d2.max(axis=0).tolist(), int(size.min()), int(size.max())))
    ranges = H.gather(root, rows)
    q = x[::50]
    scores = q @ x.T
    low = np.sort(scores, axis=1)[:, -6][:, None]
    high = np.full_like(low, np.iinfo(np.int64).max)
    visited = H.visits(root, ranges, q, low, high)
    for i in range(len(q)):
        needed = set(cell[scores[i] >= low[i, 0]].tolist())
        assert needed <= {c for c, at in visited.items() if i in at}
    assert sum(map(len, visited.values())) < 0.35 * len(q) * len(rows)


def test_big_components_are_exact(spark):
    rows = [(i, [100071.5 + i, 100000.25 * (i % 3 - 1), 7.0], i % 2) for i in range(60)]
    assert mined(spark.createDataFrame(rows, SCHEMA), every=10) == brute(as_integers(rows), 10)


def test_query_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    frame = con.sql(ORACLE["op13_hard_negatives"])
    want = {tuple(r) for r in frame.fetchall()}
    got = QUERIES["op13_hard_negatives"](spark, "/root/testdata/sf0.01")
    assert got.columns == frame.columns and {tuple(r) for r in got.collect()} == want and len(want) > 50


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = made(6, n=80, d=2)
    bad = [(None, [1.0, 1.0], 1), (200, None, 1), (201, [nan, 1.0], 1), (202, [None, 1.0], 1), (203, [inf, 1.0], 1), (204, [1.0], 1), (205, [], 1), (206, [1.0, 1.0], None), (207, [1e9, 0.0], 1)]
    df = spark.createDataFrame(good + good[:30] + bad, SCHEMA).withColumn("rank", F.lit("old")).withColumn("cell", F.lit(1))
    want = brute(as_integers(good), 20)
    assert mined(df) == want
    assert mined(df.limit(0)) == set() and mined(spark.createDataFrame(bad, SCHEMA)) == set()
    lone = spark.createDataFrame([(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 2)], SCHEMA)
    assert mined(lone) == set() and mined(lone.where("vec_id = 1")) == set()
