import collections
import random

import pytest

from callcast.llm import jaccard_join as J
from callcast.llm.components import components
from callcast.llm.textops import shingle_set
from callcast.sources.tables import table


def brute(rows, threshold=0.8):
    """{doc_id: (class_id, n_links)} by comparing all sets that share a shingle."""
    sets = {i: frozenset(shingle_set(t).tolist()) for i, t in rows}
    near = collections.defaultdict(set)
    owners = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            owners[x].append(i)
    pairs = {(a, b) for l in owners.values() for a in l for b in l if a < b}
    for a, b in pairs:
        if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
            near[a].add(b)
            near[b].add(a)
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (min(seen), len(near[i]))
    return out


def copies(rnd, base, n, rate):
    return [" ".join(w if rnd.random() > rate else f"x{rnd.randrange(10**6)}" for w in base) for _ in range(n)]


@pytest.mark.parametrize("small,depth,block", [(32, 3, 512), (4, 2, 8)])
def test_equals_brute_force(spark, small, depth, block):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for size, rate in ((90, 0.004), (40, 0.01), (6, 0.02), (3, 0.03), (2, 0.02)):
        texts += copies(rnd, [rnd.choice(vocabulary) for _ in range(150)], size, rate)
    passage = " ".join(rnd.choice(vocabulary) for _ in range(60))
    texts += [passage + " " + " ".join(rnd.choice(vocabulary) for _ in range(60)) for _ in range(70)]
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 80))) for _ in range(100)]
    texts += texts[:5] + ["Same words, other case!", "same words other CASE"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.near_duplicates(docs, small=small, depth=depth, block=block).collect()}
    assert got == brute(rows)


def test_table_equals_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: (r.class_id, r.n_links) for r in J.near_duplicates(docs).collect()} == brute(rows)


def test_edge_rows(edge_docs, no_docs):
    got = [(r.doc_id, r.class_id, r.n_links) for r in J.near_duplicates(edge_docs).collect()]
    assert sorted(x for x in got if x[0] is not None) == [(1, 1, 2), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 5, 0), (6, 1, 2), (6, 1, 2), (8, 8, 0), (9, 9, 0), (10, 10, 0)]
    assert (None, None, 0) in got
    assert J.near_duplicates(no_docs).count() == 0
    kept = J.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 8, 9, 10]


def test_runs_follow_the_recall():
    assert J.runs_needed(0.8, 0, 0.99) == 3
    assert J.runs_needed(0.8, 3, 0.999) > J.runs_needed(0.8, 3, 0.9)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    hub = [(200, i) for i in range(201, 400)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + hub, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, **{i: 200 for i in range(200, 400)}}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0
