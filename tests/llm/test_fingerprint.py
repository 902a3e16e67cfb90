import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from callcast.llm import fingerprint as P
from callcast.sources.tables import table


def shingles(text):
    words = [w for w in re.split("[ \t\n\x0b\f\r]+", text) if w]
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else collections.Counter()


def jaccard(a, b):
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def check(rows, got):
    """Exact columns, and the mean error of the likenesses."""
    errors = []
    assert len(got) == len(rows)
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        g, n = got[d], len(t)
        edited = t[: n - n // 4] + after[: n // 4]
        assert (g.n_chars, g.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1
        errors += [abs(g.near_edited - jaccard(shingles(t), shingles(edited))), abs(g.near_next - jaccard(shingles(t), shingles(after)))]
    return sum(errors) / len(errors)


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = {r.doc_id: r for r in P.fingerprints(docs).collect()}
    assert check(rows, got) < 0.04
    prints = collections.defaultdict(set)
    for d, t in rows:
        prints[t].add(got[d].fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_blocks_of_ids_and_wrapping(spark, monkeypatch):
    monkeypatch.setattr(P, "_BLOCK_BITS", 1)
    ids = [-5, -4, 0, 1, 2, 3, 9, 17, 1000, 1001, 10**15]
    rows = [(d, " ".join(f"w{(i * 13 + k) % 97}" for k in range(20 + i))) for i, d in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in P.fingerprints(docs).collect()}
    check(rows, got)
    assert [got[d].next_id for d in ids] == ids[1:] + ids[:1]


def test_terms_hold_counts_and_spread_them(spark):
    text = "a b c d e " * 900 + "f g"
    got = spark.createDataFrame([(text,)], "t string").select(P.terms(F.col("t")).alias("x")).select("x", P.spread(F.col("x")).alias("y")).first()
    assert sorted(e.n for e in got.x) == sorted(shingles(text).values())
    for e in got.x:
        dealt = [x for x in got.y if x.h == e.h]
        assert sum(x.n for x in dealt) == e.n and len({x.bin for x in dealt}) == len(dealt) == min(e.n, P.BINS)
        assert max(x.n for x in dealt) - min(x.n for x in dealt) <= 1


def test_likeness_follows_the_weights(spark):
    """Collision rate equals generalised Jaccard for weighted sets that share all terms."""
    a, b = {i: 1 + i % 4 for i in range(3000)}, {i: 1 + (i * 7) % 4 for i in range(3000)}
    rows = [(v, i, w) for v, s in ((0, a), (1, b)) for i, w in s.items()]
    df = spark.createDataFrame(rows, "v int, i long, w int").withColumn("t", F.xxhash64("i").bitwiseAND(F.lit(-4)))
    least = df.groupBy("v", F.pmod(F.xxhash64("t", F.lit(6)), F.lit(600)).alias("bin")).agg(F.min(P.sample_value(F.col("t"), F.col("w"))).alias("a"))
    both = least.groupBy("bin").pivot("v", [0, 1]).agg(F.first("a")).toDF("bin", "x", "y").dropna()
    rate = both.agg(F.avg((F.col("x") == F.col("y")).cast("int"))).first()[0]
    want = sum(min(a[i], b[i]) for i in a) / sum(max(a[i], b[i]) for i in a)
    assert rate == pytest.approx(want, abs=0.07)


def test_edge_rows(edge_docs, no_docs):
    rows = P.fingerprints(edge_docs.withColumn("fingerprint", F.lit("x"))).collect()
    assert len(rows) == edge_docs.count()
    by = {r.doc_id: r for r in rows}
    assert (by[2].n_chars, by[2].fingerprint, by[3].fingerprint, by[4].fingerprint) == (0, "", "", "")
    assert by[2].near_next == 1.0 and by[2].near_edited == 1.0
    assert by[1].fingerprint == by[6].fingerprint and len(by[1].fingerprint) % 6 == 0
    assert by[10].next_id is None  # the null id sorts first, so the last is followed by it
    assert P.fingerprints(no_docs).count() == 0
    one = P.fingerprints(edge_docs.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_texts_of_repeated_lines(spark):
    """The likeness of texts whose few terms repeat often: no bias, and no text far off."""
    rows = []
    for d in range(60):
        lines = [" ".join(f"w{d}x{k}x{i}" for i in range(8)) for k in range(5)]
        rows.append((d, " ".join(lines * (3 + d % 4)) + " " + " ".join(f"u{d}x{i}" for i in range(50))))
    got = {r.doc_id: r for r in P.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert check(rows, got) < 0.04
    errors = [got[d].near_edited - jaccard(shingles(t), shingles(t[: len(t) - len(t) // 4] + after[: len(t) // 4])) for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1])]
    assert abs(sum(errors) / len(errors)) < 0.02 and max(map(abs, errors)) < 0.2


def test_terms_that_repeat_more_often_than_there_are_bins(spark):
    """Weights over the number of bins are quantised in their bins; the likeness still follows them."""
    rows = []
    for d in range(40):
        heavy = " ".join(f"w{i}" for i in range(6))
        rows.append((d, " ".join([heavy] * (150 + 40 * (d % 5))) + " " + " ".join(f"u{d}x{i}" for i in range(30))))
    got = {r.doc_id: r for r in P.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert check(rows, got) < 0.04
    errors = [got[d].near_next - jaccard(shingles(t), shingles(after)) for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1])]
    assert abs(sum(errors) / len(errors)) < 0.05
