"""Toxicity: composition against running the transducers one by one, contexts, learning, held-out accuracy, edge rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from callcast.llm import toxicity as X
from callcast.sources.tables import table

PARTS = [X.negation(), X.reported(), X.target(), X.threat()]
MODEL = X.Model({"fool": 4.0}, {"grumb": 3.0}, None)


def one_by_one(symbols):
    """Symbols and weights when every transducer reads what the one before has written."""
    states, out = [t.start for t in PARTS], []
    for s in symbols:
        weight = 0.0
        for i, t in enumerate(PARTS):
            s, w, states[i] = t.step(states[i], s)
            weight += w
        out.append((s, weight))
    return out


def test_composed_machine_equals_its_parts():
    machine, draw = X.grammar(), random.Random(3)
    strings = [*itertools.product(X.TAGS, repeat=4), *([draw.choice(X.TAGS) for _ in range(60)] for _ in range(300))]
    for symbols in strings:
        state, got = machine.start, []
        for s in symbols:
            o, w, state = machine.step(state, s)
            got.append((o, w))
        assert got == one_by_one(symbols)
    assert len({s for s, _ in machine.arcs}) <= 2 * 3 * 3 * 3


def weight(text):
    return sum(w for _, w, _ in X.features(text, X._Lexicon(MODEL), X.grammar())[1])


def test_clauses_are_scored_not_words():
    plain = weight("what a fool there.")
    assert plain == pytest.approx(4.0)
    assert weight("grumbling") == pytest.approx(3.0) and weight("a fooled one") == 0
    assert weight("a fool, you.") == pytest.approx(4 * np.exp(X.AIMED))
    assert weight("they are not a fool.") == pytest.approx(4 * np.exp(X.NEGATED))
    assert weight("not that one, a fool.") == pytest.approx(plain)
    assert weight('she said: "here. a fool"') == pytest.approx(4 * np.exp(X.REPORTED))
    assert weight("she said so. a fool.") == pytest.approx(plain)
    assert weight("i kill you.") == pytest.approx(X.THREAT_WEIGHT) and weight("you, you i kill.") == pytest.approx(X.THREAT_WEIGHT)
    assert weight("i kill the fool you.") == pytest.approx(X.THREAT_WEIGHT + 4 * np.exp(X.AIMED))
    assert weight("i kill time, you see.") == pytest.approx(X.THREAT_WEIGHT * np.exp(X.LOOSE_THREAT))


def corpus(spark, n=600):
    """Texts of random words; those with label 1 hold 'blarg' or a word that begins with 'zorpu'; one group of near copies."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("aeiou") + r.choice("bdfglmnrst") for _ in range(r.randint(1, 4)))
    rows, labels = [], []
    for d in range(n):
        ws = [word() for _ in range(60)]
        bad = d % 4 == 0
        if bad:
            for k in range(3):
                ws.insert(r.randint(0, len(ws)), "blarg" if d % 8 else "zorpu" + word())
        rows.append((d, " ".join(ws) + "."))
        labels.append((d, int(bad)))
    base = " ".join(word() for _ in range(80))
    for d in range(n, n + 60):  # near copies, all with label 1: their words must not become insults
        rows.append((d, f"{base} blarg {word()}."))
        labels.append((d, 1))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), base


def test_learns_words_and_stems_and_scores_held_out_texts(spark):
    docs, labels, base = corpus(spark)
    model = X.fit(docs, labels.where(~X.held_out(F.col("doc_id"))))
    assert "blarg" in model.words and any(s.startswith("zorpu") or "zorpu".startswith(s) for s in model.stems)
    assert not set(base.split()) & set(model.words)
    got = {r.doc_id: r for r in X.judge(docs, labels).collect()}
    want = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r.doc_id for r in docs.where(X.held_out(F.col("doc_id"))).collect()]
    assert len(held) > 80
    assert all(got[d].predicted == want[d] == int(got[d].score >= 0.5) for d in held)
    assert all(m.token >= 0 and m.weight > 0 for d in held for m in got[d].matches)


def test_held_out_accuracy_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    rows = X.judge(docs, labels).join(labels, "doc_id").where(X.held_out(F.col("doc_id"))).collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) >= 0.93
    bad, good = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([b > g for b in bad for g in good]) >= 0.75


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (6, 1), (6, 0), (None, 1), (8, None), (10, 1), (99, 1)], "doc_id long, toxic int")
    clash = edge_docs.withColumn("score", F.lit("old")).withColumn("matches", F.lit(1))
    rows = X.judge(clash, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert len({(r.text, r.score) for r in rows if r.text == "the quick brown fox jumps over the lazy dog and runs away"}) == 1
    assert rows[0].matches is not None and X.judge(no_docs, labels).count() == 0
    nothing = X.judge(edge_docs, labels.limit(0))
    assert {r.score for r in nothing.collect()} == {0.0}
