import hashlib
import random

import numpy as np
import pytest

import __spark_entry__ as E
from callcast.llm import suffix_dedup as S
from callcast.sources.tables import table


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept bytes) of each text, from a table of all windows."""
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return out


def documents(rnd):
    def word(n):
        return "".join(rnd.choice("abcdé ") for _ in range(n))

    passages = [word(rnd.randint(30, 140)) for _ in range(12)]
    texts = []
    for _ in range(120):
        parts = [word(rnd.randint(0, 80))]
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(passages)
            a, z = sorted((rnd.randint(0, len(p)), rnd.randint(0, len(p))))
            parts += [p[a:z], word(rnd.randint(0, 30))]
        texts.append("".join(parts))
    texts += ["Des. " * rnd.randint(5, 90) + word(20) for _ in range(25)] + ["a" * 300, "a" * 37, ""]
    near = word(260)
    for _ in range(40):
        p = rnd.randrange(len(near))
        texts.append(near[:p] + rnd.choice("xyz") + near[p + 1 :])
    return texts + texts[:6]


@pytest.mark.parametrize("seed,length,gram,reach,range_bytes", [(1, 50, 8, 32, 1 << 20), (2, 40, 12, 2, 1500), (3, 64, 64, 1, 4000), (4, 50, 8, 3, 700)])
def test_equals_brute_force(spark, seed, length, gram, reach, range_bytes):
    texts = documents(random.Random(seed))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.deduplicate(docs, length=length, gram=gram, reach=reach, range_bytes=range_bytes).collect()}
    want = brute([t.encode() for t in texts], length)
    assert [got[i] for i in range(len(texts))] == want


@pytest.mark.parametrize("seed,length,gram,passage,passage_gram,reach", [(1, 50, 8, 30, 6, 32), (2, 90, 40, 30, 6, 2), (3, 64, 64, 64, 20, 1)])
def test_two_lengths_equal_brute_force(spark, seed, length, gram, passage, passage_gram, reach):
    texts = documents(random.Random(seed))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = S.deduplicate(docs, length=length, gram=gram, reach=reach, passage=passage, passage_gram=passage_gram).collect()
    got = {r.doc_id: ((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)), bytes(r.without_passages)) for r in rows}
    data = [t.encode() for t in texts]
    assert [got[i] for i in range(len(texts))] == list(zip(brute(data, length), (b[3] for b in brute(data, passage))))


def test_query_shows_texts_without_passages_of_51_words(spark, tmp_path):
    rnd = random.Random(4)
    words = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(3)) for _ in range(n))
    shared, own = words(51), [words(150) for _ in range(8)]
    texts = [f"{own[d]} {shared} {own[d][::-1]}" if d < 4 else own[d] for d in range(8)] + [None, "", own[0][:100]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = E.queries()["op8_suffix_dedup"](spark, str(tmp_path)).collect()
    data = [(t or "").encode() for t in texts]
    long, short = brute(data, 400), brute(data, S.PASSAGE_BYTES)
    assert len(rows) == len(texts) and 200 < len(shared) < 400
    for r in rows:
        n, gone, spans, kept = long[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.text.encode()) == (n, gone, spans, hashlib.sha256(kept).hexdigest(), kept)
        assert r.without_passages.encode() == short[r.doc_id][3]
        assert shared not in r.without_passages and (r.doc_id >= 4 or shared in r.text)


def test_closed_spans(spark):
    marked = [(1, 1, [(5, 9), (0, 4), (8, 12), (12, 13)]), (2, 7, []), (1, 2, [(3, 4)]), (1, 3, [(0, 50), (2, 3), (60, 61)])]
    rows = S.closed(spark.createDataFrame(marked, "did long, uid long, spans array<struct<a:long,z:long>>").coalesce(1)).collect()
    assert {r.uid: [tuple(x) for x in r.spans] for r in rows} == {1: [(0, 4), (5, 13)], 7: [], 2: [(3, 4)], 3: [(0, 50), (60, 61)]}


def test_passage_is_not_longer_than_the_window(spark, no_docs):
    with pytest.raises(ValueError):
        S.deduplicate(no_docs, passage=S.LENGTH + 1)
    assert S.deduplicate(no_docs, passage=S.LENGTH).count() == 0


def test_table_equals_brute_force(spark):
    rows = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    local = [(r.doc_id, r.text.encode()) for r in rows.collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.deduplicate(rows).collect()}
    for (d, _), (n, gone, spans, kept) in zip(local, brute([t for _, t in local], 400)):
        assert got[d] == (n, gone, spans, hashlib.sha256(kept).hexdigest())


def test_edge_rows(spark, edge_docs, no_docs):
    docs = edge_docs.withColumnRenamed("source", "n_spans")
    got = S.deduplicate(docs)
    assert got.columns == ["doc_id", "text", "lang", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rows = got.collect()
    assert len(rows) == edge_docs.count()
    by = {r.doc_id: r for r in rows}
    assert (by[2].n_bytes, by[2].n_removed, by[2].kept_sha256) == (0, 0, hashlib.sha256(b"").hexdigest())
    assert by[2].text is None and by[6].n_removed == 0  # repeated, but shorter than a window
    assert by[10].n_removed == by[10].n_bytes  # a short period repeats inside the text
    assert by[8].n_removed < by[8].n_bytes
    assert S.deduplicate(no_docs).count() == 0


def test_repeated_rows_remove_each_other(spark):
    text = "".join(chr(97 + (i * i * 31 + i // 7) % 26) for i in range(900))
    rows = S.deduplicate(spark.createDataFrame([(None, text), (None, text), (3, text[:450] + "ü" * 300)], "doc_id long, text string")).collect()
    assert [(r.n_removed, r.n_spans) for r in rows if r.doc_id is None] == [(900, 1)] * 2
    assert next(r for r in rows if r.doc_id == 3).n_removed >= 450


def test_as_text_drops_broken_characters(spark):
    docs = spark.createDataFrame([(1, "é" * 30 + "q"), (2, "x" + "é" * 30)], "doc_id long, text string")
    for r in S.deduplicate(docs, length=21, gram=7, as_text=True).collect():
        assert "�" not in r.kept


def test_long_texts_are_cut_into_pieces(monkeypatch):
    monkeypatch.setattr(S, "_CHUNK", 100)
    texts = [bytes(range(97, 123)) * 20, b"short", b"z" * 130]
    windows = set()
    for data, ends, owner, first in S._pieces(texts, 50):
        begin = [0, *ends[:-1].tolist()]
        for b, e, o, f in zip(begin, ends, owner, first):
            for i in range(b, e - 49):
                assert data[i : i + 50] == texts[o][f + i - b : f + i - b + 50]
                windows.add((int(o), int(f + i - b)))
    assert windows == {(o, i) for o, t in enumerate(texts) for i in range(len(t) - 49)}
