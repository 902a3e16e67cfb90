import random

import numpy as np
import pytest

from callcast.llm import decontaminate as D


def edit_distance_inside(item: str, text: str) -> int:
    """Fewest edits of item against any part of text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(rnd, text, n):
    for _ in range(n):
        p, kind = rnd.randrange(len(text)), rnd.randrange(3)
        text = text[:p] + (rnd.choice("xyz") if kind < 2 else "") + text[p + (kind != 1) :]
    return text


@pytest.mark.parametrize("seed", range(12))
def test_find_equals_brute_force(seed):
    rnd = random.Random(seed)
    letters = "abcdefg hij"
    items = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(30, 120)))) for i in range(6)]
    texts = []
    for _ in range(25):
        body = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 200)))
        i, item = rnd.choice(items)
        n = rnd.randint(0, 12)
        texts.append(body[:50] + (edited(rnd, item, n) if rnd.random() < 0.7 else "") + body[50:])
    norm = lambda s: " ".join(s.split(" ")) if "  " not in s else "".join(map(chr, D.normalize([s])[0]))
    index = D.ItemIndex(items, 8, 0.1, 20)
    got = {(d, i) for d, i, *_ in D.find(texts, index)}
    kept = dict(zip(index.ids, zip(index.codes, index.k)))
    want = {(d, i) for d, t in enumerate(texts) for i, (codes, k) in kept.items() if edit_distance_inside("".join(map(chr, codes)), norm(t)) <= k}
    assert got == want
    for d, i, a, z, n in D.find(texts, index):
        assert n <= kept[i][1]
        assert edit_distance_inside("".join(map(chr, kept[i][0])), norm(texts[d][a:z])) <= n


def test_case_white_space_and_spans():
    item = "What is the capital of the small republic in the mountains"
    text = "Intro.  WHAT  is the\ncapital of the small republic in the mountains. End"
    ((d, i, a, z, n),) = D.find([text], D.ItemIndex([(7, item)], D.Q, D.RATE, D.MIN_CHARS))
    assert (d, i, n) == (0, 7, 0)
    assert text[a:z].split() == text[8 : text.index('. End')].split()


def test_edge_rows(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog and runs away"), (2, None), (3, ""), (4, "short"), (5, "naïve café 😀 größe naïve café 😀 größe")], "item_id long, text string")
    got = D.matches(edge_docs, items).collect()
    assert sorted(r.doc_id for r in got if r.item_id == 1) == [1, 6, 6]
    assert {r.doc_id for r in got if r.item_id == 5} == {10}
    assert {r.item_id for r in got} == {1, 5}
    assert D.matches(no_docs, items).count() == 0
    assert D.matches(edge_docs, items.limit(0)).count() == 0
    kept = D.clean(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 4, 5, 8, 9]
    assert D.clean(edge_docs, items, block_chars=10).count() == 7  # one block per item


def test_whole_long_text_is_read(spark):
    item = "a passage of the benchmark that stands at the very end of a long text"
    docs = spark.createDataFrame([(1, "filler words all over " * 30_000 + item)], "doc_id long, text string")
    assert [r.doc_id for r in D.matches(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()] == [1]


def test_banded_edits_anchored():
    a = np.frombuffer("abcdef".encode("utf-32-le"), np.uint32)
    assert D.banded_edits(a, a, 0, 1) == (0, 6)
    assert D.banded_edits(a, a[1:], -2, 5, anchored=True)[0] == 1
