import random

import pytest
from pyspark.sql import functions as F

from callcast.llm import chat, licenses

TEXT = dict(licenses.TEMPLATES)


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.license_id): r.containment for r in licenses.scan(docs).collect()}


def test_notices_in_any_surroundings(spark):
    rnd = random.Random(3)
    noise = lambda n: " ".join(f"w{rnd.randrange(500)}" for _ in range(n))
    texts, want = [], set()
    for name, text in licenses.TEMPLATES:
        for before in (0, 1, 17, 500, 5000):
            want.add((len(texts), name))
            texts.append(f"{noise(before)}\n{text.upper() if before == 1 else text} {noise(before // 2)}")
    assert want <= set(found(spark, texts))
    assert all(v == 1.0 for k, v in found(spark, texts).items() if k in want)
    assert found(spark, [noise(3000), "a license to do what you like", ""]) == {}


def test_all_licenses_of_one_text_are_found(spark):
    got = found(spark, [" ".join(t for _, t in licenses.TEMPLATES)])
    assert {n for _, n in got} == set(TEXT)


@pytest.mark.parametrize("edits,there", [(1, True), (12, False)])
def test_edited_notice(spark, edits, there):
    words = TEXT["MIT-text"].split()
    for i in range(edits):
        words[3 + i * len(words) // edits if edits > 1 else 40] = "zzz"
    assert ((0, "MIT-text") in found(spark, ["intro " * 30 + " ".join(words)])) is there


def test_license_edge_rows(spark, edge_docs, no_docs):
    assert licenses.scan(edge_docs).count() == 0
    assert licenses.scan(no_docs).count() == 0
    rows = spark.createDataFrame([(1, TEXT["MIT"]), (1, TEXT["MIT"]), (None, TEXT["MIT"]), (1, TEXT["Apache-2.0"])], "doc_id long, text string").withColumn("containment", F.lit("x"))
    assert sorted((r.doc_id or 0, r.license_id) for r in licenses.scan(rows).collect()) == [(0, "MIT"), (1, "Apache-2.0"), (1, "MIT")]


TURNS = [
    (1, 0, "system", "be kind"),
    (1, 1, "ann", "hello <|im_end|>"),
    (1, 2, "bob", "hi ann"),
    (1, 3, "cy", None),
    (1, 4, "ann", "bye"),
    (1, 4, "ann", "bye"),
    (2, None, None, "first"),
    (2, 7, "bob", "same turn b"),
    (2, 7, "ann", "same turn a"),
    (3, 0, "system", "nobody speaks"),
    (None, 0, "ann", "no id"),
]
TURN_SCHEMA = "conv_id long, turn long, role string, text string"


def test_perspectives(spark):
    rows = chat.perspectives(spark.createDataFrame(TURNS, TURN_SCHEMA).withColumn("mask", F.lit(1))).collect()
    by = {(r.conv_id, r.speaker): r for r in rows if r.part[0] >= 0}
    null_turn = {r.speaker: r.text for r in rows if r.part[0] < 0}
    assert null_turn["unknown"] == "<|im_start|>assistant\nfirst<|im_end|>\n" and set(null_turn) == {"unknown", "ann", "bob"}
    assert set(by) == {(1, "ann"), (1, "bob"), (1, "cy"), (2, "unknown"), (2, "ann"), (2, "bob"), (None, "ann")}
    r = by[1, "ann"]
    assert r.text == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhello <|im_end |><|im_end|>\n<|im_start|>user name=bob\nhi ann<|im_end|>\n"
        "<|im_start|>user name=cy\n<|im_end|>\n<|im_start|>assistant\nbye<|im_end|>\n"
    )
    assert [r.text[m.start : m.end] for m in r.mask] == ["hello <|im_end |><|im_end|>", "bye<|im_end|>"]
    assert (r.n_turns, r.n_spoken) == (5, 2)
    assert [by[1, "cy"].text[m.start : m.end] for m in by[1, "cy"].mask] == ["<|im_end|>"]
    assert "same turn a" in by[2, "unknown"].text and by[2, "unknown"].n_spoken == 0
    assert chat.perspectives(spark.createDataFrame([], TURN_SCHEMA)).count() == 0


def test_parts_of_a_large_dialogue_make_the_whole(spark):
    rnd = random.Random(2)
    rows = [(1, rnd.randrange(40), rnd.choice("abc"), f"t{i}") for i in range(900)]
    turns = spark.createDataFrame(rows, TURN_SCHEMA)
    whole = {r.speaker: r.text for r in chat.perspectives(turns).collect()}
    small = chat.perspectives(turns, part_turns=8, part_rows=5).orderBy("part").collect()
    assert len(small) > 100
    for s, text in whole.items():
        mine = [r for r in small if r.speaker == s]
        assert "".join(r.text for r in mine) == text
        assert all(r.text[m.start : m.end].endswith(chat.END) for r in mine for m in r.mask)


def as_key(r):
    return r.conv_id, r.speaker, tuple(r.part), r.n_turns, r.n_spoken, r.text, [(m.start, m.end) for m in r.mask]


def test_result_does_not_depend_on_the_number_of_rows(spark):
    """Over 4096 rows in one block of turns: copies of few utterances, and different utterances that tie."""
    few = [(1, i, "ab"[i % 2], f"t{i}") for i in range(200)]
    many = [(2, i % 5, "abc"[i % 3], f"t{i}") for i in range(5000)] + [(2, 300 + i, "a", f"later {i}") for i in range(3)]
    copies = chat.perspectives(spark.createDataFrame(few * 25, TURN_SCHEMA)).collect()
    assert sorted(map(as_key, copies)) == sorted(map(as_key, chat.perspectives(spark.createDataFrame(few, TURN_SCHEMA)).collect()))
    turns = spark.createDataFrame(many, TURN_SCHEMA)
    got = sorted(map(as_key, chat.perspectives(turns).collect()))
    assert [k[:4] for k in got] == [(2, s, (b, -1, -1), n) for s in "abc" for b, n in ((0, 5000), (1, 3))]
    assert got == sorted(map(as_key, chat.perspectives(turns, part_rows=10**9).collect()))
