import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from callcast.llm import warc as W

BIG = "<p>é\r\n\r\nWARC/1.0\r\n</p>" * 60
PAGES = [
    (1, "http://www.b.org/x?q=1#f", BIG),
    (2, "https://a.b.org/", BIG),
    (3, None, BIG),
    (4, "http://b.org/x", "small"),
    (5, "http://b.org/x", "small"),
    (6, "http://b.org/x", None),
    (7, "", ""),
    (8, "bad\r\nurl\x00", "\r\n\r\n"),
    (None, "http://b.org/n", BIG),
    (9, "http://c.org/", "<p>" + "y" * 200_000),
    (10, "http://c.org/", "x" * 1000),
    (11, "http://c.org/", "x" * 1000),
    (12, "http://c.org/", "x" * 999),
    (13, "http://c.org/", "x" * 999),
    (13, "http://c.org/", "x" * 999),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("position", F.lit("clash"))


def test_round_trip(spark, pages, tmp_path):
    out = W.archive_and_index(pages, path=str(tmp_path / "w")).collect()
    assert len(out) == len(PAGES)
    want = {p: (h or "").encode() for p, _, h in PAGES}
    for r in out:
        assert (r.payload_bytes, r.payload_digest) == (len(want[r.page_id]), hashlib.sha1(want[r.page_id]).hexdigest())
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in out}
    assert kinds[1] == kinds[2] == ("revisit", 3) and kinds[3] == ("response", None)
    assert kinds[None] == ("response", None)
    assert kinds[10] == ("revisit", 11) and kinds[11] == ("response", None)
    assert all(kinds[p] == ("response", None) for p in (4, 5, 6, 7, 8, 12, 13))
    by_place = sorted(out, key=lambda r: r.position)
    assert [r.position for r in by_place] == list(range(1, len(PAGES) + 1))
    keys = [(r.url_key, r.captured, -1 if r.page_id is None else r.page_id) for r in by_place]
    assert keys == sorted(keys)
    seen = {}
    for f in glob.glob(str(tmp_path / "w" / "*.gz")):
        for head, block, at, length in W.records(gzip.open(f).read()):
            seen[f.rsplit("/", 1)[1], at] = (W._page(head["warc-record-id"]), length)
    assert {(r.archive, r.offset): (r.page_id, r.length) for r in out} == seen


def test_many_ranges_and_runs(spark, monkeypatch):
    monkeypatch.setattr(W, "_CHUNK", 7)
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11), F.lit(".org/")).alias("url"), F.lit("t").alias("html")).repartition(6)
    path = W.scratch_path(spark, "warc-test")
    W.write(pages, path)
    out = W.merge_index(W.capture_runs(spark, path), per_range=40).orderBy("position").collect()
    keys = [(r.url_key, r.captured, r.page_id) for r in out]
    assert len(out) == 500 and keys == sorted(keys) and [r.position for r in out] == list(range(1, 501))


def test_damage_is_found():
    good = b"WARC/1.0\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [x[1] for x in W.records(good + good)] == [b"ab", b"ab"]
    with pytest.raises(ValueError):
        list(W.records(good[:-2] + b"xx"))
    with pytest.raises(ValueError):
        list(W.records(b"junk" + good))


def test_empty_table(spark, pages):
    assert W.archive_and_index(pages.limit(0)).count() == 0
