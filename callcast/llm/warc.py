"""WARC archives of pages, and one capture index over all of them by external merge.

*Write.*  One record per page; the payload is the page's text in UTF-8.  Of
pages with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the
largest id is a ``response``, the others are ``revisit`` records that refer to
it and repeat only the HTTP header.  Each task sorts its captures by URL key,
time and id and writes them as one gzip-compressed archive through Spark's text
sink (the record separator is the line separator), so archives lie on whatever
storage the path names.

*Read.*  Archives come back as binary files; records are cut by their
Content-Length, payload digests are computed anew and must agree with the
headers.  Every archive gives one sorted capture run, kept as front-coded
chunks.

*Merge.*  Chunks are cut at sampled keys and sent to key ranges; each range
merges its runs with a loser tree (see ``merge``).  Ranges are numbered in key
order, so (range, place) is the global order, and ``position`` counts it from 1.

Defined results: a null payload is empty; a null URL has an empty key; rows with
a null id are written as responses with a null id; repeated rows give repeated
records; control characters of a URL are percent-encoded in its record; an empty
table gives an empty index.  Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callcast.llm.merge import common_prefix, front_code, front_decode, merge_runs
from callcast.session import materialize, scratch_path, ship_package

REVISIT_BYTES = 1000
RECORDS_PER_FILE = 2000
_CHUNK = 4096
_SAMPLE = 20_000
_ID = "urn:page:"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def url_key(url: Column) -> Column:
    """Sort-friendly form: host labels from the last to the first, then path and query, lower case, no scheme or fragment."""
    u = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_replace(F.regexp_extract(u, r"^(?s:.*?)://([^/?#]*)", 1), r"^www\.", "")
    rest = F.regexp_extract(u, r"^(?s:.*?)://[^/?#]*([^#]*)", 1)
    return F.when(u.contains("://"), F.concat(F.concat_ws(",", F.reverse(F.split(host, r"\."))), F.lit(")"), rest)).otherwise(u)


def capture_time(page_id: Column) -> Column:
    """Pages have no time; each id gets a second of the year 2024 on (14 digits, UTC)."""
    second = F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(31_536_000)).cast("int")
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(secs=second)
    return F.regexp_replace(F.substring(at.cast("string"), 1, 19), "[^0-9]", "")


def _iso(t14: Column) -> Column:
    part = lambda a, n: F.substring(t14, a, n)
    return F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit("T"), part(9, 2), F.lit(":"), part(11, 2), F.lit(":"), part(13, 2), F.lit("Z"))


def classify(pages: DataFrame, page_id: str, url: str, payload: str, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload (string), payload_bytes, digest, refers_to (null: a response)."""
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{payload}`"), F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha1(F.col("payload").cast("binary"))})
    first = rows.where(F.col("payload_bytes") >= least).groupBy("digest").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "response")
    return rows.join(first, "digest", "left").withColumn("refers_to", F.when(F.col("page_id") != F.col("response"), F.col("response"))).drop("response")


def record(key: Column, t14: Column) -> Column:
    """The text of one record, without the two line ends that close it."""
    eol = F.lit("\r\n")
    uri = F.coalesce(F.col("url"), F.lit(""))
    for c, code in (("\r", "%0D"), ("\n", "%0A"), ("\x00", "%00")):
        uri = F.replace(uri, F.lit(c), F.lit(code))
    revisit = F.col("refers_to").isNotNull()
    block = F.concat(F.lit(_HTTP), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    name = lambda c: F.concat(F.lit(f"<{_ID}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), eol,
        F.lit("WARC-Record-ID: "), name(F.col("page_id")), eol,
        F.lit("WARC-Target-URI: "), uri, eol,
        F.lit("WARC-Date: "), _iso(t14), eol,
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), eol,
        F.when(revisit, F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name(F.col("refers_to")), eol)).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, block)


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the archives of ``pages`` under ``path``."""
    rows = classify(pages, page_id, url, payload).withColumns({"key": url_key(F.col("url")), "t14": capture_time(F.col("page_id"))})
    runs = rows.sortWithinPartitions("key", "t14", "page_id")
    runs.select(record(F.col("key"), F.col("t14")).alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


_FIELD = re.compile(rb"([A-Za-z-]+): (.*)")


def records(data: bytes):
    """(header, block, place, length) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/1.", at):
            raise ValueError(f"no record at byte {at}")
        head = {m[1].decode().lower(): m[2].decode() for line in data[at:end].split(b"\r\n")[1:] if (m := _FIELD.fullmatch(line))}
        stop = end + 4 + int(head["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end at its Content-Length")
        yield head, data[end + 4 : stop], at, stop + 4 - at
        at = stop + 4


def _page(name: str) -> int | None:
    number = name.strip("<>").removeprefix(_ID)
    return int(number) if number else None


_COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "archive", "offset", "length"]
_TYPES = ["long", "long", "string", "string", "long", "string", "string", "string", "long", "long"]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
_ROW = ", ".join(f"{c} {t}" for c, t in zip(_COLUMNS, _TYPES))
_CHUNK_ROW = "run string, chunk int, first binary, shared binary, rest binary, blob binary, rows array<struct<" + ", ".join(f"{c}: {t}" for c, t in zip(_COLUMNS, _TYPES)) + ">>"
_STRUCT = pa.struct(list(zip(_COLUMNS, _KINDS)))


def _chunk(run: str, number: int, keys: list[bytes], rows: list[tuple]) -> pa.RecordBatch:
    shared, rest, blob = front_code(keys)
    cols = [pa.array([run]), pa.array([number], pa.int32()), *(pa.array([x], pa.binary()) for x in (keys[0], shared.tobytes(), rest.tobytes(), blob)), pa.array([[dict(zip(_COLUMNS, r)) for r in rows]], pa.list_(_STRUCT))]
    return pa.RecordBatch.from_arrays(cols, names=["run", "chunk", "first", "shared", "rest", "blob", "rows"])


def capture_key(key: str, captured: str, page_id: int | None) -> bytes:
    return key.encode() + b"\x00" + captured.encode() + (0 if page_id is None else page_id + (1 << 63)).to_bytes(8, "big")


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """Read the archives under ``path``; chunks of sorted captures, one run per archive."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def parse(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                archive = name.rsplit("/", 1)[-1]
                found = []
                for head, block, at, length in records(gzip.decompress(content.as_py())):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    kind = head["warc-type"]
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"damaged payload in {archive} at byte {at}")
                    page, refers = _page(head["warc-record-id"]), head.get("warc-refers-to")
                    found.append((page, size, digest, kind, _page(refers) if refers else None, head["warc-target-uri"], re.sub(r"\D", "", head["warc-date"]), archive, at, length))
                yield pa.RecordBatch.from_arrays([pa.array([c[i] for c in found], k) for i, k in enumerate(_KINDS)], names=[*_COLUMNS[:5], "uri", *_COLUMNS[6:]])

    parsed = files.mapInArrow(parse, _ROW.replace("url_key", "uri")).withColumn("url_key", url_key(F.col("uri"))).select(*_COLUMNS)

    def chunked(batches):
        held: list[tuple] = []
        number = 0

        def close(last: bool):
            nonlocal held, number
            while held and (last or len(held) > _CHUNK or held[0][7] != held[-1][7]):
                run = held[0][7]
                n = next((i for i, r in enumerate(held[:_CHUNK]) if r[7] != run), min(len(held), _CHUNK))
                rows, held = held[:n], held[n:]
                yield _chunk(run, number, [capture_key(r[5], r[6], r[0]) for r in rows], rows)
                number += 1

        for batch in batches:
            held += list(zip(*(c.to_pylist() for c in batch.columns)))
            yield from close(False)
        yield from close(True)

    return parsed.mapInArrow(chunked, _CHUNK_ROW)


def merge_index(chunks: DataFrame, per_range: int = 50_000) -> DataFrame:
    """One globally ordered index of all captures; ``position`` counts them from 1."""
    total = chunks.agg(F.sum(F.size("rows")).alias("n"), F.count(F.lit(1)).alias("c")).first()
    ranges = max(1, (total.n or 0) // per_range)
    splitters: list[bytes] = []
    if ranges > 1:  # a bounded sample of keys from all chunks
        share = min(1.0, _SAMPLE / total.n)
        some = chunks.select(F.explode("rows").alias("r")).select("r.url_key", "r.captured", "r.page_id").where(F.pmod(F.xxhash64("page_id", "url_key"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
        keys = sorted(capture_key(r.url_key, r.captured, r.page_id) for r in some.collect())
        splitters = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []

    def decoded(shared, rest, blob):
        return front_decode(np.frombuffer(shared, np.uint32), np.frombuffer(rest, np.uint32), blob)

    def cut(batches):
        for batch in batches:
            for run, number, _, shared, rest, blob, rows in zip(*(c.to_pylist() for c in batch.columns)):
                keys = [k for k, _ in decoded(shared, rest, blob)]
                at = [0, *(bisect.bisect_left(keys, s) for s in splitters), len(keys)]
                for i, (lo, hi) in enumerate(zip(at, at[1:])):
                    if hi > lo:
                        part = _chunk(run, number, keys[lo:hi], [tuple(r.values()) for r in rows[lo:hi]])
                        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *part.columns], names=["range", *part.schema.names])

    def merged(batches):
        def feed(chunks):
            last = b""
            for shared, rest, blob, rows in chunks:
                for n, ((key, x), row) in enumerate(zip(decoded(shared, rest, blob), rows)):
                    if n == 0:  # the first of a chunk is coded whole
                        x = common_prefix(last, key)
                    yield key, x, row
                    last = key

        def close(rng, runs):
            rows = [tuple(row.values()) for _, _, row in merge_runs([feed(c) for _, c in sorted(runs.items())])]
            cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(_KINDS)]
            place = pa.array(np.arange(1, len(rows) + 1))
            return pa.RecordBatch.from_arrays([*cols, pa.array(np.full(len(rows), rng, np.int32)), place], names=[*_COLUMNS, "range", "place"])

        at, runs = None, {}
        for batch in batches:
            for rng, run, _, _, shared, rest, blob, rows in zip(*(c.to_pylist() for c in batch.columns)):
                if rng != at:
                    if runs:
                        yield close(at, runs)
                    at, runs = rng, {}
                runs.setdefault(run, []).append((shared, rest, blob, rows))
        if runs:
            yield close(at, runs)

    pieces = chunks.mapInArrow(cut, f"range int, {_CHUNK_ROW}")
    index = materialize(pieces.repartition(len(splitters) + 1, "range").sortWithinPartitions("range", "run", "chunk").mapInArrow(merged, f"{_ROW}, range int, place long"), "warc-index")
    counts = index.groupBy("range").agg(F.count(F.lit(1)).alias("n"))  # one row per range, at most the sample's size
    before = counts.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    return index.join(F.broadcast(before), "range").select(*_COLUMNS, (F.col("before") + F.col("place")).alias("position"))


def archive_and_index(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", path: str | None = None) -> DataFrame:
    """Write the archives, read them back and merge their captures into one index."""
    spark = pages.sparkSession
    ship_package(spark)
    path = path or scratch_path(spark, "warc")
    write(pages, path, page_id, url, payload)
    return merge_index(materialize(capture_runs(spark, path), "warc-runs"))
