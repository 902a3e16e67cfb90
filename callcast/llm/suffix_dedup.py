"""Exact substring deduplication by a sampled suffix array, built as a distributed merge sort.

A byte is removed when a string of ``LENGTH`` bytes covers it that also starts
at another place, in any text or the same one.  A *window* is such a string.

1. *Sampled suffixes.*  Every window chooses an anchor: the place of its
   GRAM-byte string with the smallest hash (the leftmost of equal ones).  Equal
   windows choose the same anchor, so a window can repeat only if its anchor
   string does.  Neighbouring windows share anchors; a run of windows with one
   anchor is a *segment*, and only the suffixes at anchors are sorted: one in a
   hundred or so.  Segments whose anchor string occurs once are settled.
2. *Pre-aggregation.*  Equal segments (same bytes, same anchor) become one
   entry with a count, so a hot passage is sorted once however often it occurs.
3. *Merge sort.*  An entry is ordered by the bytes from its anchor on, then by
   the bytes before it, reversed.  Each task sorts its entries into runs, cuts
   them at sampled splitters and sends front-coded pieces; each range merges
   its pieces with a loser tree that never compares a known prefix again and
   so yields the common prefixes of neighbours.
4. *Neighbours.*  For two entries near each other in this order, with r equal
   bytes after and l equal bytes before the anchor, the windows that need at
   most r and l bytes repeat.  Each entry looks at ``reach`` neighbours on either
   side; a smaller group of equal anchors is thereby seen in full.  In a larger
   one the common prefix with the first neighbour not looked at bounds r for all
   the others, and so the windows that they could still show to repeat.
5. *The rest.*  Groups with entries that are not settled are sorted again by the
   bytes before the anchor, which bounds l in the same way.  Windows that are
   within both bounds and not yet shown to repeat (few, if any) are compared one
   by one: equal bytes are grouped.

Windows that repeat are marked in every text, and the bytes that they cover are
cut out; all is judged on the input, not on what is left.

Two lengths: a string of ``length`` bytes that repeats lies within the bytes that
repeated strings of a shorter length cover, so after a search with the shorter
one only these runs are searched with the longer one.

Defined results: null and empty texts have nothing to remove; texts shorter
than LENGTH stay whole; rows that repeat are separate texts (so long ones are
removed); null ids are allowed; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
from collections import deque
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callcast.llm.merge import front_code, front_decode, merge_runs
from callcast.llm.textops import mix, rolling
from callcast.session import discard, materialize, ship_package, written

LENGTH = 400
GRAM = 64
#: Window of repeated passages in bytes: a passage of 51 words of three letters and a blank has 204.
PASSAGE_BYTES, PASSAGE_GRAM = 200, 40
#: Never a byte of UTF-8 text, so it ends a part of a key.
_END = b"\xff"
_CHUNK = 1 << 18
_RUN_ENTRIES = 1 << 15
RANGE_BYTES = 16 << 20


def segments(data: bytes, ends: np.ndarray, length: int, gram: int):
    """(start, windows, anchor, hash of the anchor string) of every segment of the concatenated texts that end at ``ends``."""
    n = len(data)
    if n < length:
        return None
    values = np.frombuffer(data, dtype=np.uint8)
    h = mix(rolling(values, gram))
    low = np.uint64((1 << 20) - 1)
    best = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    width, size = length - gram + 1, 1
    while size * 2 <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if width > size:
        best = np.minimum(best[: len(best) - (width - size)], best[width - size :])
    anchor = (best & low).astype(np.int64)
    end = ends[np.searchsorted(ends, np.arange(len(anchor)), side="right")]
    anchor[np.arange(len(anchor)) + length > end] = -1
    cut = np.flatnonzero(np.diff(anchor)) + 1
    start = np.concatenate([[0], cut])
    stop = np.concatenate([cut, [len(anchor)]])
    real = anchor[start] >= 0
    start, stop = start[real], stop[real]
    at = anchor[start]
    return start, stop - start, at, h[at]


def _pieces(texts: list[bytes], length: int, within: list | None = None) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts (or the runs of each that are ``within``), concatenated up to _CHUNK bytes; longer ones cut so that every window is in one piece.

    (bytes, end of each text, number of each text, place of its first byte in the text)
    """
    data, ends, owner, first, size = [], [], [], [], 0
    for i, t in enumerate(texts):
        for low, high in [(0, len(t))] if within is None else ((x["a"], x["z"]) for x in within[i]):
            for a in range(low, high - length + 1, _CHUNK):
                part = t[a : min(a + _CHUNK + length - 1, high)]
                if size and size + len(part) > _CHUNK:
                    yield b"".join(data), np.array(ends), np.array(owner), np.array(first)
                    data, ends, owner, first, size = [], [], [], [], 0
                data.append(part)
                size += len(part)
                ends.append(size)
                owner.append(i)
                first.append(a)
    if size:
        yield b"".join(data), np.array(ends), np.array(owner), np.array(first)


def text_segments(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Segments of rows (did, uid, body): did, uid, place (start, windows, bytes before the anchor, packed), anchor, t1, t2.

    With a column ``within`` (array of (a, z), apart from each other) only of these runs of each body.

    ``anchor`` is the hash of the anchor string and (t1, t2) that of the whole segment with its anchor's place.
    """

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            within = batch.column(3).to_pylist() if batch.num_columns > 3 else None
            for data, ends, owner, first in _pieces([x or b"" for x in batch.column(2).to_pylist()], length, within):
                got = segments(data, ends, length, gram)
                if got is None:
                    continue
                start, windows, anchor, h = got
                text = np.searchsorted(ends, start, side="right")
                begin = np.concatenate([[0], ends[:-1]])[text]
                before = anchor - start
                digest = np.empty((len(start), 2), dtype=np.uint64)
                for i, (a, w, o) in enumerate(zip(start.tolist(), windows.tolist(), before.tolist())):
                    x = xxhash.xxh3_128_intdigest(data[a : a + w + length - 1], o)
                    digest[i, 0], digest[i, 1] = x >> 64, x & 0xFFFFFFFFFFFFFFFF
                out[0].append(owner[text])
                out[1].append(((start - begin + first[text]) << 20) | (windows << 10) | before)
                out[2].append(h.view(np.int64))
                out[3].append(np.ascontiguousarray(digest[:, 0]).view(np.int64))
                out[4].append(np.ascontiguousarray(digest[:, 1]).view(np.int64))
            if not out[0]:
                continue
            at = pa.array(np.concatenate(out[0]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *(pa.array(np.concatenate(x)) for x in out[1:])],
                names=["did", "uid", "place", "anchor", "t1", "t2"],
            )

    return rows.select("did", "uid", "body", *(c for c in rows.columns if c == "within")).mapInArrow(run, "did long, uid long, place long, anchor long, t1 long, t2 long")


def _start(place):
    return F.shiftright(place, 20)


def _windows(place):
    return F.shiftright(place, 10).bitwiseAND(F.lit(1023))


def _before(place):
    return place.bitwiseAND(F.lit(1023))


def sort_key(segment: bytes, before: int, gram: int, backward: bool) -> tuple[bytes, int]:
    """The string that orders an entry, and where its first part ends."""
    right, left = segment[before:], segment[:before][::-1]
    if backward:
        head = right[:gram] + left
        return head + _END + right[gram:] + _END, len(head)
    return right + _END + left + _END, len(right)


_PIECE = "range int, shared binary, rest binary, blob binary, t1 binary, t2 binary, head binary, flag binary"


def sorted_pieces(entries: DataFrame, splitters: list[bytes], gram: int, reach: int, backward: bool) -> DataFrame:
    """Local sorted runs of entries (t1, t2, before, copies, body), cut at the splitters and front-coded.

    Next to a cut inside a group of equal anchors, the ``reach`` nearest strings
    are also sent to the other side as guests, so that no neighbour is missed.
    """
    sent = entries.sparkSession.sparkContext.broadcast(splitters)

    def piece(rng: int, rows: list, guests: list):
        both = sorted([(r, 0) for r in rows] + [(r, 1) for r in guests])
        rows = [r for r, _ in both]
        shared, rest, blob = front_code([r[0] for r in rows])
        cols = [
            np.array([rng], np.int32), shared.tobytes(), rest.tobytes(), blob,
            np.array([r[1] for r in rows], np.int64).tobytes(), np.array([r[2] for r in rows], np.int64).tobytes(),
            np.array([r[3] for r in rows], np.uint32).tobytes(),
            np.array([(r[4] > 1) + 2 * g for r, g in both], np.uint8).tobytes(),
        ]
        return pa.RecordBatch.from_arrays([pa.array(cols[0]), *(pa.array([c], pa.binary()) for c in cols[1:])], names=[x.split()[0] for x in _PIECE.split(", ")])

    def cut(run: list):
        run.sort()
        keys = [r[0] for r in run]
        at = [0, *(bisect.bisect_left(keys, s) for s in sent.value), len(run)]
        for i in range(len(at) - 1):
            lo, hi = at[i], at[i + 1]
            guests = []
            if i:
                head = sent.value[i - 1][:gram]
                guests += [r for r in run[max(0, lo - reach) : lo] if r[0][:gram] == head]
            if i + 2 < len(at):
                head = sent.value[i][:gram]
                guests += [r for r in run[hi : hi + reach] if r[0][:gram] == head]
            if hi > lo or guests:
                yield piece(i, run[lo:hi], guests)

    def sort(batches):
        run = []
        for batch in batches:
            for t1, t2, before, copies, body in zip(*(batch.column(c).to_pylist() for c in range(5))):
                key, head = sort_key(body, before, gram, backward)
                run.append((key, t1, t2, head, copies))
                if len(run) >= _RUN_ENTRIES:
                    yield from cut(run)
                    run = []
        if run:
            yield from cut(run)

    return entries.select("t1", "t2", "before", "copies", "body").mapInArrow(sort, _PIECE)


class _Entry:
    __slots__ = ("key", "head", "t1", "t2", "guest", "lo", "hi", "done", "unseen", "need_lo", "need_hi")

    def __init__(self, key: bytes, load: tuple, length: int, gram: int, backward: bool):
        self.key, (self.t1, self.t2, self.head, flag) = key, load
        self.guest = bool(flag & 2)
        rest = len(key) - self.head - 2
        right, left = (rest + gram, self.head - gram) if backward else (self.head, rest)
        self.need_lo, self.need_hi = length - right, left  # bytes before the anchor that the windows need
        self.lo, self.hi = [], []
        self.done, self.unseen = False, 0
        if flag & 1:  # the segment itself occurs more than once
            self.prove(self.need_lo, self.need_hi)

    def prove(self, lo: int, hi: int) -> None:
        lo, hi = max(lo, self.need_lo), min(hi, self.need_hi)
        if lo <= hi:
            self.lo.append(lo)
            self.hi.append(hi)
            self.done = self.done or (lo == self.need_lo and hi == self.need_hi)


def neighbours(pieces: DataFrame, ranges: int, length: int, gram: int, reach: int, backward: bool) -> DataFrame:
    """Merge the pieces of each range and compare near entries.

    Rows (t1, t2, lo, hi, unseen): windows that need lo..hi bytes before the
    anchor repeat; ``unseen`` bounds the common part with entries of the same
    anchor that were not looked at, on the side that was sorted (0: all were,
    or there is nothing more to show).
    """

    def meet(a: _Entry, b: _Entry, x: int) -> None:
        """x: common prefix of the keys, at least the anchor string."""
        if a.done and b.done:
            return
        first = min(x, a.head, b.head)
        if a.head == b.head and x > a.head:
            second = x - a.head - 1
        else:
            u, v = a.key[a.head + 1 : -1], b.key[b.head + 1 : -1]
            m = min(len(u), len(v))
            z = int.from_bytes(u[:m], "big") ^ int.from_bytes(v[:m], "big")
            second = m - (z.bit_length() + 7) // 8
        second = min(second, len(a.key) - a.head - 2, len(b.key) - b.head - 2)
        l, r = (first - gram, second + gram) if backward else (second, first)
        a.prove(length - r, l)
        b.prove(length - r, l)

    def merged(group: list) -> Iterator[_Entry]:
        def run(row):
            shared, rest, blob, t1, t2, head, flag = row
            load = zip(np.frombuffer(t1, np.int64).tolist(), np.frombuffer(t2, np.int64).tolist(), np.frombuffer(head, np.uint32).tolist(), np.frombuffer(flag, np.uint8).tolist())
            for (key, x), y in zip(front_decode(np.frombuffer(shared, np.uint32), np.frombuffer(rest, np.uint32), blob), load):
                yield key, x, y

        window: deque[tuple[_Entry, int]] = deque()  # (entry, common prefix with the newest)
        for key, x, load in merge_runs([run(r) for r in group]):
            new = _Entry(key, load, length, gram, backward)
            kept: deque[tuple[_Entry, int]] = deque()
            for e, y in window:
                y = min(x, y)
                if y < gram:
                    yield e
                else:
                    kept.append((e, y))
            window = kept
            if len(window) >= reach:  # these two are not compared
                old, y = window.popleft()
                old.unseen, new.unseen = max(old.unseen, min(y, old.head)), max(new.unseen, min(y, new.head))
                yield old
            for e, y in window:
                if e.t1 != new.t1 or e.t2 != new.t2:
                    meet(e, new, y)
                else:  # the segment was read twice: its text is there twice
                    e.prove(e.need_lo, e.need_hi)
                    new.prove(new.need_lo, new.need_hi)
            window.append((new, 1 << 30))
        for e, _ in window:
            yield e

    names = ["t1", "t2", "lo", "hi", "unseen"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32()]

    def run(batches):
        def close(group):
            rows = []
            for e in merged(group):
                if not e.guest:
                    rows.append((e.t1, e.t2, e.lo, e.hi, 0 if e.done else e.unseen))
                if len(rows) >= 8192:
                    yield out(rows)
                    rows = []
            if rows:
                yield out(rows)

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        at, group = None, []
        for batch in batches:
            cols = [batch.column(c) for c in range(8)]
            for i in range(batch.num_rows):
                rng = cols[0][i].as_py()
                if rng != at:
                    yield from close(group) if group else ()
                    at, group = rng, []
                group.append([c[i].as_py() for c in cols[1:]])
        if group:
            yield from close(group)

    return pieces.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(run, "t1 long, t2 long, lo array<int>, hi array<int>, unseen int")


def merge_sort(entries: DataFrame, length: int, gram: int, reach: int, backward: bool, range_bytes: int) -> DataFrame:
    """Sort entries across the cluster and compare neighbours (see ``neighbours``)."""
    total = entries.agg(F.sum(F.length("body")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    ranges = max(1, -(-(total.b or 0) // range_bytes))
    splitters: list[bytes] = []
    if ranges > 1:  # about 30 sampled strings for each cut, so a sample that is bounded by the number of ranges
        want = min(1.0, 30 * ranges / total.n)
        sample = entries.where(F.pmod(F.xxhash64("t1", "t2"), F.lit(1 << 20)) < F.lit(int(want * (1 << 20)) + 1)).select("before", "body").collect()
        keys = sorted(sort_key(bytes(r.body), r.before, gram, backward)[0] for r in sample)
        splitters = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
    pieces = sorted_pieces(entries, splitters, gram, reach, backward)
    return neighbours(pieces, len(splitters) + 1, length, gram, reach, backward)


def _settle(length: int):
    """Closed list of proven [lo, hi], and the windows still possible, per entry (native expressions)."""

    def union(pairs):
        """Merge sorted intervals that touch or overlap."""
        return F.aggregate(
            F.array_sort(pairs),
            F.array().cast("array<struct<lo:int,hi:int>>"),
            lambda acc, x: F.when((F.size(acc) > 0) & (x["lo"] <= F.element_at(acc, -1)["hi"] + 1), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["lo"].alias("lo"), F.greatest(F.element_at(acc, -1)["hi"], x["hi"]).alias("hi"))))).otherwise(F.concat(acc, F.array(x))),
        )

    return union


def closed(marked: DataFrame) -> DataFrame:
    """(did, uid, spans): spans that overlap or touch become one; in order of their start."""

    def run(batches):
        for batch in batches:
            spans = batch.column(2)
            row = np.repeat(np.arange(batch.num_rows, dtype=np.int64), np.diff(spans.offsets.to_numpy())) << 40
            flat = spans.flatten()
            a, z = (row + flat.field(c).to_numpy() for c in ("a", "z"))
            order = np.argsort(a, kind="stable")
            a, z = a[order], np.maximum.accumulate(z[order])
            new = np.flatnonzero(np.concatenate([[True], a[1:] > z[:-1]])) if len(a) else np.zeros(0, np.int64)
            a, z = a[new], z[np.concatenate([new[1:] - 1, [len(z) - 1]])] if len(new) else z
            sizes = np.bincount(a >> 40, minlength=batch.num_rows)
            low = (1 << 40) - 1
            runs = pa.StructArray.from_arrays([pa.array(a & low), pa.array(z & low)], names=["a", "z"])
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, runs)], names=["did", "uid", "spans"])

    return marked.select("did", "uid", "spans").mapInArrow(run, "did long, uid long, spans array<struct<a:long,z:long>>")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, reach: int = 32, range_bytes: int = RANGE_BYTES, within: DataFrame | None = None) -> DataFrame:
    """(did, uid, spans) of docs (did, uid, body): the runs of bytes that repeat, an array of (a, z), written as a table.

    ``within`` (did, uid, spans) are such runs for a length that is not greater: nothing beside them is searched.
    """
    if not 0 < gram <= length or length - gram > 1000:
        raise ValueError("gram must be at most length and at least length - 1000")
    spark = docs.sparkSession
    searched = docs
    if within is not None:
        long = within.select("did", "uid", F.filter("spans", lambda x: x["z"] - x["a"] >= length).alias("within"))
        searched = docs.where(F.length("body") >= length).join(long.where(F.size("within") > 0), ["did", "uid"])
    every, every_path = written(text_segments(searched, length, gram), "suffix-segments")
    often, often_path = written(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "suffix-anchors")
    seg, seg_path = written(every.join(often, "anchor"), "suffix-candidates")
    del every, often
    discard(spark, every_path, often_path)
    place = F.col("place")
    entry = seg.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("copies"), F.first("anchor").alias("anchor"), F.first("did").alias("did"), F.first("uid").alias("uid"), F.first("place").alias("place"))
    asked = entry.groupBy("did", "uid").agg(F.collect_list(F.struct("t1", "t2", "anchor", "copies", "place")).alias("asked"))
    cut = lambda x: F.struct(
        x["t1"].alias("t1"), x["t2"].alias("t2"), x["anchor"].alias("anchor"), x["copies"].alias("copies"), _before(x["place"]).cast("int").alias("before"),
        F.substring(F.col("body"), (_start(x["place"]) + 1).cast("int"), (_windows(x["place"]) + length - 1).cast("int")).alias("body"),
    )
    entries, entries_path = written(
        docs.where(F.length("body") >= length).select("did", "uid", "body").join(asked, ["did", "uid"]).select(F.explode(F.transform("asked", cut)).alias("e")).select("e.*"),
        "suffix-entries",
    )
    union = _settle(length)
    pairs = F.arrays_zip(F.col("lo"), F.col("hi"))
    forward, forward_path = written(merge_sort(entries, length, gram, reach, False, range_bytes), "suffix-forward")
    proven = forward.select("t1", "t2", pairs.alias("pairs"))
    open_anchor = forward.where("unseen > 0").select("t1", "t2").join(entries.select("t1", "t2", "anchor"), ["t1", "t2"]).select("anchor").distinct()
    hot, hot_path = written(entries.join(open_anchor, "anchor"), "suffix-hot")
    paths = [seg_path, forward_path, hot_path]
    del entries, open_anchor
    discard(spark, entries_path)
    if not hot.isEmpty():
        backward, backward_path = written(merge_sort(hot, length, gram, reach, True, range_bytes), "suffix-backward")
        paths.append(backward_path)
        proven = proven.union(backward.select("t1", "t2", pairs.alias("pairs")))
        bounds = forward.where("unseen > 0").select("t1", "t2", F.col("unseen").alias("right")).join(backward.where("unseen > 0").select("t1", "t2", (F.col("unseen") - gram).alias("left")), ["t1", "t2"])
        bounds = bounds.groupBy("t1", "t2").agg(F.max("right").alias("right"), F.max("left").alias("left"))
        known = proven.join(bounds, ["t1", "t2"], "left_semi").groupBy("t1", "t2").agg(union(F.flatten(F.collect_list("pairs"))).alias("pairs"))
        sizes = hot.select("t1", "t2", "anchor", "before", F.length("body").alias("size")).distinct()
        low = F.greatest(F.col("before") - F.col("size") + length, length - F.col("right"))
        still = (
            bounds.join(known, ["t1", "t2"]).join(sizes, ["t1", "t2"]).withColumns({"low": low, "high": F.least("before", "left")}).where("low <= high")
            .withColumn("need", F.explode(F.filter(F.sequence("low", "high"), lambda n: ~F.exists("pairs", lambda p: (p["lo"] <= n) & (n <= p["hi"])))))
        )
        open_windows = still.select("anchor", "need").distinct()
        windows = (
            hot.join(open_windows, "anchor").where((F.col("need") <= F.col("before")) & (F.col("need") >= F.col("before") - F.length("body") + length))
            .select("t1", "t2", "anchor", "need", F.sha2(F.substring(F.col("body"), F.col("before") - F.col("need") + 1, length), 256).alias("window")).distinct()
        )
        same = windows.groupBy("anchor", "need", "window").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        met = windows.join(same, ["anchor", "need", "window"]).select("t1", "t2", F.array(F.struct(F.col("need").alias("lo"), F.col("need").alias("hi"))).alias("pairs"))
        proven = proven.union(met)
    # A table of its own, so that the join below reads two plain exchanges and a hot segment is split (AQE).
    proven, proven_path = written(proven.where(F.size("pairs") > 0).groupBy("t1", "t2").agg(union(F.flatten(F.collect_list("pairs"))).alias("pairs")), "suffix-proven")
    anchor_at = _start(place) + _before(place)
    spans = F.transform("pairs", lambda p: F.struct((anchor_at - p["hi"]).alias("a"), (anchor_at - p["lo"] + length).alias("z")))
    marked = seg.select("did", "uid", "place", "t1", "t2").join(proven, ["t1", "t2"]).select("did", "uid", spans.alias("spans"))
    found = materialize(closed(marked.groupBy("did", "uid").agg(F.flatten(F.collect_list("spans")).alias("spans"))), "suffix-spans")
    del seg, forward, hot, proven, marked
    discard(spark, *paths, proven_path)
    return found


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM, reach: int = 32, range_bytes: int = RANGE_BYTES, as_text: bool = False, passage: int | None = None, passage_gram: int = PASSAGE_GRAM) -> DataFrame:
    """``docs`` with ``kept`` (the remaining bytes), n_bytes, n_removed, n_spans and kept_sha256.

    ``kept`` is binary; with ``as_text`` a string without the characters of
    which only some bytes are left (the other columns stay about the bytes).
    With ``passage`` (at most ``length``) a last column ``without_passages`` is
    what strings of that many bytes leave that start twice or more; its type is
    that of ``kept``, and no other column depends on it.
    Columns of the input with these names are replaced; all others pass unchanged.
    """
    if passage is not None and passage > length:
        raise ValueError("passage must be at most length")
    ship_package(docs.sparkSession)
    extra = [] if passage is None else ["without_passages"]
    new = ["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256", *extra]
    own = [c for c in docs.columns if c.lower() not in new]
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    id_hash = F.xxhash64(F.col(f"`{doc_id}`"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), id_hash.alias("did"), F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), F.lit(7)).alias("uid"), body.alias("body"))
    texts = keyed.select("did", "uid", "body")
    if passage is None:
        spans = repeated_spans(texts, length, gram, reach, range_bytes)
    else:
        passages = repeated_spans(texts, passage, passage_gram, reach, range_bytes)
        spans = repeated_spans(texts, length, gram, reach, range_bytes, passages)
        spans = passages.withColumnRenamed("spans", "passages").join(spans, ["did", "uid"], "left")
    marks = ["spans", *(["passages"] if extra else [])]
    joined = keyed.select("row", "did", "uid").join(spans, ["did", "uid"], "left")
    at = own.index(text)

    def left_of(t: bytes, gone: list | None) -> bytes:
        edges = [0, *(e for x in gone or () for e in (x["a"], x["z"])), len(t)]
        return b"".join(t[a:z] for a, z in zip(edges[::2], edges[1::2]))

    def cut(batches):
        for batch in batches:
            rows, found = batch.column(0), [batch.column(c).to_pylist() for c in range(1, batch.num_columns)]
            texts = rows.field(at).cast(pa.binary()).to_pylist()
            out: list[list] = [[] for _ in new]
            for t, gone, *shorter in zip(texts, *found):
                t = t or b""
                kept = left_of(t, gone)
                rest = [left_of(t, x) for x in shorter]
                shown, *rest = [x.decode("utf-8", "ignore") if as_text else x for x in (kept, *rest)]
                for c, v in zip(out, (shown, len(t), len(t) - len(kept), len(gone or ()), hashlib.sha256(kept).hexdigest(), *rest)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([*rows.flatten(), *(pa.array(c, k) for c, k in zip(out, arrow_kinds))], names=[*own, *new])

    body_kind, body_arrow = (T.StringType(), pa.string()) if as_text else (T.BinaryType(), pa.binary())
    kinds = [body_kind, T.LongType(), T.LongType(), T.LongType(), T.StringType(), *(body_kind for _ in extra)]
    arrow_kinds = [body_arrow, pa.int64(), pa.int64(), pa.int64(), pa.string(), *(body_arrow for _ in extra)]
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in own]).schema.fields, *(T.StructField(c, k) for c, k in zip(new, kinds))])
    return joined.select("row", *marks).mapInArrow(cut, schema)
