"""Benchmark decontamination by q-gram lemma filtering.

An item of ``m`` characters that occurs in a text with at most ``k`` edits
shares at least ``m - q + 1 - k*q`` of its character q-grams with the place, and
these lie on diagonals (text position - item position) that differ by at most
``k``.  So, per text and item, shared q-grams are counted in overlapping bands
of diagonals; bands that reach the bound are kept, and each kept region is
verified by a banded alignment that gives its exact number of edits.

Texts and items are compared in lower case with runs of white space as one
blank; ``k`` is ``rate`` of the item's length, or less where a bound of at least
one shared q-gram needs it.  The texts are scanned whole, in Arrow batches, and
are never shuffled.  The items are sent to the tasks in blocks of at most
``block_chars`` characters, so a large benchmark takes more scans, not more
memory.

Defined results: null and empty texts match nothing; items that are null or
have fewer than ``min_chars`` characters (after the white-space rule) are not
evidence and match nothing; equal items are all reported; repeated documents
are each reported; several occurrences in one text are several rows; an empty
table on either side gives an empty result.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callcast.llm.textops import MUL, code_points, rolling
from callcast.session import ship_package

Q = 10
RATE = 0.08
MIN_CHARS = 24
BLOCK_CHARS = 2_000_000
_CHUNK_CHARS = 1 << 17
_BITS = 20

_LOWER: np.ndarray | None = None
_SPACE: np.ndarray | None = None


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower-case form (if that is one character), and whether it is white space."""
    global _LOWER, _SPACE
    if _LOWER is None:
        _LOWER = np.fromiter((ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(map(chr, range(0x110000)))), dtype=np.uint32, count=0x110000)
        _SPACE = np.fromiter((chr(i).isspace() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LOWER, _SPACE


def normalize(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised code points of all texts, their places in the raw code points, and offsets."""
    lower, space = _tables()
    codes, off = code_points(texts)
    blank = space[codes]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[off[:-1][off[:-1] < len(codes)]] = True
    place = np.flatnonzero(keep)
    codes = np.where(blank, np.uint32(32), lower[codes])[place]
    return codes, place, np.searchsorted(place, off)


def edit_budget(m: int, q: int = Q, rate: float = RATE) -> int:
    return max(0, min(int(m * rate), (m - q) // q))


class ItemIndex:
    """The q-grams of a block of items, looked up for many text positions at once."""

    def __init__(self, items: list[tuple[int, str]], q: int, rate: float, min_chars: int):
        self.q = q
        self.ids, self.codes, grams, owner, pos = [], [], [], [], []
        for item_id, text in items:
            codes = normalize([(text or "").strip()])[0]
            if len(codes) < max(min_chars, q):
                continue
            h = rolling(codes, q)
            grams.append(h)
            owner.append(np.full(len(h), len(self.ids), dtype=np.int32))
            pos.append(np.arange(len(h), dtype=np.int32))
            self.ids.append(item_id)
            self.codes.append(codes)
        self.k = np.array([edit_budget(len(c), q, rate) for c in self.codes], dtype=np.int64)
        self.need = np.array([max(1, len(c) - q + 1 - k * q) for c, k in zip(self.codes, self.k)], dtype=np.int64)
        self.band = np.array([max(16, 1 << int(k).bit_length()) for k in self.k], dtype=np.int64)
        if not self.ids:
            return
        h, owner, pos = np.concatenate(grams), np.concatenate(owner), np.concatenate(pos)
        order = np.argsort(h, kind="stable")
        h, self.owner, self.pos = h[order], owner[order], pos[order]
        self.keys, self.first, self.count = np.unique(h, return_index=True, return_counts=True)
        self.seen = np.zeros(1 << _BITS, dtype=bool)
        self.seen[self._cell(self.keys)] = True

    @staticmethod
    def _cell(h: np.ndarray) -> np.ndarray:
        return (h * MUL) >> np.uint64(64 - _BITS)

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into h, item number, item position) of every shared q-gram."""
        at = np.flatnonzero(self.seen[self._cell(h)])
        slot = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[slot] == h[at]
        at, slot = at[same], slot[same]
        n = self.count[slot]
        total = int(n.sum())
        shift = np.repeat(self.first[slot] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if total else np.empty(0, np.int64)
        entry = np.arange(total) + shift
        return np.repeat(at, n), self.owner[entry], self.pos[entry]


def banded_edits(item: np.ndarray, text: np.ndarray, first_diag: int, width: int, anchored: bool = False) -> tuple[int, int]:
    """Fewest edits of ``item`` against a part of ``text``, and the end of that part.

    Only cells on the diagonals first_diag .. first_diag+width-1 are filled.
    The part may start anywhere in the band, or at 0 only if ``anchored``.
    """
    big = 1 << 20
    d = np.arange(first_diag, first_diag + width)
    ramp = np.arange(width)
    row = np.where((d >= 0) & (d <= len(text)), np.abs(d) if anchored else 0, big)
    for j, c in enumerate(item):
        at = d + j
        inside = (at >= 0) & (at < len(text))
        differs = np.ones(width, dtype=np.int64)
        differs[inside] = text[at[inside]] != c
        new = np.where(inside, row + differs, big)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        end = at + 1
        new = np.where((end >= 0) & (end <= len(text)), new, big)
        row = np.minimum.accumulate(new - ramp) + ramp
        row = np.where((end >= 0) & (end <= len(text)), row, big)
    best = int(row.argmin())
    return int(row[best]), int(d[best] + len(item))


def find(texts: list[str], index: ItemIndex) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, item id, start, end, edits); start and end in code points of the raw text."""
    if not index.ids or not texts:
        return
    codes, place, off = normalize(texts)
    h = rolling(codes, index.q)
    at, item, j = index.hits(h)
    doc = np.searchsorted(off, at, side="right") - 1
    inside = at + index.q <= off[doc + 1]
    at, item, j, doc = at[inside], item[inside], j[inside], doc[inside]
    if not len(at):
        return
    diag = at - j + (1 << 20)
    width, k = index.band[item], index.k[item]
    band = diag // width
    twice = (diag % width <= k) & (band > 0)
    keys = np.stack([np.concatenate([doc, doc[twice]]), np.concatenate([item, item[twice]]), np.concatenate([band, band[twice] - 1])]).astype(np.int64)
    pos = np.concatenate([j, j[twice]])
    dg = np.concatenate([diag, diag[twice]])
    order = np.lexsort((pos, keys[2], keys[1], keys[0]))
    keys, pos, dg = keys[:, order], pos[order], dg[order]
    new_band = np.ones(len(pos), dtype=bool)
    new_band[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    new_pos = new_band.copy()
    new_pos[1:] |= pos[1:] != pos[:-1]
    starts = np.flatnonzero(new_band)
    distinct = np.add.reduceat(new_pos.astype(np.int64), starts)
    ends = np.append(starts[1:], len(pos))
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for s in np.flatnonzero(distinct >= index.need[keys[1, starts]]):
        d, it, b = (int(x) for x in keys[:, starts[s]])
        lo, hi = int(off[d]), int(off[d + 1])
        pattern, w, k = index.codes[it], int(index.band[it]), int(index.k[it])
        m = len(pattern)
        seen, often = np.unique(dg[starts[s] : ends[s]], return_counts=True)
        main = int(seen[often.argmax()]) - (1 << 20)
        if main >= lo and main + m <= hi and np.array_equal(codes[main : main + m], pattern):
            span = (0, main, main + m)
        else:
            left = b * w - (1 << 20) - k
            a, z = max(lo, left), min(hi, left + w + 3 * k + m + 1)
            part = codes[a:z]
            edits, end = banded_edits(pattern, part, left - a, w + 3 * k + 1)
            if edits > k:
                continue
            back, length = banded_edits(pattern[::-1], part[:end][::-1], -k, 2 * k + 1, anchored=True)
            span = (min(edits, back), a + end - length, a + end)
        found.setdefault((d, it), []).append(span)
    for (d, it), spans in sorted(found.items()):
        taken: list[tuple[int, int, int]] = []
        for edits, a, z in sorted(set(spans)):  # of overlapping places the one with the fewest edits
            if all(z <= x or a >= y for _, x, y in taken):
                taken.append((edits, a, z))
        base = int(np.searchsorted(place, place[off[d]])) if off[d] < len(place) else 0
        raw0 = place[base] if len(place) else 0
        for edits, a, z in sorted(taken, key=lambda t: t[1]):
            yield d, index.ids[it], int(place[a] - raw0), int(place[z - 1] + 1 - raw0), edits


def _chunks(texts: list[str]):
    start, chars = 0, 0
    for i, t in enumerate(texts):
        if i > start and chars + len(t) > _CHUNK_CHARS:
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of bounded size, read partition by partition."""
    block, chars = [], 0
    for r in benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("t IS NOT NULL").toLocalIterator():
        if block and chars + len(r.t) > block_chars:
            yield block
            block, chars = [], 0
        block.append((r.i, r.t))
        chars += len(r.t)
    if block:
        yield block


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    q: int = Q,
    rate: float = RATE,
    min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per occurrence: doc_id, item_id, start, end (code points), edits."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    id_type, item_type = rows.schema["doc_id"].dataType, benchmark.schema[item_id].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("item_id", item_type), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("edits", T.LongType())])
    out = None
    for block in item_blocks(benchmark, item_id, item_text, block_chars):
        sent = spark.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            index = ItemIndex(sent.value, q, rate, min_chars)
            for batch in batches:
                ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
                got = [(a + d, i, s, e, n) for a, b in _chunks(texts) for d, i, s, e, n in find(texts[a:b], index)]
                cols = list(zip(*got)) if got else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(cols[0], pa.int64())), *(pa.array(c, t) for c, t in zip(cols[1:], (_arrow(item_type), pa.int64(), pa.int64(), pa.int64())))],
                    names=["doc_id", "item_id", "start", "end", "edits"],
                )

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", q: int = Q, rate: float = RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without those in which any item occurs; rows and columns pass unchanged, nothing is shuffled."""
    spark = docs.sparkSession
    ship_package(spark)
    at = docs.columns.index(text)
    for block in item_blocks(benchmark, item_id, item_text, block_chars):
        sent = spark.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            index = ItemIndex(sent.value, q, rate, min_chars)
            for batch in batches:
                texts = [t or "" for t in batch.column(at).to_pylist()]
                bad = {a + d for a, b in _chunks(texts) for d, *_ in find(texts[a:b], index)}
                yield batch.filter(pa.array([i not in bad for i in range(len(texts))], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
