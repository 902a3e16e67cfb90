"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is a weighted set: its shingles of ``WIDTH`` words with their counts.
Every (term, weight) draws gamma(2,1) variables r and c and a uniform b from
hashes of the term, quantises its weight to y = exp(r * (floor(ln w / r + b) - b))
and gets the value a = c / (y * exp(r)); of all terms the one with the smallest
value is the sample, and two sets draw the same sample with a probability equal
to their generalised Jaccard similarity (sum of smaller / sum of larger
weights).  The value a determines the term and its quantised weight, so a hash
of the smallest a stands for the sample.

To have ``BINS`` samples for one pass over the terms, a term spreads its weight
over the bins: one unit of weight to each of the bins in turn, from the one that
its hash names, round after round.  So in a bin that the term has reached k times
it is a term of weight k, with draws of its own for that bin, and a term takes at
most one row for each bin, however often it repeats.  The share of a smaller
weight in each bin is at most that of a larger one, so the sums of smaller and
larger weights stay as they are, and all bins hold nearly the same weight, so that
each may count as one vote.  Each bin keeps its own smallest value; bins without
weight stay empty.  The likeness of two fingerprints is the share of equal bins
among the bins that are filled in either (1 if none is).

Neighbours in doc_id order are found without a sort of the whole table into one
task: documents are dealt by blocks of ids, and the last document of a block
gets the first one of the next block.

Defined results: a null text is empty; an empty or blank text has an empty
fingerprint; a text of fewer than WIDTH words has one term of all its words; a
null id sorts before all others; rows that share an id are ordered by their
text; a single document is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 5
BINS = 128
_BLOCK_BITS = 10
_FIRST = -(1 << 63)


def terms(text: Column, width: int = WIDTH) -> Column:
    """Weighted terms of a text as array<struct<h, n>>: a hash of the words and their count."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"\s+"))
    return F.transform(F.array(words), lambda ws: _counted(_shingles(ws, width)))[0]


def _shingles(words: Column, width: int) -> Column:
    n = F.size(words)
    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n - (width - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, width))))


def _counted(hashes: Column) -> Column:
    """Distinct hashes with their counts; the sort runs only where a hash repeats."""
    once = lambda h: F.transform(h, lambda x: F.struct(x.alias("h"), F.lit(1).alias("n")))
    return F.transform(F.array(hashes), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), once(h)).otherwise(F.transform(F.array(F.array_sort(h)), _runs)[0]))[0]


def _runs(s: Column) -> Column:
    """Distinct values of a sorted array with their counts."""
    starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
    return F.transform(F.array(starts), lambda p: F.transform(p, lambda a, k: F.struct(F.get(s, a).alias("h"), (F.coalesce(F.get(p, k + 1), F.size(s)) - a).alias("n"))))[0]


def spread(weighted: Column, bins: int = BINS) -> Column:
    """The terms dealt over the bins: array<struct<h, bin, n>>, one entry for each term and bin that it reaches."""
    first = lambda e: F.pmod(F.xxhash64(e["h"], F.lit(6)), F.lit(bins)).cast("int")
    entry = lambda e, at, n: F.struct(e["h"].alias("h"), at.alias("bin"), n.alias("n"))
    turn = lambda e: F.transform(
        F.sequence(F.lit(0), F.least(e["n"], F.lit(bins)) - 1), lambda j: entry(e, F.pmod(first(e) + j, F.lit(bins)), F.floor((e["n"] - 1 - j) / bins).cast("int") + 1)
    )
    single = lambda e: entry(e, first(e), F.lit(1))
    return F.transform(F.array(weighted), lambda x: F.when(F.exists(x, lambda e: e["n"] > 1), F.flatten(F.transform(x, turn))).otherwise(F.transform(x, single)))[0]


def _uniform(term: Column, salt: int) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(term, F.lit(salt)), 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)


def sample_value(term: Column, weight: Column) -> Column:
    """ln a of a weighted term (see the module text)."""
    r = -F.ln(_uniform(term, 1) * _uniform(term, 2))
    c = -F.ln(_uniform(term, 3) * _uniform(term, 4))
    b = _uniform(term, 5)
    heavy = F.when(weight == 1, F.lit(0.0)).otherwise(F.ln(weight.cast("double")))
    t = F.floor(heavy / r + b).cast("double")
    return F.ln(c) - r * (t - b) - r


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bins among those filled in either of two arrays of (bin << 16 | digest)."""
    bins = lambda x: F.transform(x, lambda v: F.shiftright(v, 16))
    filled = F.size(F.array_union(bins(a), bins(b)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def as_text(a: Column) -> Column:
    """Six hex digits for each filled bin: two for the bin, four for the sample's digest."""
    return F.array_join(F.transform(a, lambda v: F.lower(F.lpad(F.hex(v), 6, "0"))), "")


def with_neighbours(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (block, place, doc_id, text, next_id, next_text, last): each document with the next in id order, wrapping round.

    All uses of the dealt rows read the same columns, so they share one exchange of the texts.
    """
    key = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_FIRST))
    rows = docs.select(F.shiftright(key, _BLOCK_BITS).alias("block"), key.alias("key"), F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    near = Window.partitionBy("block").orderBy("key", "text")
    dealt = rows.select("block", F.row_number().over(near).alias("place"), "doc_id", "text", F.lead("doc_id").over(near).alias("next_id"), F.lead("text").over(near).alias("next_text"))
    blocks = rows.select("block").distinct().withColumn("over", F.shiftright("block", _BLOCK_BITS))
    tops = blocks.groupBy("over").agg(F.min("block").alias("top"))  # one row for each million of ids
    every = Window.orderBy("over")
    tops = tops.select("over", F.coalesce(F.lead("top").over(every), F.first("top").over(every)).alias("next_top"))
    follows = blocks.join(tops, "over").select("block", F.coalesce(F.lead("block").over(Window.partitionBy("over").orderBy("block")), "next_top").alias("next_block"))
    firsts = dealt.where("place = 1").select(F.col("block").alias("next_block"), F.col("doc_id").alias("first_id"), F.col("text").alias("first_text"))
    guests = follows.join(firsts, "next_block").select(F.col("block").alias("_b"), "first_id", "first_text")
    last = F.col("next_text").isNull()
    joined = dealt.join(guests, (F.col("block") == F.col("_b")) & last, "left")
    then = lambda own, guest: F.when(last, F.col(guest)).otherwise(F.col(own))
    return joined.select("block", "place", "doc_id", "text", then("next_id", "first_id").alias("next_id"), then("next_text", "first_text").alias("next_text"), last.alias("last"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, bins: int = BINS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next_id.

    The edited text has its last quarter of code points replaced by the first as
    many (or all) of the next document.
    """
    rows = with_neighbours(docs, doc_id, text)
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    rows = rows.withColumn("edited", edited)
    facts = rows.select("block", "place", "doc_id", "next_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))

    # A document takes three seats of its block: its text, its edited text and, for the last of a block, the text that follows.
    seat = lambda v, t: F.struct((F.col("place") * 3 + v).alias("seat"), t.alias("t"))
    versions = rows.select("block", "doc_id", F.explode(F.array(seat(0, F.col("text")), seat(1, F.col("edited")), seat(2, F.when(F.col("last"), F.col("next_text"))))).alias("x")).where("x.t IS NOT NULL")
    weighted = versions.select("block", "doc_id", "x.seat", F.explode_outer(spread(terms(F.col("x.t"), width), bins)).alias("e"))
    term = F.xxhash64("e.h", "e.bin")
    values = weighted.select("block", "doc_id", "seat", F.col("e.bin").alias("bin"), F.when(F.col("e").isNotNull(), sample_value(term, F.col("e.n"))).alias("a"))
    least = values.groupBy("block", "doc_id", "seat", "bin").agg(F.min("a").alias("a"))
    digest = F.call_function("shiftleft", F.col("bin"), F.lit(16)).bitwiseOR(F.pmod(F.xxhash64("a"), F.lit(65536)).cast("int"))
    seated = least.select("block", "doc_id", F.floor(F.col("seat") / 3).cast("int").alias("place"), (F.col("seat") % 3).alias("v"), F.when(F.col("a").isNotNull(), digest).alias("d"))
    sets = [F.array_sort(F.collect_list(F.when(F.col("v") == v, F.col("d")))).alias(f"p{v}") for v in range(3)]
    prints = seated.groupBy("block", "doc_id", "place").agg(*sets)
    order = Window.partitionBy("block").orderBy("place")
    prints = prints.withColumn("following", F.coalesce(F.lead("p0").over(order), "p2")).drop("p2")
    return facts.join(prints.drop("doc_id"), ["block", "place"]).select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("p0")).alias("fingerprint"), as_text(F.col("p1")).alias("edited_fingerprint"),
        likeness(F.col("p0"), F.col("p1")).alias("near_edited"), likeness(F.col("p0"), F.col("following")).alias("near_next"), "next_id",
    )
