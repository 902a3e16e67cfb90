"""URL filter: a blocked Bloom filter in front of an exact hash join.

Listed URLs are compared in canonical form.  The filter has a fixed number of
blocks of 256 bits; a URL sets, and is looked up by, four bits of one block (one
in each 64-bit word).  Its size is a parameter and does not grow with the list,
so it can always be sent to every task; a list too long for it only lets more
URLs through to the exact join, which removes the false positives.  Only the
URLs that pass the filter are shuffled.

On top, path rules (host, path, allow or block) fit a host and all its
subdomains when the URL's path starts with the rule's path; the longest rule
wins over the list (block wins between rules of one length).

Defined results: a null URL, or one without "://", has an empty host and path
and fits no rule; it is listed only if it is itself in the list (a null never
is).  Repeated URLs and list entries are fine; empty tables give an empty
result or let everything pass.  Input columns with the names of result columns
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 1 << 14
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a leading www., m. or blog. label and path without a last slash, index page or .html; no scheme, query or fragment."""
    host = F.regexp_replace(host_of(url), r"^(www|m|blog)\.", "")
    path = F.regexp_replace(path_of(url), r"(/index)?(\.html?)?/*$", "")
    return F.when(url.contains("://"), F.concat(host, path)).otherwise(url)


def _block(h: Column, blocks: int) -> Column:
    return F.pmod(h, F.lit(blocks)).cast("int")


def _bit(url: Column, word: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(url, F.lit(word + 1)), F.lit(64)).cast("int"))


def bloom(listed: DataFrame, url: str, blocks: int = BLOCKS) -> DataFrame:
    """(block, w0..w3): at most ``blocks`` rows, whatever the length of the list."""
    c = F.col(url)
    bits = listed.select(_block(F.xxhash64(c), blocks).alias("block"), *[_bit(c, i).alias(f"w{i}") for i in range(4)])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def listed_flag(urls: DataFrame, url: str, listed: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``urls`` with ``listed``: is the canonical form of ``url`` among those of ``listed`` (column ``url``)?"""
    wanted = listed.select(canonical(F.col("url")).alias("_canon")).where("_canon IS NOT NULL").distinct()
    table = bloom(wanted, "_canon", blocks)
    rows = urls.withColumn("_canon", canonical(F.col(f"`{url}`")))
    c = F.col("_canon")
    probed = rows.withColumn("_block", _block(F.xxhash64(c), blocks)).join(F.broadcast(table.withColumnRenamed("block", "_block")), "_block", "left")
    hit = F.lit(True)
    for i in range(4):
        hit = hit & (F.col(f"w{i}").bitwiseAND(_bit(c, i)) != 0)
    probed = probed.withColumn("_hit", F.coalesce(hit & c.isNotNull(), F.lit(False))).drop("_block", *[f"w{i}" for i in range(4)])
    passed = probed.where("_hit").join(wanted.withColumn("_in", F.lit(True)), "_canon", "left").withColumn("listed", F.coalesce("_in", F.lit(False))).drop("_in", "_hit", "_canon")
    clear = probed.where("NOT _hit").withColumn("listed", F.lit(False)).drop("_hit", "_canon")
    return passed.select(*clear.columns).union(clear)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (host, path, verdict) that fits, else nulls."""
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "block", r[0] + r[1]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in reversed(order):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def judge(urls: DataFrame, url: str, listed: DataFrame, rules: list[tuple[str, str, str]] = (), blocks: int = BLOCKS) -> DataFrame:
    """``urls`` with host, path, listed, rule and verdict (the rule's, else block if listed, else allow)."""
    new = ("host", "path", "listed", "rule", "verdict")
    own = [c for c in urls.columns if c.lower() not in new or c == url]
    flagged = listed_flag(urls.select(*[F.col(f"`{c}`") for c in own]), url, listed, blocks)
    c = F.col(f"`{url}`")
    out = flagged.withColumns({"host": host_of(c), "path": path_of(c)})
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), list(rules))
    return out.withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")))
