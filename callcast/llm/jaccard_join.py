"""N-gram Jaccard self-join by chosen paths.

A text is the set of its five-word shingles; two texts are linked when their
sets have a Jaccard similarity of at least ``threshold``.

1. *Classes.*  Texts with equal sets form one class; the join runs on one node
   per class, so exact copies are never compared.
2. *Chosen paths.*  Every node is embedded as min-hash tokens (position, value);
   a pair of similarity J shares a token with probability J.  Each of ``runs``
   runs starts one bucket per node from a token of its own and splits every
   bucket that holds more than ``small`` nodes: a hash of the bucket chooses
   positions, each with probability 1 / (threshold * tokens), and the nodes go
   to one child bucket per chosen token, so that a pair at the threshold is
   expected to share one child.  Buckets of one node vanish.  The number of
   runs follows from ``recall`` (see ``runs_needed``).
3. *Small buckets* are compared in full on the sketches; pairs that could reach
   the threshold (4 standard deviations of slack) become candidate links.
   Buckets that are still large after ``depth`` splits share so many sampled
   tokens that all their nodes are candidates of one another: a star of links.
4. *Exact check.*  Candidate links are closed into clusters.  Inside a cluster
   every pair of nodes is compared on its exact shingle sets, in blocks of
   ``block`` nodes, one task group per pair of blocks, which returns counts and
   a spanning forest of the true links, never the pairs.
5. *Result.*  One row per text: ``class_id`` (smallest doc_id among all texts
   connected by links or equal sets) and ``n_links`` (number of other texts
   within the threshold, copies included).

Defined results: null, empty and wordless texts have no shingles, no links and
their own doc_id as class; a text of fewer than five words has one shingle of
all its words.  A row with a null doc_id is returned with a null class and no
links.  Repeated rows count as copies.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcast.llm.components import components
from callcast.llm.textops import MUL, mix, shingle_set
from callcast.session import materialize, ship_package

TOKENS = 64
_SLACK = 4.0
#: Shares of rows: how many cells of the min-hash table are held at once.
_COLUMNS = 4096


def runs_needed(threshold: float, depth: int, recall: float) -> int:
    """Runs until a pair at the threshold is found with probability ``recall``.

    A run starts in a shared bucket with probability ``threshold``; each split
    keeps the pair together with probability 1 - exp(-p) (Poisson number of
    shared children of mean 1, each surviving with p).
    """
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold * p)))


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.arange(1, n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return mix(i) | np.uint64(1), mix(i + np.uint64(7919))


def min_hashes(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for s in range(0, len(shingles), _COLUMNS):
            part = shingles[s : s + _COLUMNS]
            np.minimum(out, (a[:, None] * part[None, :] + b[:, None]).min(axis=1), out=out)
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def shingled(docs: DataFrame, doc_id: str, text: str, width: int, runs: int) -> DataFrame:
    """doc_id, key (hash of the shingle set), n, roots (one token per run), sketch (TOKENS 16-bit tokens)."""

    def run(batches):
        a, b = _constants(TOKENS + runs)
        for batch in batches:
            n_rows = batch.num_rows
            key, n = np.zeros(n_rows, np.uint64), np.zeros(n_rows, np.int32)
            roots, sketches = [None] * n_rows, [None] * n_rows
            for i, t in enumerate(batch.column(1).to_pylist()):
                s = shingle_set(t, width)
                n[i] = len(s)
                if len(s):
                    key[i] = xxhash.xxh3_64_intdigest(s.tobytes())
                    m = min_hashes(s, a, b)
                    roots[i] = m[TOKENS:].view(np.int64)
                    sketches[i] = (mix(m[:TOKENS]) >> np.uint64(48)).astype(np.uint16).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _signed(key), pa.array(n), pa.array(roots, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["doc_id", "key", "n", "roots", "sketch"],
            )

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, key long, n int, roots array<long>, sketch binary")


def split_buckets(rows: DataFrame, threshold: float) -> DataFrame:
    """Children (bucket, node) of rows (buckets, level, node, tokens).

    At level 0 a node enters the bucket of each of its tokens; below, the bucket
    chooses token positions by its own hash.
    """

    def split(batches):
        share = 1.0 / (threshold * TOKENS)
        limit = np.uint64(int(share * 2.0**64))
        salt = mix(np.arange(1, TOKENS + 1, dtype=np.uint64))
        for batch in batches:
            if not batch.num_rows:
                continue
            root = batch.column(0).to_numpy(zero_copy_only=False)
            bucket = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            node = batch.column(2).to_numpy(zero_copy_only=False)
            if root[0]:
                at, pos = np.arange(len(node)), None
                child = bucket
            else:
                sk = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint16).reshape(-1, TOKENS)
                with np.errstate(over="ignore"):
                    chosen = mix(bucket[:, None] ^ salt[None, :]) < limit
                    at, pos = np.nonzero(chosen)
                    child = mix(bucket[at] * MUL + salt[pos] + sk[at, pos].astype(np.uint64) + np.uint64(1))
            yield pa.RecordBatch.from_arrays([_signed(np.ascontiguousarray(child)), pa.array(node[at])], names=["bucket", "node"])

    return rows.select("root", "bucket", "node", "sketch").mapInArrow(split, "bucket long, node long")


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of the buckets that hold at least two nodes, with the bucket's size and smallest node."""
    size = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("low")).where("size > 1")
    return rows.join(size, "bucket")


def compare_small(rows: DataFrame, small: int, threshold: float) -> DataFrame:
    """Candidate links (a, b) inside buckets of at most ``small`` nodes: a spanning forest of the similar pairs."""
    floor = TOKENS * threshold - _SLACK * math.sqrt(TOKENS * threshold * (1 - threshold))

    def compare(batches):
        tail_b, tail_n, tail_s = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, TOKENS), np.uint16)
        last = False
        stream = iter(batches)
        while not last:
            batch = next(stream, None)
            last = batch is None
            if not last:
                tail_b = np.concatenate([tail_b, batch.column(0).to_numpy(zero_copy_only=False)])
                tail_n = np.concatenate([tail_n, batch.column(1).to_numpy(zero_copy_only=False)])
                tail_s = np.concatenate([tail_s, np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint16).reshape(-1, TOKENS)])
            if not len(tail_b):
                continue
            cut = len(tail_b) if last else int(np.searchsorted(tail_b, tail_b[-1]))
            b, n, s = tail_b[:cut], tail_n[:cut], tail_s[:cut]
            tail_b, tail_n, tail_s = tail_b[cut:], tail_n[cut:], tail_s[cut:]
            parent = np.arange(len(b))

            def top(x):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            left, right = [], []
            for o in range(1, small):
                i = np.flatnonzero(b[o:] == b[:-o])
                if not len(i):
                    break
                near = i[(s[i] == s[i + o]).sum(axis=1) >= floor]
                for x in near.tolist():
                    p, r = top(x), top(x + o)
                    if p != r:
                        parent[p] = r
                        left.append(x)
                        right.append(x + o)
            yield pa.RecordBatch.from_arrays([pa.array(n[left]), pa.array(n[right])], names=["a", "b"])

    return rows.select("bucket", "node", "sketch").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(compare, "a long, b long")


def candidates(nodes: DataFrame, threshold: float, small: int, depth: int) -> DataFrame:
    """Candidate links (a, b) between nodes (key, roots, sketch)."""
    sketches = nodes.select(F.col("key").alias("node"), "sketch")
    first = nodes.select(F.lit(True).alias("root"), F.posexplode("roots").alias("run", "token"), F.col("key").alias("node"), F.lit(None).cast("binary").alias("sketch"))
    rows = first.select("root", F.xxhash64("run", "token").alias("bucket"), "node", "sketch")
    found = None
    for level in range(depth + 1):
        sized = materialize(_sized(split_buckets(rows, threshold)), "jaccard-buckets")
        links = compare_small(sized.where(F.col("size") <= small).join(sketches, "node"), small, threshold)
        large = sized.where(F.col("size") > small)
        if level == depth:
            links = links.union(large.select(F.col("low").alias("a"), F.col("node").alias("b")))
        found = links if found is None else found.union(links)
        if large.isEmpty():
            break
        rows = large.join(sketches, "node").select(F.lit(False).alias("root"), "bucket", "node", "sketch")
    return found


def exact_links(members: DataFrame, threshold: float, width: int) -> DataFrame:
    """Exact comparison inside every (cluster, i, j) group of members (key, copies, part, text).

    Rows (a, b, n): b null: ``a`` has links to n texts of this group; else a true link of the spanning forest.
    """

    def one(part: np.ndarray, key: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], same: bool):
        k = len(key)
        size = np.array([len(s) for s in sets], dtype=np.float64)
        if k == 2:
            both = np.zeros((2, 2))
            both[0, 1] = both[1, 0] = np.intersect1d(sets[0], sets[1], assume_unique=True).size
        else:
            owner = np.repeat(np.arange(k), size.astype(np.int64))
            _, column = np.unique(np.concatenate(sets), return_inverse=True)
            often = np.bincount(column) > 1
            keep = often[column]
            owner, column = owner[keep], (np.cumsum(often) - 1)[column[keep]]
            order = np.argsort(column, kind="stable")
            owner, column = owner[order], column[order]
            both = np.zeros((k, k), dtype=np.float32)
            for c in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
                lo, hi = np.searchsorted(column, [c, c + _COLUMNS])
                dense = np.zeros((k, _COLUMNS), dtype=np.float32)
                dense[owner[lo:hi], column[lo:hi] - c] = 1
                both += dense @ dense.T
        linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-6
        np.fill_diagonal(linked, False)
        if not same:
            linked &= part[:, None] != part[None, :]
        counts = (linked * copies[None, :]).sum(axis=1)
        seen = np.zeros(k, dtype=bool)
        forest = []
        for s in range(k):
            if seen[s]:
                continue
            seen[s], stack = True, [s]
            while stack:
                x = stack.pop()
                new = np.flatnonzero(linked[x] & ~seen)
                seen[new] = True
                forest += [(int(key[x]), int(key[y])) for y in new]
                stack += new.tolist()
        return [(int(a), None, int(c)) for a, c in zip(key, counts) if c] + [(a, b, 0) for a, b in forest]

    def check(batches):
        at, group = None, []

        def close():
            rows: dict[int, tuple] = {}
            for key, copies, part, text in group:
                if key not in rows:
                    s = shingle_set(text, width)
                    if len(s) and np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64) == key:
                        rows[key] = (part, copies, s)
            if len(rows) < 2:
                return []
            keys = sorted(rows)
            return one(np.array([rows[x][0] for x in keys]), np.array(keys), np.array([rows[x][1] for x in keys], dtype=np.float64), [rows[x][2] for x in keys], at[1] == at[2])

        def batch_of(out):
            a, b, n = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])

        for batch in batches:
            cluster, i, j, key, copies, part = (batch.column(c).to_pylist() for c in range(6))
            texts = batch.column(6)
            for r in range(batch.num_rows):
                here = (cluster[r], i[r], j[r])
                if here != at:
                    if len(group) > 1 and (out := close()):
                        yield batch_of(out)
                    at, group = here, []
                group.append((key[r], copies[r], part[r], texts[r].as_py()))
        if len(group) > 1 and (out := close()):
            yield batch_of(out)

    return members.select("cluster", "i", "j", "key", "copies", "part", "text").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(check, "a long, b long, n long")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    width: int = 5,
    recall: float = 0.999,
    small: int = 32,
    depth: int = 3,
    block: int = 512,
) -> DataFrame:
    """One row per document: doc_id, class_id, n_links (see the module text)."""
    ship_package(docs.sparkSession)
    runs = runs_needed(threshold, depth, recall)
    sets = materialize(shingled(docs, doc_id, text, width, runs), "jaccard-sets")
    nodes = materialize(
        sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("roots").alias("roots"), F.first("sketch").alias("sketch")),
        "jaccard-nodes",
    )
    cluster = components(candidates(nodes, threshold, small, depth), "jaccard-candidates").select(F.col("node").alias("key"), F.col("root").alias("cluster"))
    sizes = cluster.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    placed = cluster.join(sizes, "cluster").join(nodes.select("key", "first_id", "copies"), "key").withColumn("part", F.pmod(F.xxhash64("key", F.lit(1)), F.col("parts")).cast("int"))
    texts = docs.select(F.col(f"`{doc_id}`").alias("first_id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    spread = placed.join(texts, "first_id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    members = spread.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
    checked = materialize(exact_links(members, threshold, width), "jaccard-links")
    links = checked.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "key")
    comp = components(checked.where("b IS NOT NULL").select("a", "b"), "jaccard-classes").select(F.col("node").alias("key"), "root")
    info = nodes.select("key", "first_id", "copies").join(comp, "key", "left").join(links, "key", "left").withColumn("root", F.coalesce("root", "key"))
    lowest = info.where("key != root OR links > 0").groupBy("root").agg(F.min("first_id").alias("class_id"))
    known = info.join(lowest, "root", "left").select("key", F.coalesce("class_id", "first_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    own = F.col("n").isNotNull() & (F.col("n") > 0) & F.col("doc_id").isNotNull()
    joined = sets.select("doc_id", "n", F.when(own, F.col("key")).alias("key")).where(own).join(known, "key")
    rest = sets.where(~own).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return joined.select("doc_id", "class_id", "n_links").union(rest)


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """``docs`` with one document of each class: the one whose doc_id is the class id.

    Rows with a null doc_id stay; rows that share a doc_id stay or go together.
    """
    classes = near_duplicates(docs, doc_id, text, **params)
    gone = classes.where("doc_id != class_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col(f"`{doc_id}`") == F.col("_gone"), "left_anti")
