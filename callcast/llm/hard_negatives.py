"""Hard-negative mining with a GNAT-style multiway hyperplane tree.

Vectors are compared by the integer inner product of floor(``scale`` * c).  Every anchor
row gets its first ``positives`` other rows of its label, and for each of them the first
``negatives`` rows of other labels whose score lies in a window below the positive's.
First means a higher score, then a smaller id.  Results are exact.

1. *Tree.*  Split points come from a bounded sample (``sample_rows`` rows by a hash of the
   row): at each node a few far-apart rows (each the farthest from those before).  A row
   belongs to the split point nearest to it, so the cells are bounded by hyperplanes.  Every
   row is filed in its cell; a cell is cut into *leaves* of about ``leaf_rows`` rows, so one
   dense cell, or one vector that a third of the rows hold, is many leaves.
2. *Ranges.*  Each split point stores the least and largest distance to the rows of every
   sibling subtree (over all rows, not the sample), and each subtree its range of norms.
3. *Search.*  An inner product window of an anchor is an annulus around it: distances between
   |q|^2 + |x|^2 - 2 * high and |q|^2 + |x|^2 - 2 * low.  By the triangle inequality a split
   point's range bounds the distance of a whole sibling subtree from the anchor; a subtree
   whose bounds miss the annulus is eliminated.  Leaves that remain are compared in full.
   The window's lower end first comes from one leaf of the anchor's own cell (the score of
   its fifth-best row there), which no better row can be below.
4. *Jobs.*  Anchors travel in packed blocks of their cell to the leaves they still need, so
   pairs of (block of anchors, leaf) are rows, never pairs of vectors; candidates at or above
   the bound are ranked by a window whose limit is applied before the shuffle.

What the tree cannot eliminate (in many dimensions without clusters, nearly nothing) is
compared in blocks: the stated anchors against all rows.

Defined results: rows with a null id, label or vector, a null or non-finite component, a
component beyond +-2^25 after scaling, or a vector whose length is not the commonest (of
equally common ones the longest) take no part.  Rows that repeat in id, label and vector
count once; other rows that share an id are rows of their own, in the order of a hash of
the row.  Anchors without another row of their label, and empty tables, give no rows.
Other columns of the input play no part, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callcast.session import materialize, ship_package

LIMIT = 1 << 25
#: Anchors that are compared with a leaf at once.
_SLICE = 128
_FAR = np.iinfo(np.int64).max
_NONE = np.iinfo(np.int64).min


# ---------------------------------------------------------------- the tree
@dataclass
class Node:
    """``points``: split points (m x d); ``children``: a Node or the number of a cell for each of them."""

    points: np.ndarray
    children: list


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of a with all rows of b."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def norms(a: np.ndarray) -> np.ndarray:
    a = a.astype(np.int64)
    return (a * a).sum(axis=1)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return norms(a)[:, None] + norms(b)[None, :] - 2 * products(a, b)


def far_apart(x: np.ndarray, m: int) -> np.ndarray:
    """Numbers of up to ``m`` different rows: the farthest from the mean, then each the farthest from those chosen."""
    middle = np.rint(x.mean(axis=0)).astype(np.int64)
    chosen = [int(squared_distances(x, middle[None])[:, 0].argmax())]
    near = squared_distances(x, x[chosen])[:, 0]
    while len(chosen) < m and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared_distances(x, x[chosen[-1:]])[:, 0])
    return np.array(chosen)


def build(sample: np.ndarray, fan_out: int, depth: int) -> tuple[Node, int]:
    """The tree over a sample, and its number of cells."""
    cells = 0

    def grow(x: np.ndarray, level: int):
        nonlocal cells
        if level and (level == depth or len(x) < 4 * fan_out):
            cells += 1
            return cells - 1
        points = x[far_apart(x, fan_out)]
        own = squared_distances(x, points).argmin(axis=1)
        return Node(points, [grow(x[own == j], level + 1) for j in range(len(points))])

    return grow(sample, 0), cells


def paths(node: Node, above: tuple = ()) -> dict[int, tuple]:
    """Cell -> ((node, child number), ...) from the root down."""
    out = {}
    for j, child in enumerate(node.children):
        step = (*above, (node, j))
        out.update(paths(child, step) if isinstance(child, Node) else {child: step})
    return out


def descend(node: Node, x: np.ndarray) -> np.ndarray:
    """Cell of every row."""
    out = np.empty(len(x), dtype=np.int64)
    own = squared_distances(x, node.points).argmin(axis=1)
    for j, child in enumerate(node.children):
        at = own == j
        if at.any():
            out[at] = descend(child, x[at]) if isinstance(child, Node) else child
    return out


# ---------------------------------------------------------------- ranges and elimination
@dataclass
class Ranges:
    """For every node (by its path) and child: least and largest squared distance to each split point, and squared norms."""

    low: dict
    high: dict
    norm: dict
    leaves: dict  # cell -> number of leaves


def gather(root: Node, cells: list) -> Ranges:
    """Node ranges from the cells' own: rows (cell, leaves, low, high, n_low, n_high), low and high along the path."""
    out = Ranges({}, {}, {}, {c: n for c, n, *_ in cells})
    way = paths(root)
    for cell, _, low, high, n_low, n_high in cells:
        at = 0
        for node, j in way[cell]:
            m = len(node.points)
            key = (id(node), j)
            lo, hi = np.array(low[at : at + m], dtype=np.int64), np.array(high[at : at + m], dtype=np.int64)
            if key in out.low:
                out.low[key] = np.minimum(out.low[key], lo)
                out.high[key] = np.maximum(out.high[key], hi)
                out.norm[key] = (min(out.norm[key][0], n_low), max(out.norm[key][1], n_high))
            else:
                out.low[key], out.high[key], out.norm[key] = lo, hi, (n_low, n_high)
            at += m
    return out


def score_bounds(q_norm, to_points, low, high, norm) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that rows can have whose distances to the split points and norms lie in the given ranges."""
    near = np.maximum(to_points - np.sqrt(high), np.sqrt(low) - to_points).max(axis=1)
    far = (to_points + np.sqrt(high)).min(axis=1)
    near = np.maximum(near, 0.0)
    q = np.sqrt(q_norm)
    most = np.minimum((q_norm + norm[1] - near**2) / 2, q * np.sqrt(norm[1]))
    least = np.maximum((q_norm + norm[0] - far**2) / 2, -q * np.sqrt(norm[1]))
    slack = 1e-9 * (q_norm + norm[1] + 1)
    return least - slack, most + slack


def visits(root: Node, ranges: Ranges, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> dict[int, np.ndarray]:
    """Cell -> numbers of the anchors that need it; ``low`` and ``high`` (n x w) are the windows of each anchor."""
    q_norm = norms(q).astype(np.float64)
    out: dict[int, np.ndarray] = {}

    def walk(node: Node, at: np.ndarray):
        to_points = np.sqrt(squared_distances(q[at], node.points).astype(np.float64))
        for j, child in enumerate(node.children):
            key = (id(node), j)
            if key not in ranges.low:  # no row is filed there
                continue
            least, most = score_bounds(q_norm[at], to_points, ranges.low[key].astype(float), ranges.high[key].astype(float), ranges.norm[key])
            meets = ((low[at] <= most[:, None]) & (high[at] >= least[:, None]) & (low[at] <= high[at])).any(axis=1)
            if meets.any():
                if isinstance(child, Node):
                    walk(child, at[meets])
                else:
                    out[child] = at[meets]

    if len(q):
        walk(root, np.arange(len(q)))
    return out


# ---------------------------------------------------------------- rows on Spark
def usable(rows: DataFrame, row_id: str, label: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, label, x, key): rows that take part, each once; ``key`` is a hash of the row."""
    v = F.col(f"`{vector}`")
    x = F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(F.lit(float(scale)) * c.cast("double")) <= F.lit(float(LIMIT))))
    got = rows.where(F.col(f"`{row_id}`").isNotNull() & F.col(f"`{label}`").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(F.coalesce(fine, F.lit(False)))
    common = got.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("d").desc()).first()
    if common is not None:
        got = got.where(F.size(v) == common.d)
    got = got.select(F.col(f"`{row_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"), F.transform(x, lambda c: c.cast("int")).alias("x"))
    return got.withColumn("key", F.xxhash64("vec_id", "label", "x")).dropDuplicates(["vec_id", "label", "key", "x"])


def _ints(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def file_rows(rows: DataFrame, root: Node) -> DataFrame:
    """``rows`` (vec_id, label, x, key) with their cell."""
    sent = rows.sparkSession.sparkContext.broadcast(root)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(descend(sent.value, _ints(b.column(2))), pa.int64())], names=["vec_id", "label", "x", "key", "cell"])

    return rows.select("vec_id", "label", "x", "key").mapInArrow(run, "vec_id long, label long, x array<int>, key long, cell long")


_PACK = "cell long, part long, n long, ids binary, keys binary, labels binary, xs binary, low array<long>, high array<long>, n_low long, n_high long"


def pack(filed: DataFrame, sizes: dict, root: Node, rows_each: int) -> DataFrame:
    """Blocks of about ``rows_each`` rows of a cell, one packed row each, with their own ranges along the path."""
    parts = F.element_at(F.create_map(*[F.lit(v).cast("long") for c, n in sorted(sizes.items()) for v in (c, -(-n // rows_each))]), F.col("cell"))
    sent = filed.sparkSession.sparkContext.broadcast(paths(root))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["x"].to_numpy()).astype(np.int32)
        order = np.lexsort((pdf["key"], pdf["vec_id"]))
        d2 = np.concatenate([squared_distances(x, node.points) for node, _ in sent.value[int(key[0])]], axis=1)
        size = norms(x)
        cols = [np.ascontiguousarray(pdf[c].to_numpy(np.int64)[order]).tobytes() for c in ("vec_id", "key", "label")]
        return pd.DataFrame([[int(key[0]), int(key[1]), len(x), *cols, np.ascontiguousarray(x[order]).tobytes(), d2.min(axis=0).tolist(), d2.max(axis=0).tolist(), int(size.min()), int(size.max())]], columns=[c.split()[0] for c in _PACK.split(", ")])

    return filed.withColumn("part", F.pmod(F.xxhash64("key"), parts)).groupBy("cell", "part").applyInPandas(run, _PACK)


def _unpack(row: dict) -> tuple[np.ndarray, ...]:
    ids, keys, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "keys", "labels"))
    return ids, keys, labels, np.frombuffer(row["xs"], np.int32).reshape(len(ids), -1)


_ASKED = "home long, asked long, part long, ids binary, keys binary, labels binary, xs binary, low binary, high binary, pos binary"


def ask(blocks: DataFrame, root: Node, ranges: Ranges, home_only: bool = False) -> DataFrame:
    """One row per (block of anchors, leaf): the anchors of the block whose windows the leaf's cell may meet.

    ``blocks`` are packed rows with ``low`` and ``high``: the windows of each anchor, packed.
    """
    sent = blocks.sparkSession.sparkContext.broadcast((root, _numbered(root, ranges), ranges.leaves))

    def run(batches):
        tree, numbered, leaves = sent.value
        own = _restored(tree, numbered, leaves)
        for b in batches:
            for row in b.to_pylist():
                ids, keys, labels, x = _unpack(row)
                low, high, pos = (np.frombuffer(row[c], np.int64).reshape(len(ids), -1) for c in ("low", "high", "pos"))
                needed = {row["cell"]: np.arange(len(ids))} if home_only else visits(tree, own, x, low, high)
                for cell, at in sorted(needed.items()):
                    packed = [a[at].tobytes() for a in (ids, keys, labels, x, low, high, pos)]
                    for part in range(1 if home_only else leaves.get(cell, 0)):
                        yield pa.RecordBatch.from_pydict({c.split()[0]: [v] for c, v in zip(_ASKED.split(", "), (row["cell"], cell, part, *packed))})

    return blocks.select("cell", "part", "ids", "keys", "labels", "xs", "low", "high", "pos").mapInArrow(run, _ASKED)


def _numbered(root: Node, ranges: Ranges) -> list:
    """Ranges in the order of a walk through the tree."""
    out = []

    def walk(node: Node):
        for j, child in enumerate(node.children):
            key = (id(node), j)
            out.append((ranges.low.get(key), ranges.high.get(key), ranges.norm.get(key)))
            if isinstance(child, Node):
                walk(child)

    walk(root)
    return out


def _restored(root: Node, numbered: list, leaves: dict) -> Ranges:
    out, at = Ranges({}, {}, {}, leaves), iter(numbered)

    def walk(node: Node):
        for j, child in enumerate(node.children):
            low, high, norm = next(at)
            if low is not None:
                key = (id(node), j)
                out.low[key], out.high[key], out.norm[key] = low, high, norm
            if isinstance(child, Node):
                walk(child)

    walk(root)
    return out


_FOUND = "anchor_id long, anchor_key long, slot int, score long, vec_id long, key long"


def first_of(scores: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """(window, row, column) of the first ``k`` allowed scores of every row in each of its windows: higher first, then the earlier column."""
    real = low <= high
    least = np.where(real, low, _FAR).min(axis=1)
    most = np.where(real, high, _NONE).max(axis=1)
    r, c = np.nonzero(allowed & (scores >= least[:, None]) & (scores <= most[:, None]))
    s = scores[r, c]
    for w in range(low.shape[1]):
        at = np.flatnonzero(real[r, w] & (s >= low[r, w]) & (s <= high[r, w]))
        at = at[np.lexsort((c[at], -s[at], r[at]))]
        own = r[at]
        at = at[np.arange(len(at)) - np.searchsorted(own, own, side="left") < k]
        yield w, r[at], c[at]


def compare(asked: DataFrame, leaves: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The first ``k`` rows of each leaf in each window of each anchor."""
    joined = asked.join(leaves.select(F.col("cell").alias("asked"), "part", F.col("ids").alias("l_ids"), F.col("keys").alias("l_keys"), F.col("labels").alias("l_labels"), F.col("xs").alias("l_xs")), ["asked", "part"])

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                ids, keys, labels, x = _unpack(row)
                low, high = (np.frombuffer(row[c], np.int64).reshape(len(ids), -1) for c in ("low", "high"))
                l_ids, l_keys, l_labels, l_x = _unpack({c: row["l_" + c] for c in ("ids", "keys", "labels", "xs")})
                out: list[list] = [[] for _ in range(6)]
                for z in range(0, len(ids), _SLICE):
                    cut = slice(z, z + _SLICE)
                    scores = products(x[cut], l_x)
                    allowed = labels[cut, None] == l_labels
                    allowed = allowed & ((keys[cut, None] != l_keys) | (ids[cut, None] != l_ids)) if same_label else ~allowed
                    for w, r, c in first_of(scores, allowed, low[cut], high[cut], k):
                        for column, v in zip(out, (ids[cut][r], keys[cut][r], np.full(len(r), w), scores[r, c], l_ids[c], l_keys[c])):
                            column.append(v)
                out = [np.concatenate(c) for c in out]
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if j == 2 else pa.int64()) for j, c in enumerate(out)], names=[c.split()[0] for c in _FOUND.split(", ")])

    return joined.select("ids", "keys", "labels", "xs", "low", "high", "l_ids", "l_keys", "l_labels", "l_xs").mapInArrow(run, _FOUND)


def first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and slot, with their rank."""
    order = Window.partitionBy("anchor_id", "anchor_key", "slot").orderBy(F.col("score").desc(), "vec_id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def with_windows(blocks: DataFrame, found: DataFrame, make, name: str) -> DataFrame:
    """Packed blocks with new windows: ``make(low, high, pos, scores)`` gives (low, high, pos) of an anchor from its scores by (slot, rank).

    ``found``: anchor_id, anchor_key, slot, rank, score; at most one row per slot and rank.
    """
    wanted = found.groupBy("anchor_id", "anchor_key").agg(F.collect_list(F.struct("slot", "rank", "score")).alias("got"))
    anchors = blocks.select("cell", "part", "ids", "keys", "low", "high", "pos")

    def names(batches):
        for b in batches:
            for row in b.to_pylist():
                ids, keys = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["keys"], np.int64)
                n = len(ids)
                yield pa.RecordBatch.from_arrays([pa.array([row["cell"]] * n, pa.int64()), pa.array([row["part"]] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(ids), pa.array(keys)], names=["cell", "part", "place", "anchor_id", "anchor_key"])

    listed = anchors.select("cell", "part", "ids", "keys").mapInArrow(names, "cell long, part long, place int, anchor_id long, anchor_key long")
    got = listed.join(wanted, ["anchor_id", "anchor_key"]).groupBy("cell", "part").agg(F.collect_list(F.struct("place", "got")).alias("found"))
    joined = blocks.select("cell", "part", "ids", "keys", "labels", "xs", "low", "high", "pos").join(got, ["cell", "part"], "left")

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                n = len(row["ids"]) // 8
                low, high, pos = (np.frombuffer(row[c], np.int64).reshape(n, -1) for c in ("low", "high", "pos"))
                scores = [{} for _ in range(n)]
                for f in row.pop("found") or []:
                    scores[f["place"]] = {(g["slot"], g["rank"]): g["score"] for g in f["got"]}
                new = [make(low[i], high[i], pos[i], scores[i]) for i in range(n)]
                for c, v in zip(("low", "high", "pos"), zip(*new)):
                    row[c] = np.array(v, dtype=np.int64).reshape(n, -1).tobytes()
                yield pa.RecordBatch.from_pylist([row])

    schema = "cell long, part long, ids binary, keys binary, labels binary, xs binary, low binary, high binary, pos binary"
    return materialize(joined.mapInArrow(run, schema), name)


def mine(
    rows: DataFrame, is_anchor: Column, row_id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256,
    positives: int = 5, negatives: int = 5, low_pct: int = 80, high_pct: int = 100,
    sample_rows: int = 8192, fan_out: int = 8, depth: int = 2, leaf_rows: int = 8192, block_rows: int = 1024,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``is_anchor`` is a condition on ``vec_id``.

    A negative's score n and a positive's p satisfy low_pct * p <= 100 * n <= high_pct * p.
    """
    spark = rows.sparkSession
    ship_package(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    table = materialize(usable(rows, row_id, label, vector, scale), "negatives-rows")
    share = min(1.0, sample_rows / max(1, table.count()))
    drawn = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    sample = sorted(table.where(drawn).select("key", "x").collect(), key=lambda r: (r.key, r.x)) or table.select("key", "x").limit(1).collect()
    if not sample:
        return spark.createDataFrame([], schema)
    root, _ = build(np.array([r.x for r in sample], dtype=np.int64), fan_out, depth)
    filed = materialize(file_rows(table, root), "negatives-filed")
    sizes = {r.cell: r.n for r in filed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per cell
    leaves = materialize(pack(filed, sizes, root, leaf_rows), "negatives-leaves")
    spread = leaves.select("cell", "n_low", "n_high", F.posexplode(F.arrays_zip("low", "high")).alias("at", "r"))
    edges = spread.groupBy("cell", "at").agg(F.min("r.low").alias("low"), F.max("r.high").alias("high"), F.min("n_low").alias("n_low"), F.max("n_high").alias("n_high"))
    cells = edges.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("at", "low", "high"))).alias("r"), F.min("n_low").alias("n_low"), F.max("n_high").alias("n_high")).collect()
    ranges = gather(root, [(c.cell, -(-sizes[c.cell] // leaf_rows), [x.low for x in c.r], [x.high for x in c.r], c.n_low, c.n_high) for c in cells])

    anchors = filed.where(is_anchor)
    counted = {r.cell: r.n for r in anchors.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counted:
        return spark.createDataFrame([], schema)
    blocks = pack(anchors, counted, root, block_rows).select("cell", "part", "n", "ids", "keys", "labels", "xs")
    fill = lambda v: F.expr(f"unhex(repeat('{np.int64(v).tobytes().hex()}', cast(n as int)))")
    blocks = materialize(blocks.withColumns({"low": fill(_NONE), "high": fill(_FAR), "pos": fill(0)}).drop("n"), "negatives-anchors")

    def bound(k: int):  # no row that counts is below the k-th score found
        return lambda low, high, pos, scores: ([max(low[w], scores.get((w, k), _NONE)) for w in range(len(low))], list(high), list(pos))

    # Positives: one window without an upper end, its lower end from one leaf at home.
    home = first(compare(ask(blocks, root, ranges, home_only=True), leaves, positives, True), positives)
    asked = ask(with_windows(blocks, home, bound(positives), "negatives-bounds"), root, ranges)
    best = materialize(first(compare(asked, leaves, positives, True), positives).select("anchor_id", "anchor_key", "rank", F.col("vec_id").alias("positive_id"), "score"), "negatives-positives")

    # Negatives: a window per positive.
    def per_positive(low, high, pos, scores):
        p = [scores.get((0, r)) for r in range(1, positives + 1)]
        return [-(-low_pct * s // 100) if s is not None else 1 for s in p], [high_pct * s // 100 if s is not None else 0 for s in p], [s or 0 for s in p]

    windows = with_windows(blocks, best.withColumn("slot", F.lit(0)), per_positive, "negatives-windows")
    home = first(compare(ask(windows, root, ranges, home_only=True), leaves, negatives, False), negatives)
    asked = ask(with_windows(windows, home, bound(negatives), "negatives-narrowed"), root, ranges)
    found = first(compare(asked, leaves, negatives, False), negatives)
    return found.withColumn("positive_rank", F.col("slot") + 1).join(
        best.select("anchor_id", "anchor_key", F.col("rank").alias("positive_rank"), "positive_id", F.col("score").alias("positive_score")), ["anchor_id", "anchor_key", "positive_rank"]
    ).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
