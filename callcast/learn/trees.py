"""Trees from histograms that Spark adds up: a balanced random forest, leaf-wise and symmetric boosting.

Features are bins (one byte each): quantile bins of numbers, codes of levels.  A task adds up, per
node and bin, the gradients, Hessians and rows of its blocks; the driver chooses splits from the sums.
All training sets and candidates grow in the same jobs.  A split on a number is "bin <= cut", on a
level "code == cut" (what a tree sees of a one-hot column).  The gain of a split is
G_l^2 / (H_l + l2) + G_r^2 / (H_r + l2) - G^2 / (H + l2).

* ``fit_forest``: every tree has its own bootstrap (Poisson counts by a hash of id and tree) and class
  weights balanced *inside* it; each node looks at a random subset of the features.  Nodes of more than
  ``local_rows`` rows are split from distributed histograms; the rows of a smaller node go to one task, which
  grows the rest of that subtree (a bounded group).  Every node keeps its value, so one tree serves
  all depths of a grid.
* ``fit_boosting``: gradients of the weighted log loss.  Leaf-wise: the leaf with the highest gain is split
  first, up to ``leaves``; a job looks at all leaves that may still be split, so the jobs per tree are its depth.
  Symmetric: one split for all leaves of a level.  Scores are written with the features every ``refresh`` rounds.
* Training sets of at most ``WHOLE_ROWS`` rows go to tasks as a whole, once for every piece of their trees or
  candidates (``_in_pieces``).  A task grows its trees one after the other without further jobs and, if they are
  wanted for scores only (``InTasks``), scores with them there.  The trees are those of the distributed sums.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field
from typing import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcast.learn.design import BATCH_BLOCKS, Learnt, opened, rows_of, summed
from callcast.operators.resample import _counts
from callcast.session import arrow_rows, materialize

BINS = 33
MAX_LEVELS = 254
#: Rows of a training set that one task takes, and bytes of their bins.
WHOLE_ROWS, WHOLE_BYTES = 2_000_000, 64 << 20
#: Rows of a node of a larger training set that one task takes.
LOCAL_ROWS = 1 << 16
#: Tasks for each core when whole training sets are dealt out, so that cores end at about the same time.
PIECES_PER_CORE = 6


# ---------------------------------------------------------------- bins, trees, splits
def binned(num: np.ndarray, codes: np.ndarray, s: Learnt) -> np.ndarray:
    """One byte per feature: quantile bin of a number, code + 1 of a level (0: unknown)."""
    cols = [np.searchsorted(e, num[:, j], side="left") for j, e in enumerate(s.edges)]
    return np.stack([*cols, *(codes[:, j] + 1 for j in range(codes.shape[1]))], axis=1).astype(np.uint8)


def binned_statistics(num: np.ndarray, codes: np.ndarray, values: np.ndarray, s: Learnt) -> np.ndarray:
    """Quantile bins of numbers and even bins of the ordered statistics (shares from 0 to 1)."""
    cols = [np.searchsorted(e, num[:, j], side="left") for j, e in enumerate(s.edges)]
    return np.stack([*cols, *(np.minimum(values[:, j] * (BINS - 1), BINS - 1) for j in range(values.shape[1]))], axis=1).astype(np.uint8)


@dataclass
class Tree:
    feature: list = field(default_factory=lambda: [-1])  # -1: a leaf
    cut: list = field(default_factory=lambda: [0])
    equal: list = field(default_factory=lambda: [False])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])
    depth: list = field(default_factory=lambda: [0])

    def split(self, node: int, f: int, cut: int, equal: bool, values: tuple[float, float]) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.cut[node], self.equal[node], self.left[node], self.right[node] = f, cut, equal, a, a + 1
        for v in values:
            self.feature.append(-1)
            self.cut.append(0)
            self.equal.append(False)
            self.left.append(0)
            self.right.append(0)
            self.value.append(v)
            self.depth.append(self.depth[node] + 1)
        return a, a + 1

    def lists(self) -> tuple[list, ...]:
        return self.feature, self.cut, self.equal, self.left, self.right

    def arrays(self) -> tuple[np.ndarray, ...]:
        kinds = (np.int16, np.int16, bool, np.int32, np.int32, np.float64, np.int32)
        return tuple(np.array(c, dtype=k) for c, k in zip((self.feature, self.cut, self.equal, self.left, self.right, self.value, self.depth), kinds))


@dataclass(frozen=True)
class Grown:
    """A finished tree, held as arrays only."""

    columns: tuple[np.ndarray, ...]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.columns


#: Rows that are led through a tree side by side, so that what a step holds stays in the processor's cache.
ROUTE_ROWS = 1 << 13


def route(tree: tuple[np.ndarray, ...], bins: np.ndarray, max_depth: int | None = None) -> np.ndarray:
    """The node where each row ends."""
    feature, cut, equal, left, _, _, depth = tree
    inner = feature >= 0 if max_depth is None else (feature >= 0) & (depth < max_depth)
    node = np.zeros(len(bins), dtype=np.int64)
    if not inner[0]:
        return node
    # A row goes left if its bin is one of [low, low + width]; the right child comes after the left one; a leaf leads to itself.
    at_leaf = np.arange(len(feature))
    column, step = np.where(inner, feature, 0).astype(np.int64), np.where(inner, left, at_leaf).astype(np.int64)
    low = np.where(inner & equal, cut, 0).astype(np.uint8)
    width = np.where(inner, np.where(equal, 0, cut), 255).astype(np.uint8)
    flat, m = np.ascontiguousarray(bins).ravel(), bins.shape[1]
    for z in range(0, len(bins), ROUTE_ROWS):
        n = min(ROUTE_ROWS, len(bins) - z)
        at, base = np.arange(z, z + n), np.arange(z, z + n) * m
        k = np.zeros(n, dtype=np.int64)
        while len(k):
            for _ in range(4):
                b = flat.take(base + column.take(k))
                b -= low.take(k)
                k = step.take(k) + (b > width.take(k))
            more = inner.take(k)
            if not more.all():
                node[at[~more]] = k[~more]
                at, base, k = at[more], base[more], k[more]
    return node


def histogram(bins: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, slots: int, n_bins: int) -> np.ndarray:
    """slots x features x bins x (sum of g, sum of h, rows); rows with slot -1 are left out."""
    use = slot >= 0
    b, s = bins[use].astype(np.int64), slot[use].astype(np.int64)
    m = bins.shape[1]
    at = ((s[:, None] * m + np.arange(m)) * n_bins + b).ravel()
    size = slots * m * n_bins
    out = [np.bincount(at, weights=np.repeat(v[use], m), minlength=size) for v in (g, h)] + [np.bincount(at, minlength=size)]
    return np.stack(out, axis=-1).reshape(slots, m, n_bins, 3)


#: Rows that one packed sum takes: a Poisson(1) count is below 20, so rows, counts and positive counts of so many rows need 17 bits each.
PACKED_ROWS = (1 << 17) // 20


def packed_histogram(bins: np.ndarray, slot: np.ndarray, counts: np.ndarray, y: np.ndarray, slots: int, n_bins: int) -> np.ndarray:
    """slots x features x bins: rows, counts and counts of positives in one whole number, added up in one pass, so exact; at most ``PACKED_ROWS`` rows."""
    m = bins.shape[1]
    at = bins + (slot[:, None] * m + np.arange(m)) * n_bins
    packed = 1 + counts * (1 << 17) + counts * (y > 0) * (1 << 34)
    return np.bincount(at.ravel(), weights=np.repeat(packed, m), minlength=slots * m * n_bins).reshape(slots, m, n_bins)


def unpacked(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts of positives, counts, rows) of packed sums."""
    whole = sums.astype(np.int64)
    return whole >> 34, (whole >> 17) & 0x1FFFF, whole & 0x1FFFF


def count_histogram(bins: np.ndarray, slot: np.ndarray, counts: np.ndarray, y: np.ndarray, slots: int, n_bins: int) -> np.ndarray:
    """slots x features x bins x (counts of positives, counts, rows) of any number of rows."""
    out = np.zeros((slots, bins.shape[1], n_bins, 3))
    for z in range(0, len(bins), PACKED_ROWS):
        part = slice(z, z + PACKED_ROWS)
        out += np.stack(unpacked(packed_histogram(bins[part], slot[part], counts[part], y[part], slots, n_bins)), axis=-1)
    return out


def weighted(positive, counts, weights: np.ndarray):
    """(weight of positives, weight) from whole counts and the weights of class 0 and 1."""
    g = positive * weights[1]
    return g, g + (counts - positive) * weights[0]


def rows_at(tree: tuple[list, ...], columns: np.ndarray, rows: np.ndarray, wanted) -> dict[int, np.ndarray]:
    """Which of ``rows`` are at each of the wanted nodes of a small tree; only the ways there are followed."""
    feature, cut, equal, left, right = tree[:5]
    up = {}
    for k, f in enumerate(feature):
        if f >= 0:
            up[left[k]] = up[right[k]] = k
    ways = set()
    for k in wanted:
        while k not in ways:
            ways.add(k)
            k = up.get(k, k)
    out, stack = {}, [(0, rows)]
    while stack:
        k, own = stack.pop()
        if k not in ways or not len(own):
            continue
        if k in wanted:
            out[k] = own
        if feature[k] >= 0:
            b = columns[feature[k]].take(own)
            go = b == cut[k] if equal[k] else b <= cut[k]
            stack += [(left[k], own[go]), (right[k], own[~go])]
    return out


def gains(hist: np.ndarray, is_level: np.ndarray, l2: float, min_rows: int, min_h: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """Gain of every split (features x bins; -inf where it is not allowed), and the sums of its left side."""
    total = hist[0].sum(axis=0) if len(hist) else np.zeros(3)
    left = np.where(is_level[:, None, None], hist, np.cumsum(hist, axis=1))
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[..., 0] ** 2 / (left[..., 1] + l2) + right[..., 0] ** 2 / (right[..., 1] + l2) - total[0] ** 2 / (total[1] + l2)
    ok = (left[..., 2] >= max(1, min_rows)) & (right[..., 2] >= max(1, min_rows)) & (left[..., 1] > min_h) & (right[..., 1] > min_h)
    ok[~is_level, -1] = False
    return np.where(ok & np.isfinite(gain), gain, -np.inf), left


def first_best(values: np.ndarray) -> int:
    """The first place of the highest value; values that differ by rounding are equal, so the order of a sum does not choose."""
    top = values.max()
    return int((values >= top - 1e-9 * max(1.0, abs(top))).argmax()) if np.isfinite(top) else int(values.argmax())


def best_split(hist: np.ndarray, is_level: np.ndarray, l2: float, min_rows: int, min_h: float = 1e-9, allowed: np.ndarray | None = None):
    """(gain, feature, cut, left sums, right sums) or None; of equal gains the first feature, then the first bin."""
    gain, left = gains(hist, is_level, l2, min_rows, min_h)
    if allowed is not None:
        gain = np.where(allowed, gain, -np.inf)
    f, cut = divmod(first_best(gain.ravel()), gain.shape[1])
    total = hist[0].sum(axis=0)
    if not gain[f, cut] > 1e-12 * max(1.0, abs(total[0])):
        return None
    return float(gain[f, cut]), f, cut, left[f, cut], total - left[f, cut]


# ---------------------------------------------------------------- whole training sets in tasks
@dataclass(frozen=True)
class InTasks:
    """Models that are grown where they score, and never leave the task; ``run`` makes the table of scores (of forests: for variants of the trees)."""

    run: Callable


def fits_a_task(learnt: Sequence[Learnt], fits: Sequence[int], most: int = WHOLE_ROWS) -> bool:
    """Whether a task can take all rows of any of these training sets."""
    return all(learnt[f].counts.sum() <= min(most, WHOLE_BYTES // max(1, len(learnt[f].median) + len(learnt[f].known))) for f in fits)


#: Bytes that are sent to the pieces of all training sets before there are fewer pieces, down to one for each core.
PIECES_BYTES = 400 << 20


def _pieces(rows: DataFrame, learnt: Sequence[Learnt], fits: Sequence[int], most: int) -> int:
    """Into how many pieces the trees or candidates of every training set are dealt."""
    cores, n = rows.sparkSession.sparkContext.defaultParallelism, max(1, len(fits))
    each = sum(learnt[f].counts.sum() * (len(learnt[f].median) + len(learnt[f].known) + 18) for f in fits)
    return max(1, min(most, -(-PIECES_PER_CORE * cores // n), max(-(-cores // n), int(PIECES_BYTES // max(1, each)))))


def _in_pieces(rows: DataFrame, fits: Sequence[int], pieces: int, work: Callable, schema: str) -> DataFrame:
    """``work(fit, piece, ids, y, train, score, bins)`` of every training set and piece, each in a task of its own that has all rows of the training set, in the order of the blocks."""
    place = F.array_position(F.array(*[F.lit(int(f)) for f in fits]), F.col("fit")).cast("int") - 1
    sent = rows.where(F.col("fit").isin([int(f) for f in fits])).withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))).withColumn("slot", place * pieces + F.col("piece"))

    def run(batches):
        slot, held = None, []

        def close():
            parts = [opened(row, np.uint8) for row in held]
            fit, piece = held[0]["fit"], held[0]["piece"]
            held.clear()
            return work(fit, piece, *(np.concatenate(c) for c in zip(*parts)))

        for row in rows_of(batches):
            if row["slot"] != slot and held:
                yield from close()
            slot = row["slot"]
            held.append(row)
        if held:
            yield from close()

    return sent.repartitionById(len(fits) * pieces, F.col("slot")).sortWithinPartitions("slot", "block").mapInArrow(run, schema)


TREES = "key string, feature binary, cut binary, left binary, value binary, depth binary"


def _tree_row(key: str, tree: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    feature, cut, _, left, _, value, depth = tree
    return pa.RecordBatch.from_arrays([pa.array([key]), *(pa.array([c.tobytes()], pa.binary()) for c in (feature, cut, left, value, depth))], names=[c.split()[0] for c in TREES.split(", ")])


def _tree_rows(grown: DataFrame, name: str):
    """((training set, leaf size or candidate, tree), node, arrays) of the trees or subtrees that tasks have grown: the model, one row each."""
    kinds = (np.int16, np.int16, np.int32, np.float64, np.int32)
    with arrow_rows(grown.sparkSession, BATCH_BLOCKS):
        written = materialize(grown, name)
    for r in written.toLocalIterator():
        f, m, t, node = map(int, r.key.split("/"))
        yield (f, m, t), node, tuple(np.frombuffer(c, k) for c, k in zip(r[1:], kinds))


def _score_rows(fit: int, candidate: int, ids: np.ndarray, y: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, fit), pa.int32()), pa.array(np.full(n, candidate), pa.int32()), pa.array(ids), pa.array(y), pa.array(p)], names=["fit", "candidate", "id", "label", "p"])


SCORES = "fit int, candidate int, id long, label double, p double"


# ---------------------------------------------------------------- forest
def bootstrap_weights(ids: np.ndarray, y: np.ndarray, tree: int, seed: int, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Poisson counts of the rows in a tree's bootstrap, and their weights: both classes get half of the bootstrap's mass."""
    counts, weights = bootstrap_counts(ids, tree, seed), bootstrap_class_weights(mass)
    return counts, counts * np.where(y > 0, weights[1], weights[0])


def bootstrap_counts(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    return _counts(ids, 1, seed * 1_000_003 + tree)[:, 0]


def bootstrap_class_weights(mass: np.ndarray) -> np.ndarray:
    """Weights of class 0 and 1 that give both half of the bootstrap's mass."""
    return mass.sum() / (2 * np.maximum(mass, 1e-300))


def class_masses(rows: DataFrame, fits: int, n_trees: int, seed: int) -> dict[int, np.ndarray]:
    """Per training set: trees x 2 sums of the bootstrap counts of each class."""

    def work(batches):
        out: dict[int, np.ndarray] = {}
        for row in rows_of(batches):
            ids, y, train, _, _ = opened(row, np.uint8)
            ids, y = ids[train], y[train]
            part = np.array([[c[y <= 0].sum(), c[y > 0].sum()] for c in (bootstrap_counts(ids, t, seed) for t in range(n_trees))]).ravel()
            out[row["fit"]] = out[row["fit"]] + part if row["fit"] in out else part
        return out

    return {k: v.reshape(n_trees, 2) for k, v in summed(rows, work, fits * n_trees * 16).items()}


_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        for mul in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = x ^ (x >> np.uint64(33))
            x = x * np.uint64(mul)
        return x ^ (x >> np.uint64(33))


def node_orders(seed: int, fit: int, tree: int, paths: Sequence[int], n_choices: int) -> np.ndarray:
    """The order in which each node looks at its choices (numbers, and levels one by one): a hash of the tree and the node's path."""
    with np.errstate(over="ignore"):
        base = _mixed(np.array([seed * 1_000_003 + fit, tree], dtype=np.uint64) * _MUL + np.array([1, 2], dtype=np.uint64)).sum()
        own = _mixed(np.array(paths, dtype=np.uint64) * _MUL + base)
        return np.argsort(_mixed(own[:, None] + np.arange(1, n_choices + 1, dtype=np.uint64) * _MUL), axis=1)  # no ties: different numbers stay different


def _first_best_rows(values: np.ndarray) -> np.ndarray:
    top = values.max(axis=1)
    finite = np.where(np.isfinite(top), top, 0.0)
    return (values >= (finite - 1e-9 * np.maximum(1.0, np.abs(finite)))[:, None]).argmax(axis=1)


def forest_splits(hists: np.ndarray, weights: np.ndarray, choices: list, min_rows: int, seed: int, fit: int, tree: int, paths: Sequence[int], take: int, first_only: bool = False) -> list:
    """Per node: the best split among the first ``take`` choices of its own order, or of the first later choice that splits at all; or None.

    With ``first_only`` later choices are not looked at.  ``hists`` are of ``packed_histogram`` or ``count_histogram``; a split has the sums (weight of positives, weight, rows) of both sides.
    """
    n, n_bins = len(hists), hists.shape[2]
    apart = unpacked if hists.ndim == 3 else (lambda sums: (sums[..., 0], sums[..., 1], sums[..., 2]))

    def stats(sums: np.ndarray) -> tuple[np.ndarray, ...]:
        positive, counts, rows = apart(sums)
        return (*weighted(positive, counts, weights), rows)

    feature, level = np.array(choices).T
    orders = node_orders(seed, fit, tree, paths, len(choices))
    out: list = [None] * n
    totals = stats(hists[:, 0].sum(axis=1))

    def look(at: np.ndarray, picks: np.ndarray, one: bool) -> np.ndarray:
        """Fills ``out`` for the nodes ``at``; returns those without a split."""
        f, c = feature[picks], level[picks]
        part = hists[at[:, None], f]  # nodes x picks x bins
        numbers = c < 0
        part[numbers] = np.cumsum(part[numbers], axis=1)
        lg, lh, lr = stats(part)
        g, h, r = (v[at][:, None, None] for v in totals)
        rg, rh, rr = g - lg, h - lh, r - lr
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = lg**2 / lh + rg**2 / rh - g**2 / h
        rows = max(1, min_rows)
        ok = (lr >= rows) & (rr >= rows) & (lh > 1e-9) & (rh > 1e-9) & np.isfinite(gain)
        bins = np.arange(n_bins)
        ok &= np.where((c >= 0)[:, :, None], bins == c[:, :, None], bins < n_bins - 1)
        gain = np.where(ok, gain, -np.inf)
        if one:  # only the first choice that splits
            good = gain.max(axis=2) > 1e-12
            first = good.argmax(axis=1)
            gain = np.where((np.arange(gain.shape[1]) == first[:, None])[:, :, None], gain, -np.inf)
        flat = gain.reshape(len(at), -1)
        best = _first_best_rows(flat)
        found = flat[np.arange(len(at)), best] > 1e-12
        for i in np.flatnonzero(found):
            k, cut = divmod(int(best[i]), n_bins)
            lo, hi = ((float(v[i, k, cut]) for v in sums) for sums in ((lg, lh, lr), (rg, rh, rr)))
            out[at[i]] = (float(flat[i, best[i]]), int(f[i, k]), cut, tuple(lo), tuple(hi))
        return at[~found]

    for z in range(0, n, 256):  # bounded memory
        at = np.arange(z, min(n, z + 256))
        rest = look(at, orders[at, :take], False)
        if len(rest) and take < len(choices) and not first_only:
            look(rest, orders[rest, take:], True)
    return out


def _choices(is_level: np.ndarray, levels: Sequence[int]) -> list[tuple[int, int]]:
    """What a node may look at: a number, or one level of a column."""
    out, at = [], 0
    for f, level in enumerate(is_level):
        if level:
            out += [(f, c + 1) for c in range(levels[at])]
            at += 1
        else:
            out.append((f, -1))
    return out


def _share(sums: np.ndarray) -> float:
    """Weighted share of positives; sums that differ from a pure node's by rounding only count as pure."""
    p = float(sums[0] / sums[1])
    return 0.0 if p < 1e-12 else 1.0 if p > 1 - 1e-12 else p


def _shares(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    p = g / h
    return np.where(p < 1e-12, 0.0, np.where(p > 1 - 1e-12, 1.0, p))


#: Entries (rows of a node times what the node looks at) that are counted at once.
ENTRIES = 1 << 15
#: Rows from which a node is counted alone, choice by choice, without gathering its rows.
SLICED_ROWS = 1024


class _NodeRows:
    """The rows of the open nodes of a tree, each node's beside each other, with sums of whole numbers over them: (counts of positives, counts, rows)."""

    def __init__(self, columns: np.ndarray, counts: np.ndarray, positive: np.ndarray, start: np.ndarray):
        self.columns, self.counts, self.positive, self.start = columns, counts, positive, start
        self.sizes, self.n = np.diff(start), columns.shape[1]
        # What is added up, exactly: packed in as few numbers as the largest sums allow; None counts rows.
        if self.sizes.max() <= PACKED_ROWS:
            self.values = [1 + counts * (1 << 17) + positive * (1 << 34)]
        elif self.sizes.max() <= (1 << 26) // 20:
            self.values = [counts + positive * (1 << 26), None]
        else:
            self.values = [positive, counts, None]

    def apart(self, sums: list) -> tuple[np.ndarray, ...]:
        if len(sums) == 1:
            return unpacked(sums[0])
        if len(sums) == 2:
            packed = sums[0].astype(np.int64)
            return packed >> 26, packed & 0x3FFFFFF, sums[1]
        return tuple(sums)

    def totals(self) -> tuple[np.ndarray, ...]:
        return self.apart([self.sizes if v is None else np.add.reduceat(v, self.start[:-1]) for v in self.values])

    def _apart_by_size(self, node: np.ndarray):
        large = self.sizes[node] >= SLICED_ROWS
        return np.flatnonzero(large), np.flatnonzero(~large)

    def _few(self, lens: np.ndarray):
        """Slices of pairs with few rows together."""
        ends = np.cumsum(lens)
        a = 0
        while a < len(lens):
            z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + ENTRIES, side="right")))
            yield slice(a, z)
            a = z

    def at_level(self, node: np.ndarray, f: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
        """Sums over the rows of a node with one level of a column, for pairs (node, column and level)."""
        out = [np.zeros(len(node)) for _ in self.values]
        large, small = self._apart_by_size(node)
        for i in large:
            at = slice(self.start[node[i]], self.start[node[i] + 1])
            equal = self.columns[f[i], at] == c[i]
            for o, v in zip(out, self.values):
                o[i] = np.count_nonzero(equal) if v is None else v[at].dot(equal)
        flat = self.columns.ravel()
        for s in self._few(self.sizes[node[small]]):
            i = small[s]
            lens = self.sizes[node[i]]
            offset = self.start[node[i]] - (np.cumsum(lens) - lens)
            b = flat.take(np.arange(lens.sum()) + np.repeat(f[i] * self.n + offset, lens))
            hit = np.flatnonzero(b == np.repeat(c[i].astype(np.uint8), lens))
            pair = np.repeat(np.arange(len(i), dtype=np.int32), lens).take(hit)
            for o, v in zip(out, self.values):
                o[i] = np.bincount(pair, weights=None if v is None else v.take(hit + offset.take(pair)), minlength=len(i))
        return self.apart(out)

    def up_to(self, node: np.ndarray, f: np.ndarray, n_bins: int) -> tuple[np.ndarray, ...]:
        """Sums over the rows of a node up to every bin of a number, for pairs (node, column)."""
        out = [np.zeros((len(node), n_bins)) for _ in self.values]
        large, small = self._apart_by_size(node)
        for i in large:
            at = slice(self.start[node[i]], self.start[node[i] + 1])
            b = self.columns[f[i], at].astype(np.int64)
            for o, v in zip(out, self.values):
                o[i] = np.bincount(b, weights=None if v is None else v[at], minlength=n_bins)
        flat = self.columns.ravel()
        for s in self._few(self.sizes[node[small]]):
            i = small[s]
            lens = self.sizes[node[i]]
            offset = self.start[node[i]] - (np.cumsum(lens) - lens)
            run = np.arange(lens.sum())
            cell = np.repeat(np.arange(len(i)) * n_bins, lens) + flat.take(run + np.repeat(f[i] * self.n + offset, lens))
            rows = run + np.repeat(offset, lens)
            for o, v in zip(out, self.values):
                o[i] = np.bincount(cell, weights=None if v is None else v.take(rows), minlength=len(i) * n_bins).reshape(-1, n_bins)
        return self.apart([np.cumsum(o, axis=1) for o in out])


def _count_gains(left: tuple, total: tuple, weights: np.ndarray, min_rows: int) -> tuple[np.ndarray, ...]:
    """Gains of splits with these whole sums on the left (-inf where not allowed), and the left side's (weight of positives, weight)."""
    lg, lh = weighted(left[0], left[1], weights)
    g, h, r = total
    rg, rh, rr = g - lg, h - lh, r - left[2]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = lg**2 / lh + rg**2 / rh - g**2 / h
    least = max(1, min_rows)
    ok = (left[2] >= least) & (rr >= least) & (lh > 1e-9) & (rh > 1e-9) & np.isfinite(gain)
    return np.where(ok, gain, -np.inf), lg, lh


def _node_splits(rows: _NodeRows, total: tuple, weights: np.ndarray, choices: list, min_rows: int, key: tuple, paths: np.ndarray, take: int, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """``forest_splits`` of all nodes at once, from their rows: (feature, cut) per node, feature -1 for none, and the left side's sums.  Only what a node looks at is counted."""
    feature, level = np.array(choices).T
    orders = node_orders(*key, paths, len(choices))
    best, sums = np.full((len(paths), 2), -1), np.zeros((len(paths), 3))
    rest = np.arange(len(paths))
    for first in range(0, len(choices), take):  # nodes that none of the choices so far splits take the first later one that does
        if not len(rest):
            break
        picks = orders[rest, first : first + take]
        f, c = feature[picks], level[picks]
        node, number = np.broadcast_to(rest[:, None], f.shape), c < 0
        top, place = np.full(f.shape, -np.inf), np.zeros(f.shape, dtype=np.int64)
        up = rows.up_to(node[number], f[number], n_bins)
        gain_n, g_n, h_n = _count_gains(up, tuple(v[node[number], None] for v in total), weights, min_rows)
        gain_n[:, n_bins - 1 :] = -np.inf
        on = rows.at_level(node[~number], f[~number], c[~number])
        gain_l, g_l, h_l = _count_gains(on, tuple(v[node[~number]] for v in total), weights, min_rows)
        top[number], top[~number] = gain_n.max(axis=1, initial=-np.inf), gain_l
        place[number], place[~number] = np.arange(len(gain_n)), np.arange(len(gain_l))
        row = np.arange(len(rest))
        pick = _first_best_rows(top) if first == 0 else (top > 1e-12).argmax(axis=1)
        most = top.max(axis=1) if first == 0 else top[row, pick]
        finite = np.where(np.isfinite(most), most, 0.0)
        limit = finite - 1e-9 * np.maximum(1.0, np.abs(finite))
        at, cut, value = place[row, pick], c[row, pick], top[row, pick]
        own = np.zeros((len(rest), 3))
        i = np.flatnonzero(number[row, pick])
        b = (gain_n[at[i]] >= limit[i, None]).argmax(axis=1)
        cut[i], value[i] = b, gain_n[at[i], b]
        own[i] = np.stack([g_n[at[i], b], h_n[at[i], b], up[2][at[i], b]], axis=1)
        i = np.flatnonzero(~number[row, pick])
        own[i] = np.stack([g_l[at[i]], h_l[at[i]], on[2][at[i]]], axis=1)
        found = value > 1e-12
        best[rest[found]], sums[rest[found]] = np.stack([f[row, pick], cut], axis=1)[found], own[found]
        rest = rest[~found]
    return best, sums


def grow_locally(bins, counts, y, weights, is_level, choices, min_rows, key, path, take, n_bins, max_nodes: int) -> Grown:
    """A whole subtree from the rows of its root, level by level; ``key``: seed, training set and tree, ``path``: the root's place in it."""
    positive = counts * (y > 0)
    g, h = weighted(positive.sum(), counts.sum(), weights)
    leaf = lambda values: [np.full(len(values), -1), np.zeros(len(values), np.int64), np.zeros(len(values), np.int64), values]
    levels, size = [leaf(np.array([_share((g, h)) if h > 0 else 0.0]))], 1  # per depth: feature, cut, left, value
    at, paths = np.arange(min(1, len(counts))), np.array([path], dtype=np.uint64)  # open nodes of the last depth
    rows = _NodeRows(np.ascontiguousarray(bins.T), counts, positive, np.array([0, len(counts)])) if len(at) else None
    while len(at) and size < max_nodes:
        p, c, r = rows.totals()
        total = (*weighted(p, c, weights), r)
        best, sums = _node_splits(rows, total, weights, choices, min_rows, key, paths, take, n_bins)
        split = np.flatnonzero(best[:, 0] >= 0)
        feature, cut, left, _ = levels[-1]
        feature[at[split]], cut[at[split]] = best[split].T
        left[at[split]] = size + 2 * np.arange(len(split))
        kids = np.stack([sums[split], np.stack(total, axis=1)[split] - sums[split]], axis=1).reshape(-1, 3)
        value = _shares(kids[:, 0], kids[:, 1])
        levels.append(leaf(value))
        size += len(kids)
        further = (kids[:, 2] >= 2 * min_rows) & (value > 0) & (value < 1)
        slot = np.full((len(at), 2), -1)  # place of a node's children among the next open nodes
        slot[split] = np.where(further, np.cumsum(further) - 1, -1).reshape(-1, 2)
        own, f = np.repeat(np.arange(len(at)), rows.sizes), np.maximum(best[:, 0], 0)
        b = rows.columns.ravel().take(np.repeat(f * rows.n, rows.sizes) + np.arange(rows.n))
        goes_left = np.where(is_level[f][own], b == best[own, 1], b <= best[own, 1])
        new = slot.ravel().take(2 * own + ~goes_left)
        use = np.flatnonzero(new >= 0)
        new = new[use]
        order = use[np.argsort(new.astype(np.uint16) if further.sum() < 1 << 16 else new, kind="stable")]
        paths = ((2 * paths[split])[:, None] + np.arange(2, dtype=np.uint64)).ravel()[further] % np.uint64(1 << 61)
        at = np.flatnonzero(further)
        if len(at):
            rows = _NodeRows(rows.columns.take(order, axis=1), rows.counts[order], rows.positive[order], np.concatenate([[0], np.cumsum(np.bincount(new, minlength=len(at)))]))
    feature, cut, left, value = (np.concatenate(c) for c in zip(*levels))
    inner = feature >= 0
    depth = np.repeat(np.arange(len(levels)), [len(x[0]) for x in levels])
    kinds = (np.int16, np.int16, bool, np.int32, np.int32, np.float64, np.int32)
    columns = feature, cut, inner & is_level[np.maximum(feature, 0)], left, np.where(inner, left + 1, 0), value, depth
    return Grown(tuple(c.astype(k) for c, k in zip(columns, kinds)))


def grafted(tree: Tree, subs: Sequence[tuple[int, tuple[np.ndarray, ...]]], is_level: np.ndarray) -> Grown:
    """The tree with subtrees (feature, cut, left, value, depth) in place of leaves."""
    kinds = (np.int16, np.int16, bool, np.int32, np.int32, np.float64, np.int32)
    own = tree.arrays()
    parts, size, roots = [own], len(own[0]), []
    for node, (feature, cut, left, value, depth) in sorted(subs, key=lambda x: x[0]):
        inner = feature >= 0
        left = np.where(inner, left + size - 1, 0)  # the subtree's root takes the leaf's place
        columns = feature, cut, inner & is_level[np.maximum(feature, 0)], left, np.where(inner, left + 1, 0), value, depth + own[6][node]
        parts.append(tuple(c[1:] for c in columns))
        roots.append((node, [c[0] for c in columns[:5]]))
        size += len(feature) - 1
    out = tuple(np.concatenate([p[i] for p in parts]).astype(kinds[i]) for i in range(7))
    for node, root in roots:
        for column, v in zip(out, root):
            column[node] = v
    return Grown(out)


def fit_forest(
    rows: DataFrame, learnt: Sequence[Learnt], n_numeric: int, min_leaf: Sequence[int] = (2, 5), n_trees: int = 300, seed: int = 42,
    max_features: int | None = None, local_rows: int | None = None, max_nodes: int = 1 << 16, hist_bytes: int = 32 << 20,
    fits: Sequence[int] | None = None, stay: bool = False,
) -> dict[tuple[int, int], list[Grown]] | InTasks:
    """(training set, number of the leaf size) -> trees; ``rows`` are features of ``binned``, of all training sets or of ``fits``.

    With ``stay`` trees of whole training sets are not brought to the driver, but grown when ``score_forest`` asks for their scores.
    """
    levels = [len(k) for k in learnt[0].known]
    if any(v > MAX_LEVELS for v in levels):
        raise ValueError(f"a column has more than {MAX_LEVELS} levels")
    is_level = np.array([False] * n_numeric + [True] * len(levels))
    n_bins = max([BINS, *(v + 1 for v in levels)])
    choices = _choices(is_level, levels)
    take = max_features or max(1, int(np.sqrt(len(choices))))
    fits = list(range(len(learnt))) if fits is None else list(fits)
    if fits_a_task(learnt, fits, local_rows or WHOLE_ROWS):
        return _whole_forest(rows, learnt, fits, is_level, n_bins, choices, take, min_leaf, n_trees, seed, max_nodes, stay)
    local_rows = local_rows or LOCAL_ROWS
    masses = class_masses(rows, len(learnt), n_trees, seed)
    trees = {(f, m, t): Tree() for f in masses for m in range(len(min_leaf)) for t in range(n_trees)}
    path = {k: {0: 1} for k in trees}
    todo: list[tuple[tuple, int]] = [(k, 0) for k in trees]  # (tree, node) that needs a distributed histogram
    local: list[tuple[tuple, int]] = []
    whole: set[tuple[tuple, int]] = set()  # nodes that look at all their choices: none of the first ones split
    of_choice = np.array([f for f, _ in choices])
    for f, m, t in trees:
        trees[(f, m, t)].value[0] = 0.5
    each = max(1, hist_bytes // (len(is_level) * n_bins * 24))
    sc = rows.sparkSession.sparkContext
    while todo:
        batch, todo = todo[:each], todo[each:]
        wanted: dict = {}
        looked: list[np.ndarray] = []  # the features that a node looks at; the first one is always there, for the node's totals
        for slot, (k, node) in enumerate(batch):
            picks = node_orders(seed, k[0], k[2], [path[k][node]], len(choices))[0]
            looked.append(np.unique(np.append(of_choice[picks if (k, node) in whole else picks[:take]], 0)))
            wanted.setdefault(k, {})[node] = slot, looked[-1]
        sent = sc.broadcast({k: (trees[k].lists(), nodes) for k, nodes in wanted.items()})

        def work(batches):
            out: dict[int, np.ndarray] = {}
            for row in rows_of(batches):
                ids, y, train, _, bins = opened(row, np.uint8)
                ids, y, bins = ids[train], y[train], bins[train]
                columns = np.ascontiguousarray(bins.T)
                for (f, m, t), (tree, nodes) in sent.value.items():
                    if f != row["fit"]:
                        continue
                    counts = bootstrap_counts(ids, t, seed)
                    own = rows_at(tree, columns, np.flatnonzero(counts), nodes)
                    if not own:
                        continue
                    at = np.concatenate(list(own.values()))
                    slot = np.repeat(np.arange(len(own)), [len(r) for r in own.values()])
                    hist = count_histogram(bins[at], slot, counts[at], y[at], len(own), n_bins)
                    for node, part in zip(own, hist):
                        key, features = nodes[node]
                        out[key] = out[key] + part[features].ravel() if key in out else part[features].ravel()
            return out

        got = summed(rows, work, sum(map(len, looked)) * n_bins * 24)
        sent.unpersist()
        for slot, (k, node) in enumerate(batch):
            if slot not in got:
                continue
            tree, weights = trees[k], bootstrap_class_weights(masses[k[0]][k[2]])
            if len(tree.feature) >= max_nodes:
                continue
            hist = np.zeros((1, len(is_level), n_bins, 3))
            hist[0, looked[slot]] = got[slot].reshape(-1, n_bins, 3)
            again = (k, node) not in whole and take < len(choices)
            split = forest_splits(hist, weights, choices, min_leaf[k[1]], seed, k[0], k[2], [path[k][node]], take, again)[0]
            if split is None and again:
                whole.add((k, node))
                todo.append((k, node))
            if split is None:
                continue
            _, f, cut, lo, hi = split
            a, z = tree.split(node, f, cut, bool(is_level[f]), (_share(lo), _share(hi)))
            path[k][a], path[k][z] = 2 * path[k][node] % (1 << 61), (2 * path[k][node] + 1) % (1 << 61)
            for v, s in ((a, lo), (z, hi)):
                if s[2] >= 2 * min_leaf[k[1]] and 0 < _share(s) < 1:
                    (local if s[2] <= local_rows else todo).append((k, v))
    subs: dict = {}
    if local:
        for k, node, sub in _finish(rows, trees, path, local, masses, min_leaf, seed, is_level, choices, take, n_bins, max_nodes):
            subs.setdefault(k, []).append((node, sub))
    out: dict[tuple[int, int], list[Grown]] = {}
    for f, m, t in sorted(trees):
        out.setdefault((f, m), []).append(grafted(trees[(f, m, t)], subs.pop((f, m, t), ()), is_level))
    return out


def _whole_forest(rows, learnt, fits, is_level, n_bins, choices, take, min_leaf, n_trees, seed, max_nodes, stay: bool):
    """``fit_forest`` in tasks that have all rows of a training set: a task grows the trees of its piece."""
    pieces = _pieces(rows, learnt, fits, n_trees)

    def grown(fit, piece, ids, y, bins):
        columns = np.ascontiguousarray(bins.T)
        for t in range(piece, n_trees, pieces):
            counts = bootstrap_counts(ids, t, seed)
            weights, at = bootstrap_class_weights(np.array([counts[y <= 0].sum(), counts[y > 0].sum()])), np.flatnonzero(counts)
            for m, leaf in enumerate(min_leaf):
                if len(at):
                    tree = grow_locally(columns.take(at, axis=1).T, counts[at], y[at], weights, is_level, choices, leaf, (seed, fit, t), 1, take, n_bins, max_nodes)
                else:  # nothing to learn from
                    tree = Tree(value=[0.5])
                yield m, t, tree.arrays()

    def bring(fit, piece, ids, y, train, score, bins):
        for m, t, tree in grown(fit, piece, ids[train], y[train], bins[train]):
            yield _tree_row(f"{fit}/{m}/{t}/0", tree)

    if not stay:
        out: dict[tuple[int, int], list] = {}
        for (f, m, t), node, sub in _tree_rows(_in_pieces(rows, fits, pieces, bring, TREES), "forest-trees"):
            out.setdefault((f, m), [None] * n_trees)[t] = grafted(Tree(), [(node, sub)], is_level)
        return dict(sorted(out.items()))

    def scores(variants):
        def part(fit, piece, ids, y, train, score, bins):
            seen = bins[score]
            sums = np.zeros((len(variants), len(seen)))
            for m, _, tree in grown(fit, piece, ids[train], y[train], bins[train]):
                for c, (depth, leaf) in enumerate(variants):
                    if leaf == m:
                        sums[c] += tree[5][route(tree, seen, depth)]
            ids, y = ids[score], y[score]
            for z in range(0, len(ids), SENT_ROWS):
                at = slice(z, z + SENT_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.int32()) for v in (fit, z // SENT_ROWS, piece)] + [pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (ids[at], y[at], sums[:, at])], names=["fit", "rows", "piece", "ids", "y", "sums"])

        def add(batches):
            key, held, sums = None, None, None

            def close():
                ids, y = np.frombuffer(held["ids"], np.int64), np.frombuffer(held["y"])
                for c, p in enumerate(sums.reshape(len(variants), -1)):
                    yield _score_rows(held["fit"], c, ids, y, np.clip(p / n_trees, 0.0, 1.0))

            for row in rows_of(batches):
                if (row["fit"], row["rows"]) != key:
                    if key is not None:
                        yield from close()
                    key, held, sums = (row["fit"], row["rows"]), row, np.zeros(len(row["sums"]) // 8)
                sums = sums + np.frombuffer(row["sums"])
            if key is not None:
                yield from close()

        parts = _in_pieces(rows, fits, pieces, part, "fit int, rows int, piece int, ids binary, y binary, sums binary")
        return parts.repartition("fit", "rows").sortWithinPartitions("fit", "rows", "piece").mapInArrow(add, SCORES)

    return InTasks(scores)


#: Scored rows that are sent on together.
SENT_ROWS = 1 << 15


def forest_bytes(rows: float, min_leaf: Sequence[int], n_trees: int, max_nodes: int = 1 << 16) -> int:
    """The most that the trees of one training set take: a bootstrap has 0.64 of the rows, a leaf at least ``min_leaf`` of them, a node 25 bytes."""
    return sum(n_trees * int(min(max_nodes, 1 + 2 * 0.64 * rows / max(1, leaf))) * 25 for leaf in min_leaf)


def _finish(rows, trees, path, local, masses, min_leaf, seed, is_level, choices, take, n_bins, max_nodes):
    """Send the rows of small nodes to one task each and grow their subtrees there."""
    wanted: dict = {}
    for k, node in local:
        wanted.setdefault(k, []).append(node)
    sc = rows.sparkSession.sparkContext
    sent = sc.broadcast({k: (trees[k].lists(), set(nodes)) for k, nodes in wanted.items()})
    keys = sc.broadcast({(k, node): path[k][node] for k, node in local})

    def deal(batches):
        for row in rows_of(batches):
            ids, y, train, _, bins = opened(row, np.uint8)
            ids, y, bins = ids[train], y[train], bins[train]
            columns = np.ascontiguousarray(bins.T)
            held: list[tuple] = []
            for (f, m, t), (tree, nodes) in sent.value.items():
                if f != row["fit"]:
                    continue
                counts = bootstrap_counts(ids, t, seed)
                drawn = (2 * counts + (y > 0)).astype(np.uint8)
                held += [(f"{f}/{m}/{t}/{node}", drawn[at].tobytes(), bins[at].tobytes()) for node, at in rows_at(tree, columns, np.flatnonzero(counts), nodes).items()]
                if len(held) >= 1024:
                    yield dealt_rows(held, row["block"])
                    held = []
            if held:
                yield dealt_rows(held, row["block"])

    def dealt_rows(held, block):
        keys_, drawn, bins = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(keys_), pa.array([block] * len(held)), pa.array(drawn, pa.binary()), pa.array(bins, pa.binary())], names=["key", "block", "drawn", "bins"])

    def grow(batches):
        key, held = None, []

        def close():
            f, m, t, node = map(int, key.split("/"))
            drawn = np.concatenate([np.frombuffer(h["drawn"], np.uint8) for h in held])
            bins = np.concatenate([np.frombuffer(h["bins"], np.uint8).reshape(-1, len(is_level)) for h in held])
            counts, y = (drawn // 2).astype(np.float64), (drawn % 2).astype(np.float64)
            sub = grow_locally(bins, counts, y, bootstrap_class_weights(masses[f][t]), is_level, choices, min_leaf[m], (seed, f, t), keys.value[((f, m, t), node)], take, n_bins, max_nodes)
            return _tree_row(key, sub.arrays())

        for row in rows_of(batches):
            if row["key"] != key:
                if held:
                    yield close()
                key, held = row["key"], []
            held.append(row)
        if held:
            yield close()

    dealt = rows.mapInArrow(deal, "key string, block string, drawn binary, bins binary")
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, len(local) // 64)
    yield from _tree_rows(dealt.repartition(tasks, "key").sortWithinPartitions("key", "block").mapInArrow(grow, TREES), "forest-subtrees")


def score_forest(rows: DataFrame, forests: dict[tuple[int, int], list[Grown]] | InTasks, variants: Sequence[tuple[int | None, int]]) -> DataFrame:
    """(fit, candidate, id, label, p): mean leaf value over the trees; a variant is (max depth, number of the leaf size)."""
    if isinstance(forests, InTasks):
        return forests.run(variants)
    sent = rows.sparkSession.sparkContext.broadcast({k: [t.arrays() for t in v] for k, v in forests.items()})

    def predict(fit, bins):
        for c, (depth, m) in enumerate(variants):
            trees = sent.value.get((fit, m))
            if trees:
                yield c, np.clip(sum(t[5][route(t, bins, depth)] for t in trees) / len(trees), 0.0, 1.0)

    return _scored(rows, predict)


def _scored(rows: DataFrame, predict) -> DataFrame:
    def run(batches):
        for row in rows_of(batches):
            ids, y, _, score, bins = opened(row, np.uint8)
            ids, y, bins = ids[score], y[score], bins[score]
            n = len(ids)
            for c, p in predict(row["fit"], bins) if n else ():
                yield _score_rows(row["fit"], c, ids, y, p)

    return rows.mapInArrow(run, SCORES)


# ---------------------------------------------------------------- boosting
@dataclass(frozen=True)
class Candidate:
    """``leaves``: leaf-wise up to so many; or ``depth``: symmetric trees."""

    rate: float
    l2: float
    leaves: int | None = None
    depth: int | None = None
    min_rows: int = 20


@dataclass
class _Growing:
    """A tree while it grows, and what is known of its leaves."""

    tree: Tree = field(default_factory=Tree)
    known: dict = field(default_factory=dict)  # node -> best split or None
    sums: dict = field(default_factory=dict)  # node -> (G, H, rows)


_RAW: dict = {}


def _raw_scores(run_id: str, key: tuple, stored: np.ndarray, bins: np.ndarray, trees: list) -> np.ndarray:
    """Scores after all ``trees``; a Python worker that has just done the same block goes on from there.

    What is remembered is only a saving: a worker that does not have it adds the trees up again.
    """
    done, raw = _RAW.get((run_id, key), (0, None))
    if raw is None or done > len(trees):
        done, raw = 0, stored.copy()
    for t in trees[done:]:
        raw = raw + t[5][route(t, bins)]
    if len(_RAW) > 4096:
        _RAW.clear()
    _RAW[(run_id, key)] = (len(trees), raw)
    return raw


class _JointBins:
    """The bins of several features in one code each, so that one pass over the rows counts several features; at most ``BINS`` squared codes."""

    def __init__(self, bins: np.ndarray, n_bins: int):
        self.columns, self.m, self.n_bins = np.ascontiguousarray(bins.T), bins.shape[1], n_bins
        sizes = self.columns.max(axis=1, initial=0).astype(int) + 1
        groups: list[list[int]] = []
        for f in np.argsort(-sizes, kind="stable"):
            room = (g for g in groups if np.prod(sizes[g]) * sizes[f] <= BINS * BINS)
            got = next(room, None)
            if got is None:
                groups.append([int(f)])
            else:
                got.append(int(f))
        self.groups = [(g, tuple(int(sizes[f]) for f in g)) for g in groups]
        self.codes = [np.ravel_multi_index(tuple(self.columns[f] for f in g), shape).astype(np.uint16) for g, shape in self.groups]

    def histograms(self, rows: np.ndarray | None, slot: np.ndarray | None, g: np.ndarray, h: np.ndarray, slots: int = 1) -> np.ndarray:
        """As ``histogram``, of the rows ``rows`` (all for None) at the places ``slot``; g and h are of these rows."""
        out = np.zeros((slots, self.m, self.n_bins, 3))
        for (features, shape), code in zip(self.groups, self.codes):
            cells = int(np.prod(shape))
            at = (code if rows is None else code.take(rows)).astype(np.int64)
            if slot is not None:
                at += slot * cells
            for k, v in enumerate((g, h, None)):
                sums = np.bincount(at, weights=v, minlength=slots * cells).reshape(slots, *shape)
                for j, f in enumerate(features):
                    out[:, f, : shape[j], k] = sums.sum(axis=tuple(1 + i for i in range(len(shape)) if i != j))
        return out

    def rest(self, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Histograms of the rows that are not in ``part``; a bin without rows has exact zeros."""
        out = whole - part
        out[out[..., 2] == 0] = 0.0
        return out


def _leaf_wise_tree(joint: _JointBins, g: np.ndarray, h: np.ndarray, cand: Candidate, is_level: np.ndarray) -> tuple[Tree, dict, np.ndarray]:
    """A tree grown best-first from all rows: the tree, the sums of its leaves, and the leaf of every row."""
    tree, leaf = Tree(), np.zeros(len(g), dtype=np.int64)
    rows, hists = {0: np.arange(len(g))}, {0: joint.histograms(None, None, g, h)[0]}
    known, sums = {0: best_split(hists[0], is_level, cand.l2, cand.min_rows, 1e-3)}, {0: hists[0][0].sum(axis=0)}
    heap, leaves = [(-known[0][0], 0)] if known[0] else [], 1
    while heap and leaves < cand.leaves:
        _, node = heapq.heappop(heap)
        _, f, cut, lo, hi = known.pop(node)
        kids = tree.split(node, f, cut, bool(is_level[f]), (0.0, 0.0))
        leaves += 1
        own, before = rows.pop(node), hists.pop(node)
        b = joint.columns[f].take(own)
        go = b == cut if is_level[f] else b <= cut
        del sums[node]
        for kid, s, at in zip(kids, (lo, hi), (own[go], own[~go])):
            sums[kid], rows[kid] = s, at
            leaf[at] = kid
        if leaves == cand.leaves:
            break
        small, large = sorted(kids, key=lambda k: len(rows[k]))
        if len(rows[large]) >= 2 * max(1, cand.min_rows):
            at = rows[small]
            hists[small] = joint.histograms(at, None, g.take(at), h.take(at))[0]
            hists[large] = joint.rest(before, hists[small])
            for kid in kids:
                known[kid] = best_split(hists[kid], is_level, cand.l2, cand.min_rows, 1e-3)
                if known[kid]:
                    heapq.heappush(heap, (-known[kid][0], kid))
    return tree, sums, leaf


def _symmetric_tree(joint: _JointBins, g: np.ndarray, h: np.ndarray, cand: Candidate, is_level: np.ndarray) -> tuple[Tree, dict, np.ndarray]:
    """A tree with one split a level from all rows: the tree, the sums of its leaves, and the leaf of every row."""
    growing, nodes, place, first = _Growing(), [0], np.zeros(len(g), dtype=np.int64), 0  # a row is at node ``first`` + ``place``
    hists = joint.histograms(None, None, g, h)
    while nodes:
        tree, size = growing.tree, len(growing.tree.feature)
        following = _symmetric(growing, nodes, hists, cand, is_level)
        if len(tree.feature) == size:
            break
        f, cut, equal = tree.feature[nodes[0]], tree.cut[nodes[0]], tree.equal[nodes[0]]
        b = joint.columns[f]
        place, first = 2 * place + ~(b == cut if equal else b <= cut), size
        if following:
            n = np.bincount(place, minlength=len(following)).reshape(-1, 2)
            small = np.arange(len(n)) * 2 + (n[:, 1] < n[:, 0])
            slot = np.full(len(following), -1)
            slot[small] = np.arange(len(n))
            own = slot.take(place)
            at = np.flatnonzero(own >= 0)
            part = joint.histograms(at, own.take(at), g.take(at), h.take(at), len(n))
            both = np.empty((len(following), *part.shape[1:]))
            both[small], both[small ^ 1] = part, joint.rest(np.asarray(hists), part)
            hists = both
        nodes = following
    return growing.tree, growing.sums, first + place


def boost_locally(bins: np.ndarray, y: np.ndarray, weights: np.ndarray, cand: Candidate, rounds: int, is_level: np.ndarray, n_bins: int) -> list[Tree]:
    """All trees of a model from all rows of its training set."""
    joint, raw, w = _JointBins(bins, n_bins), np.zeros(len(y)), np.where(y > 0, weights[1], weights[0])
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        tree, sums, leaf = (_leaf_wise_tree if cand.leaves else _symmetric_tree)(joint, w * (y - p), w * p * (1 - p), cand, is_level)
        _leaf_values(tree, sums, cand)
        raw += np.array(tree.value).take(leaf)
        trees.append(tree)
    return trees


def _leaf_values(tree: Tree, sums: dict, cand: Candidate) -> None:
    for node, s in sums.items():
        tree.value[node] = cand.rate * float(s[0] / (s[1] + cand.l2)) if s[1] + cand.l2 > 0 else 0.0


def _whole_boosting(rows, learnt, weights, fits, candidates, rounds: int, is_level, n_bins: int, stay: bool):
    """``fit_boosting`` in tasks that have all rows of a training set: a task boosts the candidates of its piece."""
    pieces = _pieces(rows, learnt, fits, len(candidates))

    def boosted(fit, piece, y, bins):
        for c in range(piece, len(candidates), pieces):
            yield c, boost_locally(bins, y, weights[fit], candidates[c], rounds, is_level, n_bins)

    def bring(fit, piece, ids, y, train, score, bins):
        for c, trees in boosted(fit, piece, y[train], bins[train]):
            for t, tree in enumerate(trees):
                yield _tree_row(f"{fit}/{c}/{t}/0", tree.arrays())

    def part(fit, piece, ids, y, train, score, bins):
        seen = bins[score]
        for c, trees in boosted(fit, piece, y[train], bins[train]) if len(seen) else ():
            raw = sum(a[5][route(a, seen)] for a in (t.arrays() for t in trees))
            yield _score_rows(fit, c, ids[score], y[score], 1 / (1 + np.exp(-raw)))

    if stay:
        return InTasks(lambda: _in_pieces(rows, fits, pieces, part, SCORES))
    out: dict[tuple[int, int], list] = {(f, c): [None] * rounds for f in fits for c in range(len(candidates))}
    for (f, c, t), node, sub in _tree_rows(_in_pieces(rows, fits, pieces, bring, TREES), "boosted-trees"):
        out[(f, c)][t] = grafted(Tree(), [(node, sub)], is_level)
    return out


def fit_boosting(
    rows: DataFrame, learnt: Sequence[Learnt], n_numeric: int, candidates: Sequence[Candidate], rounds: int, ordered: bool = False, refresh: int = 50,
    whole_rows: int = WHOLE_ROWS, stay: bool = False,
) -> dict[tuple[int, int], list[Tree]] | InTasks:
    """(training set, number of the candidate) -> trees whose leaf values include the learning rate.

    ``rows`` are features of ``binned``, or with ``ordered`` of ``binned_statistics`` (all features are ordered).
    With ``stay`` models of whole training sets are not brought to the driver, but boosted when ``score_boosting`` asks for their scores.
    """
    import uuid

    levels = [len(k) for k in learnt[0].known]
    is_level = np.array([False] * n_numeric + [not ordered] * len(levels))
    n_bins = BINS if ordered else max([BINS, *(v + 1 for v in levels)])
    sc = rows.sparkSession.sparkContext
    weights = [s.weights for s in learnt]
    fits = [f for f in range(len(learnt)) if learnt[f].counts.sum() > 0]
    if fits and fits_a_task(learnt, fits, whole_rows):
        return _whole_boosting(rows, learnt, weights, fits, candidates, rounds, is_level, n_bins, stay)
    keys = [(f, c) for f in fits for c in range(len(candidates))]
    done: dict[tuple[int, int], list[Tree]] = {k: [] for k in keys}
    table = rows.withColumn("raw", F.lit(None).cast("binary")).persist(StorageLevel.MEMORY_AND_DISK)  # read by every job; a lost part is read again from the written features
    pending = {k: [] for k in keys}
    run_id = uuid.uuid4().hex

    def sums(wanted: dict) -> dict:
        """(model) -> slots x features x bins x 3 for the nodes in ``wanted`` (model -> (tree, nodes))."""
        sent = sc.broadcast((wanted, {k: pending[k] for k in wanted}, run_id))

        def work(batches):
            asked, trees, rid = sent.value
            out: dict[int, np.ndarray] = {}
            for b in batches:
                for row in b.to_pylist():
                    _, y, train, _, bins = opened(row, np.uint8)
                    y, bins = y[train], bins[train]
                    if not len(y):
                        continue
                    stored = np.frombuffer(row["raw"]).reshape(-1, len(candidates))[train] if row["raw"] else np.zeros((len(y), len(candidates)))
                    w = np.where(y > 0, weights[row["fit"]][1], weights[row["fit"]][0])
                    for (f, c), (tree, nodes) in asked.items():
                        if f != row["fit"]:
                            continue
                        raw = _raw_scores(rid, (f, c, row["block"]), stored[:, c], bins, trees[(f, c)])
                        p = 1 / (1 + np.exp(-raw))
                        slot = np.full(len(tree[0]), -1)
                        slot[nodes] = np.arange(len(nodes))
                        part = histogram(bins, slot[route(tree, bins)], w * (y - p), w * p * (1 - p), len(nodes), n_bins).ravel()
                        key = f * len(candidates) + c
                        out[key] = out[key] + part if key in out else part
            return out

        size = sum(len(nodes) for _, nodes in wanted.values()) * len(is_level) * n_bins * 24
        got = summed(table, work, size)
        sent.unpersist()
        return {(f, c): got[f * len(candidates) + c].reshape(-1, len(is_level), n_bins, 3) for f, c in wanted if f * len(candidates) + c in got}

    for r in range(rounds):
        growing = {k: _Growing() for k in keys}
        open_models = {k: [0] for k in keys}
        while open_models:
            hists = sums({k: (growing[k].tree.arrays(), nodes) for k, nodes in open_models.items()})
            following = {}
            for k, nodes in open_models.items():
                if k in hists:
                    step = _leaf_wise if candidates[k[1]].leaves else _symmetric
                    more = step(growing[k], nodes, hists[k], candidates[k[1]], is_level)
                    if more:
                        following[k] = more
            open_models = following
        for k in keys:
            tree = growing[k].tree
            _leaf_values(tree, growing[k].sums, candidates[k[1]])
            done[k].append(tree)
            pending[k].append(tree.arrays())
        if (r + 1) % refresh == 0 and r + 1 < rounds:
            old, table = table, _refreshed(table, pending, len(candidates)).persist(StorageLevel.MEMORY_AND_DISK)
            old.unpersist()
            pending = {k: [] for k in keys}
            run_id = uuid.uuid4().hex
    table.unpersist()
    return done


def _refreshed(table: DataFrame, pending: dict, n: int) -> DataFrame:
    """The features with the scores after all trees so far, written."""
    sent = table.sparkSession.sparkContext.broadcast(pending)

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                bins = opened(row, np.uint8)[4]
                raw = np.frombuffer(row["raw"]).reshape(-1, n).copy() if row["raw"] else np.zeros((row["n"], n))
                for (f, c), trees in sent.value.items():
                    if f == row["fit"]:
                        for t in trees:
                            raw[:, c] += t[5][route(t, bins)]
                row["raw"] = raw.tobytes()
                yield pa.RecordBatch.from_pylist([row], schema=b.schema)

    return materialize(table.mapInArrow(run, table.schema), "boosting-scores")


def _leaf_wise(g: _Growing, nodes: list, hists: np.ndarray, cand: Candidate, is_level: np.ndarray) -> list:
    """Take in the histograms of ``nodes``; split best-first as far as all gains are known; return the nodes to look at next."""
    for node, hist in zip(nodes, hists):
        g.known[node] = best_split(hist, is_level, cand.l2, cand.min_rows, 1e-3)
        g.sums.setdefault(node, hist[0].sum(axis=0))
    # Replay best-first growth; children of a split whose histograms are missing stop it.
    tree, sums = Tree(), {0: g.sums[0]}
    place = {0: 0}  # node of the replayed tree -> node that was looked at
    heap = [(-g.known[0][0], 0)] if g.known.get(0) else []
    leaves, blocked = 1, False
    while heap and leaves < cand.leaves:
        _, node = heapq.heappop(heap)
        _, f, cut, lo, hi = g.known[place[node]]
        kids = tree.split(node, f, cut, bool(is_level[f]), (0.0, 0.0))
        leaves += 1
        old = g.tree
        sums[kids[0]], sums[kids[1]] = lo, hi
        if leaves == cand.leaves:
            break
        seen = (old.left[place[node]], old.right[place[node]]) if place[node] < len(old.feature) and old.feature[place[node]] >= 0 else (None, None)
        for kid, before in zip(kids, seen):
            place[kid] = before if before is not None else -1
            if before is None or before not in g.known:
                blocked = True
            elif g.known[before]:
                heapq.heappush(heap, (-g.known[before][0], kid))
        if blocked:
            break
    if not blocked:
        g.tree, g.sums = tree, {k: v for k, v in sums.items() if tree.feature[k] < 0}
        return []
    # Look at the children of every known leaf that could still be split: as many as splits are left.
    frontier = sorted(((-v[0], n) for n, v in g.known.items() if v and (n >= len(g.tree.feature) or g.tree.feature[n] < 0)))[: cand.leaves - 1]
    new = []
    for _, n in frontier:
        _, f, cut, lo, hi = g.known[n]
        a, z = g.tree.split(n, f, cut, bool(is_level[f]), (0.0, 0.0))
        g.sums[a], g.sums[z] = lo, hi
        new += [a, z]
    return new


def _symmetric(g: _Growing, nodes: list, hists: np.ndarray, cand: Candidate, is_level: np.ndarray) -> list:
    """One split for all leaves of the level: the one with the highest sum of gains."""
    if not g.sums:
        g.sums[0] = hists[0][0].sum(axis=0)
    pairs = [gains(h, is_level, cand.l2, 0, -1.0) for h in hists]
    total = sum(np.where(np.isfinite(p[0]), np.maximum(p[0], 0.0), 0.0) for p in pairs)
    f, cut = divmod(first_best(total.ravel()), total.shape[1])
    if total[f, cut] <= 1e-12:
        return []
    new = []
    for node, hist, (_, left) in zip(nodes, hists, pairs):
        lo = left[f, cut]
        a, z = g.tree.split(node, f, cut, bool(is_level[f]), (0.0, 0.0))
        g.sums.pop(node, None)
        g.sums[a], g.sums[z] = lo, hist[0].sum(axis=0) - lo
        new += [a, z]
    return new if g.tree.depth[new[0]] < cand.depth else []


def score_boosting(rows: DataFrame, models: dict[tuple[int, int], list[Tree]] | InTasks) -> DataFrame:
    """(fit, candidate, id, label, p) for the rows that each training set scores."""
    if isinstance(models, InTasks):
        return models.run()
    sent = rows.sparkSession.sparkContext.broadcast({k: [t.arrays() for t in v] for k, v in models.items()})

    def predict(fit, bins):
        for (f, c), trees in sorted(sent.value.items()):
            if f == fit:
                yield c, 1 / (1 + np.exp(-sum(t[5][route(t, bins)] for t in trees)))

    return _scored(rows, predict)
