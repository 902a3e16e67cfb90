"""Training rows as packed blocks, and the features of every training set, written once.

Cross-validation fits the same estimator on many overlapping training sets.  Here the
rows are encoded once into blocks (one Spark row holds a few thousand training rows as
arrays), ordered by a hash of the id.  A *training set* (``Fit``) names the folds it leaves
out.  Its preprocessing (medians, quartiles, modes, known levels) is learnt for all training
sets together: one aggregate per fold cell with mergeable KLL sketches, merged per set.  The
features of each set are then written once, and every candidate is fitted from them.

Nothing of the size of the data reaches the driver or one task: the driver sees sketches per
fold cell, level counts (at most ``max_levels`` a column) and sums over rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcast.operators.split import md5_key
from callcast.session import arrow_rows, discard, materialize, ship_package

BLOCK_ROWS = 4096
#: Blocks that a Python worker is sent at once; by Spark's defaults they would be as many as 64 MB hold.
BATCH_BLOCKS = 8
#: How blocks are written: Parquet looks at the size of a page only every 100 rows by default, and a row is a block here.
BLOCK_FILES = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(16 << 20), "parquet.enable.dictionary": "false"}
#: Size of the KLL sketches; their rank error is 2.446 / KLL_K ** 0.9433 at 99 % confidence (0.1 %); up to KLL_K values they are exact.
KLL_K = 4096


@dataclass(frozen=True)
class Fit:
    """A training set: rows whose fold is in none of ``without`` (pairs of fold column and fold).

    The rows of its last pair that are in none of the others are the rows it scores.
    """

    name: str
    without: tuple[tuple[int, int], ...] = ()

    def trains(self, folds: np.ndarray) -> np.ndarray:
        ok = np.ones(len(folds), dtype=bool)
        for c, v in self.without:
            ok &= folds[:, c] != v
        return ok

    def scores(self, folds: np.ndarray) -> np.ndarray:
        if not self.without:
            return np.ones(len(folds), dtype=bool)
        ok = np.ones(len(folds), dtype=bool)
        for c, v in self.without[:-1]:
            ok &= folds[:, c] != v
        c, v = self.without[-1]
        return ok & (folds[:, c] == v)


@dataclass(frozen=True)
class Design:
    blocks: DataFrame  # part, block, n, ids, y, num, cat, folds; blocks in the order of (part, block)
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    levels: tuple[tuple[str, ...], ...]
    folds: tuple[str, ...]


BLOCKS = "part int, block string, n int, ids binary, y binary, num binary, cat binary, folds binary"
BLOCK_SCHEMA = pa.schema([(c.split()[0], {"int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for c in BLOCKS.split(", ")])


def level_lists(df: DataFrame, columns: Sequence[str], max_levels: int) -> tuple[tuple[str, ...], ...]:
    """The levels of every column, sorted; one aggregate; more than ``max_levels`` in a column is an error."""
    if not columns:
        return ()
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).alias("v")) for i, c in enumerate(columns)])).alias("x")).select("x.*").where("v IS NOT NULL")
    rows = long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")).limit(max_levels * len(columns) + 1).collect()
    out: list[list[str]] = [[] for _ in columns]
    for r in rows:
        out[r.c].append(r.v)
    if len(rows) > max_levels * len(columns) or any(len(x) > max_levels for x in out):
        raise ValueError(f"a categorical column has more than max_levels={max_levels} levels")
    return tuple(tuple(sorted(x)) for x in out)


def encode(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = "label", id_col: str = "contact_id",
    folds: Sequence[str] = (), levels=None, max_levels: int = 1000, seed: int = 42,
) -> Design:
    """Rows of ``df`` in packed blocks, in the order of md5(id-seed).  A null number is NaN, a null or unknown level and a null fold -1."""
    ship_package(df.sparkSession)
    levels = level_lists(df, categorical, max_levels) if levels is None else levels
    code = lambda c, known: F.coalesce(F.array_position(F.array(*[F.lit(v) for v in known]).cast("array<string>"), F.col(c)), F.lit(0)).cast("int") - 1
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(label).cast("double").alias("y"),
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in numeric]).cast("array<double>").alias("num"),
        F.array(*[code(c, known) for c, known in zip(categorical, levels)]).cast("array<int>").alias("cat"),
        F.array(*[F.coalesce(F.col(c).cast("int"), F.lit(-1)) for c in folds]).cast("array<int>").alias("folds"),
        md5_key(id_col, seed).alias("h"),
    )
    rows = rows.repartitionByRange("h").sortWithinPartitions("h", "id").withColumn("part", F.spark_partition_id())

    def pack(batches):
        held, size = [], 0
        for b in batches:
            for z in range(0, b.num_rows, BLOCK_ROWS):
                held.append(b.slice(z, BLOCK_ROWS))
                size += held[-1].num_rows
                if size >= BLOCK_ROWS:
                    yield block(pa.Table.from_batches(held))
                    held, size = [], 0
        if size:
            yield block(pa.Table.from_batches(held))

    def block(t: pa.Table):
        flat = lambda c, kind: np.ascontiguousarray(t.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False), dtype=kind).tobytes()
        one = lambda c, kind: np.ascontiguousarray(t.column(c).to_numpy(), dtype=kind).tobytes()
        cols = [one("id", np.int64), one("y", np.float64), flat("num", np.float64), flat("cat", np.int32), flat("folds", np.int32)]
        return pa.RecordBatch.from_arrays([t.column("part").combine_chunks()[:1], t.column("h").combine_chunks()[:1], pa.array([t.num_rows], pa.int32()), *(pa.array([c], pa.binary()) for c in cols)], names=["part", "block", "n", "ids", "y", "num", "cat", "folds"])

    packed = rows.mapInArrow(pack, BLOCKS)
    blocks = materialize(packed, "design-blocks", **BLOCK_FILES)
    del rows, packed
    discard(df.sparkSession)  # the shuffle of all rows
    return Design(blocks, tuple(numeric), tuple(categorical), tuple(levels), tuple(folds))


def narrowed(design: Design, learnt: Sequence["Learnt"], numeric: Sequence[str], categorical: Sequence[str]) -> tuple[Design, list["Learnt"]]:
    """Some columns of a design and what was learnt of them: what encoding and learning these columns alone gives."""
    num, cat = [design.numeric.index(c) for c in numeric], [design.categorical.index(c) for c in categorical]
    light = Design(None, design.numeric, design.categorical, design.levels, design.folds)

    def run(batches):
        for row in rows_of(batches):
            _, _, x, c, _ = unpack(row, light)
            row |= {"num": np.ascontiguousarray(x[:, num]).tobytes(), "cat": np.ascontiguousarray(c[:, cat]).tobytes()}
            yield pa.RecordBatch.from_pylist([row], schema=BLOCK_SCHEMA)

    with arrow_rows(design.blocks.sparkSession, BATCH_BLOCKS):
        blocks = materialize(design.blocks.mapInArrow(run, BLOCKS), "design-narrowed", **BLOCK_FILES)
    pick = lambda v, at: [v[i] for i in at]
    some = [Learnt(s.median[num], s.scale[num], pick(s.edges, num), pick(s.mode, cat), pick(s.known, cat), s.counts, s.weights) for s in learnt]
    return Design(blocks, tuple(numeric), tuple(categorical), tuple(pick(design.levels, cat)), design.folds), some


def rows_of(batches):
    """The rows of Arrow batches one by one: a batch holds thousands of them, and each of ours holds thousands of training rows."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def unpack(row: dict, design) -> tuple[np.ndarray, ...]:
    n = row["n"]
    m, c, k = len(design.numeric), len(design.categorical), len(design.folds)
    return (
        np.frombuffer(row["ids"], np.int64), np.frombuffer(row["y"], np.float64), np.frombuffer(row["num"], np.float64).reshape(n, m),
        np.frombuffer(row["cat"], np.int32).reshape(n, c), np.frombuffer(row["folds"], np.int32).reshape(n, k),
    )


# ---------------------------------------------------------------- sums over all blocks
def summed(rows: DataFrame, work: Callable, bytes_each: int, collect_limit: int = 256 << 20) -> dict[int, np.ndarray]:
    """``work`` maps batches of rows to a dict key -> float array per task; the sum over all tasks.

    Tasks' parts go to the driver directly while all of them together are small (checked);
    otherwise they are added up by key in tasks first.  Either way a key's parts are added
    in a fixed order, so a run that repeats a lost task gives the same sums.
    """

    def run(batches):
        from pyspark import TaskContext

        got = work(batches)
        if got:
            src = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([src] * len(got), pa.int32()), pa.array(list(got), pa.int64()), pa.array([np.ascontiguousarray(v, np.float64).tobytes() for v in got.values()], pa.binary())], names=["src", "key", "data"])

    def add(batches):
        out: dict[int, np.ndarray] = {}
        for b in batches:
            for _, key, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                out[key] = out[key] + np.frombuffer(data) if key in out else np.frombuffer(data)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([0] * len(out), pa.int32()), pa.array(list(out), pa.int64()), pa.array([v.tobytes() for v in out.values()], pa.binary())], names=["src", "key", "data"])

    schema = "src int, key long, data binary"
    parts = rows.mapInArrow(run, schema)
    if bytes_each * max(1, rows.rdd.getNumPartitions()) > collect_limit:
        parts = parts.repartition("key").sortWithinPartitions("key", "src").mapInArrow(add, schema)
    with arrow_rows(rows.sparkSession, BATCH_BLOCKS):
        got = parts.collect()
    out: dict[int, np.ndarray] = {}
    for r in sorted(got, key=lambda r: (r.key, r.src)):
        data = np.frombuffer(r.data)
        out[r.key] = out[r.key] + data if r.key in out else data
    return out


# ---------------------------------------------------------------- what preprocessing learns, per training set
@dataclass
class Learnt:
    """Per training set: fill value, centre and scale of every number, quantile edges, mode and known levels, class weights."""

    median: np.ndarray
    scale: np.ndarray
    edges: list[np.ndarray]
    mode: list[int]
    known: list[np.ndarray]
    counts: np.ndarray  # rows of class 0 and 1
    weights: np.ndarray = field(default_factory=lambda: np.ones(2))


def learn(design: Design, df: DataFrame, fits: Sequence[Fit], label: str = "label", bins: int = 32) -> list[Learnt]:
    """``df`` holds the columns of the design; one row per fold cell and column is aggregated, then merged per training set."""
    df = df.withColumns({c: F.coalesce(F.col(c).cast("int"), F.lit(-1)) for c in design.folds}) if design.folds else df
    cells = [F.col(c) for c in design.folds]
    probs = [0.25, 0.5, 0.75, *(k / bins for k in range(1, bins))]
    per_cell = df.groupBy(*cells).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_K)).alias(f"s{i}") for i, c in enumerate(design.numeric)]) if design.numeric else None
    long = F.array(F.struct(F.lit(-1).alias("c"), F.col(label).cast("int").cast("string").alias("v")), *[F.struct(F.lit(i).alias("c"), F.col(c).alias("v")) for i, c in enumerate(design.categorical)])
    counts = df.select(*cells, F.explode(long).alias("x")).groupBy(*design.folds, "x.c", "x.v").agg(F.count(F.lit(1)).alias("n")).collect()
    sketches = materialize(per_cell, "fold-sketches") if per_cell is not None else None
    rows = {}
    if sketches is not None:
        member = F.array(*[F.when(_mask(design, f), F.lit(i)) for i, f in enumerate(fits)])
        merged = sketches.withColumn("fit", F.explode(F.filter(member, lambda v: v.isNotNull()))).groupBy("fit").agg(*[F.kll_merge_agg_double(f"s{i}").alias(f"s{i}") for i in range(len(design.numeric))])
        asked = F.array(*[F.lit(float(p)) for p in probs])
        filled = lambda s: F.when(F.kll_sketch_get_n_double(s) > 0, F.kll_sketch_get_quantile_double(s, asked))
        rows = {r.fit: r for r in merged.select("fit", *[filled(F.col(f"s{i}")).alias(f"q{i}") for i in range(len(design.numeric))]).collect()}  # one row per training set
    out = []
    for k, fit in enumerate(fits):
        tally = [np.zeros(len(v)) for v in design.levels]
        classes = np.zeros(2)
        at = [{v: i for i, v in enumerate(vs)} for vs in design.levels]
        for r in counts:
            if any(r[design.folds[c]] == v for c, v in fit.without):
                continue
            if r.c < 0:
                classes[int(r.v)] += r.n
            elif r.v is not None:
                tally[r.c][at[r.c][r.v]] += r.n
        q = [np.array(rows[k][f"q{i}"] if k in rows and rows[k][f"q{i}"] is not None else [0.0] * len(probs)) for i in range(len(design.numeric))]
        spread = np.array([x[2] - x[0] for x in q])
        out.append(
            Learnt(
                np.array([x[1] for x in q]), np.where(spread > 0, spread, 1.0), [np.unique(x[3:]) for x in q],
                [int(t.argmax()) if len(t) else -1 for t in tally], [t > 0 for t in tally], classes,
                classes.sum() / (2 * np.maximum(classes, 1)),
            )
        )
    return out


def _mask(design: Design, fit: Fit):
    cond = F.lit(True)
    for c, v in fit.without:
        cond = cond & (F.col(design.folds[c]) != v)
    return cond


def filled(num: np.ndarray, cat: np.ndarray, s: Learnt) -> tuple[np.ndarray, np.ndarray]:
    """Numbers with the median for missing ones; codes with the mode for null ones and -1 for levels the training set does not know."""
    num = np.where(np.isnan(num), s.median, num)
    codes = np.where(cat < 0, np.array(s.mode, dtype=np.int64), cat) if cat.shape[1] else cat.astype(np.int64)
    for j, known in enumerate(s.known):
        codes[:, j] = np.where((codes[:, j] >= 0) & known[np.maximum(codes[:, j], 0)], codes[:, j], -1)
    return num, codes


FEATURES = "fit int, block string, n int, ids binary, y binary, train binary, score binary, x binary"


def feature_row(k: int, block: str, ids, y, train, score, x) -> pa.RecordBatch:
    cols = (np.ascontiguousarray(c).tobytes() for c in (ids, y, train, score, x))
    return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([block]), pa.array([len(ids)], pa.int32()), *(pa.array([c], pa.binary()) for c in cols)], names=[c.split()[0] for c in FEATURES.split(", ")])


def features(design: Design, fits: Sequence[Fit], learnt: Sequence[Learnt], make: Callable, name: str, only_scored: bool = False) -> DataFrame:
    """Rows (fit, block, n, ids, y, train, score, x) of every training set, written once; ``make(num, codes, learnt)`` gives the packed features.

    With ``only_scored`` all rows are to be scored and none trains (rows that no model has seen).
    """
    light = Design(None, design.numeric, design.categorical, design.levels, design.folds)
    sent = design.blocks.sparkSession.sparkContext.broadcast((light, list(fits), list(learnt)))

    def run(batches):
        d, sets, stats = sent.value
        for b in batches:
            for row in rows_of([b]):
                ids, y, num, cat, folds = unpack(row, d)
                for k, (fit, s) in enumerate(zip(sets, stats)):
                    train = np.zeros(len(ids), bool) if only_scored else fit.trains(folds)
                    score = np.ones(len(ids), bool) if only_scored else fit.scores(folds)
                    use = train | score
                    if not use.any():
                        continue
                    x = make(*filled(num[use], cat[use], s), s)
                    yield feature_row(k, row["block"], ids[use], y[use], train[use], score[use], x)

    with arrow_rows(design.blocks.sparkSession, BATCH_BLOCKS):
        return materialize(dealt(design.blocks.mapInArrow(run, FEATURES), design.blocks), name, **BLOCK_FILES)


def dealt(rows: DataFrame, source: DataFrame) -> DataFrame:
    """Feature rows of a table too small for all cores, dealt evenly over them; a larger one stays as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if source.rdd.getNumPartitions() < cores else rows


def opened(row: dict, kind) -> tuple[np.ndarray, ...]:
    n = row["n"]
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["y"], np.float64), np.frombuffer(row["train"], bool), np.frombuffer(row["score"], bool), np.frombuffer(row["x"], kind).reshape(n, -1)
