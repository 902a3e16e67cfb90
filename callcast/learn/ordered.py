"""Ordered target statistics: a category's mean label over the rows before, so that no row sees its own label.

The rows are taken in the order of md5(id-seed), the order of a design's blocks.  The value of
a training row for a column is (sum of the labels of the training rows before it with the same
level + a * prior) / (their number + a), the prior being the training set's share of positives.
A row that is not trained on takes all training rows of its level.  A level that the training
set does not know gives the prior.

Two passes: the sums of every part of the order (one row a part), then a running sum inside each
part that starts from the sums of the parts before it.
"""

from __future__ import annotations

from typing import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from callcast.learn.design import BATCH_BLOCKS, BLOCK_FILES, FEATURES, Design, Fit, Learnt, dealt, feature_row, filled, summed, unpack
from callcast.session import arrow_rows, materialize


def running_before(codes: np.ndarray, y: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rows x (sum of labels, count) of the earlier rows with the same code; ``start`` (levels x 2) is added, then updated."""
    out = np.zeros((len(codes), 2))
    order = np.argsort(codes, kind="stable")
    c, v = codes[order], y[order]
    total, number = np.cumsum(v), np.arange(1, len(c) + 1)
    first = np.searchsorted(c, c, side="left")
    before = np.where(first > 0, total[first - 1], 0.0)
    out[order, 0] = total - v - before
    out[order, 1] = number - 1 - first
    seen = codes >= 0
    out[seen] += start[codes[seen]]
    np.add.at(start[:, 0], codes[seen], y[seen])
    np.add.at(start[:, 1], codes[seen], 1.0)
    return out


def _level_sums(codes: np.ndarray, y: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """All columns' (levels x 2) sums, one below the other."""
    parts = []
    for j, size in enumerate(sizes):
        ok = codes[:, j] >= 0
        parts.append(np.stack([np.bincount(codes[ok, j], weights=y[ok], minlength=size), np.bincount(codes[ok, j], minlength=size)], axis=1)[:size])
    return np.concatenate(parts) if parts else np.zeros((0, 2))


def with_statistics(design: Design, fits: Sequence[Fit], learnt: Sequence[Learnt], make: Callable, schema: str = FEATURES, name: str = "ordered-features", weight: float = 1.0, emit: Callable = feature_row) -> DataFrame:
    """Feature rows of every training set; ``make(num, codes, statistics, learnt)`` gives the features."""
    spark = design.blocks.sparkSession
    sizes = [len(v) for v in design.levels]
    light = Design(None, design.numeric, design.categorical, design.levels, design.folds)
    sent = spark.sparkContext.broadcast((light, list(fits), list(learnt)))

    def prepared(row):
        d, sets, stats = sent.value
        ids, y, num, cat, folds = unpack(row, d)
        for k, (fit, s) in enumerate(zip(sets, stats)):
            yield k, ids, y, *filled(num, cat, s), fit.trains(folds), fit.scores(folds), s

    def sums(batches):
        out: dict[int, np.ndarray] = {}
        for b in batches:
            for row in b.to_pylist():
                whole = np.concatenate([_level_sums(codes[t], y[t], sizes).ravel() for _, _, y, _, codes, t, _, _ in prepared(row)])
                out[row["part"]] = out[row["part"]] + whole if row["part"] in out else whole
        return out

    shape = (len(fits), sum(sizes), 2)
    got = summed(design.blocks, sums, int(np.prod(shape)) * 8)
    carry, total = {}, np.zeros(shape)
    for part in sorted(got):
        carry[part] = total
        total = total + got[part].reshape(shape)
    starts = spark.sparkContext.broadcast((carry, total))
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(int)

    def run(batches):
        before, whole = starts.value
        part, state = None, None
        for b in batches:
            for row in b.to_pylist():
                if row["part"] != part:
                    part, state = row["part"], before[row["part"]].copy()
                for k, ids, y, num, codes, train, score, s in prepared(row):
                    prior = s.counts[1] / max(1.0, s.counts.sum())
                    values = np.zeros(codes.shape)
                    for j in range(len(sizes)):
                        span = slice(at[j], at[j + 1])
                        c = codes[:, j]
                        pair = np.zeros((len(c), 2))
                        pair[c >= 0] = whole[k, span][c[c >= 0]]
                        pair[train] = running_before(c[train], y[train], state[k, span])
                        values[:, j] = (pair[:, 0] + weight * prior) / (pair[:, 1] + weight)
                    use = train | score
                    if use.any():
                        yield emit(k, row["block"], ids[use], y[use], train[use], score[use], make(num[use], codes[use], values[use], s))

    in_order = design.blocks.repartition("part").sortWithinPartitions("part", "block")
    with arrow_rows(spark, BATCH_BLOCKS):
        return materialize(dealt(in_order.mapInArrow(run, schema), design.blocks), name, **BLOCK_FILES)


def level_totals(design: Design, fits: Sequence[Fit], learnt: Sequence[Learnt]) -> np.ndarray:
    """Training sets x levels of all columns x (sum of labels, rows): what a new row's statistics are made of."""
    sizes = [len(v) for v in design.levels]
    light = Design(None, design.numeric, design.categorical, design.levels, design.folds)
    sent = design.blocks.sparkSession.sparkContext.broadcast((light, list(fits), list(learnt)))

    def work(batches):
        d, sets, stats = sent.value
        total = np.zeros((len(sets), sum(sizes), 2))
        for b in batches:
            for row in b.to_pylist():
                _, y, num, cat, folds = unpack(row, d)
                for k, (fit, s) in enumerate(zip(sets, stats)):
                    train = fit.trains(folds)
                    total[k] += _level_sums(filled(num, cat, s)[1][train], y[train], sizes)
        return {0: total.ravel()}

    got = summed(design.blocks, work, len(fits) * sum(sizes) * 16)
    return got[0].reshape(len(fits), sum(sizes), 2)


def statistics_of_new(codes: np.ndarray, totals: np.ndarray, s: Learnt, weight: float = 1.0) -> np.ndarray:
    """The statistics of rows that are not trained on."""
    prior = s.counts[1] / max(1.0, s.counts.sum())
    out, at = np.full(codes.shape, prior), 0
    for j, known in enumerate(s.known):
        ok = codes[:, j] >= 0
        pair = totals[at + codes[ok, j]]
        out[ok, j] = (pair[:, 0] + weight * prior) / (pair[:, 1] + weight)
        at += len(known)
    return out


def statistics_rows(design: Design, fits: Sequence[Fit], learnt: Sequence[Learnt], weight: float = 1.0) -> DataFrame:
    """(fit, id, column_name, value): the statistics themselves."""
    names = list(design.categorical)

    def emit(k, block, ids, y, train, score, values):
        n, m = values.shape
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n * m, k), pa.int32()), pa.array(np.repeat(ids, m)), pa.array(names * n), pa.array(values.ravel())], names=["fit", "id", "column_name", "value"]
        )

    return with_statistics(design, fits, learnt, lambda num, codes, values, s: values, "fit int, id long, column_name string, value double", "ordered-statistics", weight, emit)
